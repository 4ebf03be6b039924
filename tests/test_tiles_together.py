"""Containers of a table are decoded many at a time, as each alone."""

from __future__ import annotations

import random
import struct

import numpy as np

from cohortspark.sources import tiles as T


def container(r: random.Random) -> bytes | None:
    kind, dims, n = r.randrange(16), r.choice([2, 3, 4, 8]), r.randrange(4)
    width, at = 20 + 4 * dims, 104 + r.randrange(3) * 8
    head = b"SIS\0" + bytes(4) + struct.pack("<II", 1, {6: 9, 7: 1}.get(kind, dims)) + struct.pack("<QQQI", {4: 2**63, 5: 999}.get(kind, 64), 0, {8: 2**63}.get(kind, at), n + (kind == 9)) + bytes(20)
    image = b"ETS\0" + bytes(4) + struct.pack("<8i", *(r.randrange(1, 600) for _ in range(8)))
    table = b"".join(struct.pack(f"<i{dims}iQii", 0, *(r.randrange(-5, 99) for _ in range(dims)), r.choice([7, 2**40, 2**64 - 1]), r.randrange(99), 0) for _ in range(n))
    whole = head + image + bytes(at - 104) + table
    return [None, b"", whole[: r.randrange(len(whole))], b"XIS\0" + whole[4:]][kind] if kind < 4 else whole


def test_same_as_alone():
    r = random.Random(1)
    all_of = [container(r) or b"" for _ in range(3000)]
    sizes = np.array([len(c) for c in all_of])
    problem, counts, columns = T._small_cells(np.frombuffer(b"".join(all_of), "u1"), np.cumsum(sizes) - sizes, sizes)
    want = [row for i, c in enumerate(all_of) for b in T.index_rows(str(i), len(c), lambda at, n, c=c: c[at : at + n]) for row in b.to_pylist()]
    own = np.repeat(np.arange(len(all_of)), counts)
    assert [w["path"] for w in want] == [str(i) for i in own] and [w["problem"] for w in want] == list(problem[own])
    for f in ("offset", *T._INTS):
        assert [w[f] for w in want] == [None if problem[i] else v for i, v in zip(own, columns[f].tolist(), strict=True)], f
    assert len({p for p in problem}) == 5


def test_many_in_a_table(spark):
    r = random.Random(2)
    rows = [(str(i), container(r)) for i in range(500)] + [("large", container(random.Random(8)) + bytes(3 << 20) if container(random.Random(8)) else b"")]
    got = T.decode_tile_index(spark.createDataFrame(rows, "path string, content binary").coalesce(2)).collect()
    want = [row for p, c in rows for b in T.index_rows(p, len(c or b""), lambda at, n, c=c: (c or b"")[at : at + n]) for row in b.to_pylist()]
    assert sorted(map(repr, (x.asDict() for x in got))) == sorted(map(repr, want))
