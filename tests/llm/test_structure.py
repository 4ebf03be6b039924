"""Structure repair against a search over all edits, block by block and over many partitions."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from cohortspark.llm import structure as s
from cohortspark.llm.structure_queries import damaged

TURNS = "conv_id bigint, turn bigint, role string, text string"
LEGAL = re.compile("(s?(ua)+)?")


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        left = text.rstrip(s.SPACE)
        out.append("blank" if not left else "duplicate" if (role, text) in seen else "" if left[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, bad):
    """(cost, edits, repaired): all edits and up to two insertions at each place, as far as they begin a legal conversation."""
    begun = re.compile("s?(ua)*u?")
    now = [(0, "", ())]
    for k in range(len(rows) + 1):
        grown = list(now)
        for n in (1, 2):
            for names in itertools.product(("user", "assistant"), repeat=n):
                grown += [(c + 5 * n, a + "I" * n, (*r, *((x, "") for x in names))) for c, a, r in now]
        if k == len(rows):
            now = [x for x in grown if LEGAL.fullmatch("".join(role[:1] or "-" for role, _ in x[2]))]
            break
        _, role, text = rows[k]
        after = []
        for c, a, r in grown:
            after.append((c + 2, a + "D", r))
            if bad[k] in ("", "truncated"):
                more = 5 if bad[k] else 0
                after.append((c + more, a + "K", (*r, (role, text))))
                after += [(c + more + 1, a + "R", (*r, (x, text))) for x in ("user", "assistant")]
        now = [x for x in after if begun.fullmatch("".join(role[:1] or "-" for role, _ in x[2]))]
    c, a, r = min(now)
    return c, a, "\n".join(f"{role}:{text}" for role, text in r)


def summary(rows):
    """Of ``(turn, role, text)`` in order."""
    bad = faults(rows)
    turns = [t for t, _, _ in rows if t is not None]
    cost, audit, repaired = cheapest(rows, bad)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(bad.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
            hashlib.sha256(repaired.encode()).hexdigest())


def plain_dp(rows):
    """Costs and edits alone, from the end, with strings kept in full: for long conversations."""
    bad = faults(rows)
    chosen, by = {0: 2, 1: 2, 2: 3, 3: 2}, {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
    g = [(0, ""), (10, "II"), (5, "I"), (0, "")]
    for (_, role, _), f in zip(reversed(rows), reversed(bad), strict=True):
        b = []
        for q in range(4):
            o = [(g[q][0] + 2, "D" + g[q][1])]
            if f in ("", "truncated"):
                more = 5 if f else 0
                if q in by.get(role[:1], {}):
                    n = by[role[:1]][q]
                    o.append((g[n][0] + more, "K" + g[n][1]))
                o.append((g[chosen[q]][0] + more + 1, "R" + g[chosen[q]][1]))
            b.append(min(o))
        g = [min(b[q], (b[chosen[q]][0] + 5, "I" + b[chosen[q]][1]), (b[chosen[chosen[q]]][0] + 10, "II" + b[chosen[chosen[q]]][1])) for q in range(4)]
    return g[0]


def random_rows(rng, n):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", " ", "us"]
    texts = ["a.", "b!", "c", " ", "", "d? ", "e.\n", "f", "g."]
    return [(rng.choice([None, *range(n)]), rng.choice(roles), rng.choice(texts) + ("" if rng.random() < 0.5 else f"{rng.randrange(9)}.")) for _ in range(n)]


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def got(df):
    return {r.conv: tuple(r)[1:] for r in s.summaries(df).collect()}


@pytest.mark.parametrize(("seed", "block", "partitions"), [(1, 4, 3), (2, 1, 1), (3, 3, 9)])
def test_against_all_edits(spark, seed, block, partitions):
    rng = random.Random(seed)
    convs = {c: random_rows(rng, rng.randrange(1, 5)) for c in range(40)}
    df = spark.createDataFrame([(c, *r) for c, rows in convs.items() for r in rows], TURNS)
    found = got(s.repair_structure(df, block=block, partitions=partitions))
    assert found == {str(c): summary(in_order(rows)) for c, rows in convs.items()}


def test_tables_agree_with_costs_in_full():
    rng = random.Random(5)
    for block in (1, 2, 4):
        t = s.Tables(block)
        for n in (0, 1, 3, 4, 9, 300):
            rows = random_rows(rng, n)
            symbols = np.array([s._symbol(r[1], f) for r, f in zip(rows, faults(rows), strict=True)], np.int64)
            edits, state = t.trace(symbols)
            _, want = plain_dp(rows)
            assert "".join(edits) + s.LAST_EDITS[state] == want
            assert t.transfer(symbols)[0] == t.behind(symbols)[1]
    assert len(s.Tables().vectors) < 200


def test_a_conversation_over_many_partitions(spark):
    rng = random.Random(7)
    rows = [(i, *r[1:]) for i, r in enumerate(random_rows(rng, 700))]
    rows = [(t, role, f"{text}{t % 90}{'.' if t % 7 else ''}") for t, role, text in rows]
    others = [(c, i, "user", "x.") for c in (0, 2) for i in range(30)]
    df = spark.createDataFrame([(1, *r) for r in rows] + others, TURNS)
    for held in (s.HELD, 500):
        repaired = s.repair_structure(df, partitions=8, held_bytes=held)
        assert repaired.where("conv = '1'").select("part").distinct().count() > 2
        one = got(repaired)["1"]
        assert one[5:7] == plain_dp(rows) and one[:4] == (0, *(faults(rows).count(f) for f in ("blank", "duplicate", "truncated")))


def test_defined_cases(spark):
    rows = [(None, 0, "user", "x."), (None, 1, "assistant", "y."), (1, 0, "user", None), (2, 0, None, "a."), (3, 0, "user", "b."), (3, 0, "user", "b."), (4, None, "user", "q."),
            (4, 3, "assistant", "z."), (5, 0, "user", "long " * 400_000 + "."), (5, 1, "assistant", "w.")]
    df = spark.createDataFrame([(*r, "p", 1, "f") for r in rows], f"{TURNS}, part string, at int, fault string")
    found = got(s.repair_structure(df))
    assert {c: v[:7] for c, v in found.items()} == {
        None: (0, 0, 0, 0, 0, 0, "KK"), "1": (0, 1, 0, 0, 0, 2, "D"), "2": (0, 0, 0, 0, 0, 2, "D"), "3": (0, 0, 1, 0, 1, 4, "DD"), "4": (0, 0, 0, 0, 0, 0, "KK"), "5": (0, 0, 0, 0, 0, 0, "KK")}
    assert got(s.repair_structure(df.limit(0))) == {}


def test_damage_is_by_checksum(spark):
    import zlib

    rows = [(c, t, r, x) for c in range(30) for t, r, x in ((0, "system", "a. b!"), (1, "user", "q?"), (None, "assistant", None))]
    want = []
    for c, t, r, x in rows:
        k, x = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20, " " if x is None else x
        if k:
            x = "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 else x
            want += [(c, t, "user" if k == 4 else r, x)] * (2 if k == 3 else 1)
    key = lambda r: (r[0], r[1] is not None, r[1] or 0, r[2], r[3])
    assert sorted((tuple(r) for r in damaged(spark.createDataFrame(rows, TURNS)).collect()), key=key) == sorted(want, key=key)
