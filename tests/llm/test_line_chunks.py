"""Line dedup against all repeated passages, with hashes that collide and small blocks."""

import random

import pytest

from cohortspark.llm.line_chunks import marks, remove_chunks


def plain(rows, k=3):
    docs = [(d, t, [] if t is None else t.split("\n"), float("inf") if d is None else d) for d, t in rows]
    first = {}
    for _, _, lines, key in docs:
        for a in range(len(lines) - k + 1):
            c = tuple(lines[a : a + k])
            first[c] = min(first.get(c, (key, a)), (key, a))
    out = []
    for d, t, lines, key in docs:
        gone = set()
        for a in range(len(lines) - k + 1):
            c = tuple(lines[a : a + k])
            if (key, a) > first[c] and any(x > " " for y in c for x in y):
                gone.update(range(a, a + k))
        out.append((d, len(lines), len(gone), None if t is None else "\n".join(x for i, x in enumerate(lines) if i not in gone)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_lines, r.n_removed, r.clean_text) for r in df.collect()), key=str)


def corpus(seed):
    rng = random.Random(seed)
    shared = [f"shared line {i}" for i in range(40)]
    out = []
    for i in range(50):
        lines = [rng.choice(["", "x", f"own {i} {rng.randrange(99)}", "again and again"]) for _ in range(rng.randrange(20))]
        if i % 2:
            a = rng.randrange(20)
            lines[rng.randrange(len(lines) + 1) : 0] = shared[a : a + rng.randrange(4, 20)]
        out.append((i if i % 9 else rng.randrange(60), "\n".join(lines)))
    return out


@pytest.mark.parametrize("seed,block_bytes,digest_bits,lines", [(1, 400, 64, 3), (2, 400, 3, 3), (3, 4_000_000, 64, 2), (4, 900, 64, 5)])
def test_against_brute_force(make_docs, seed, block_bytes, digest_bits, lines):
    rows = corpus(seed)
    df = make_docs(rows).withColumnRenamed("lang", "block").withColumnRenamed("source", "rows").repartition(3)
    found = remove_chunks(df, block_bytes=block_bytes, digest_bits=digest_bits, lines=lines)
    assert got(found) == plain(rows, lines) and found.columns[:5] == df.columns
    assert sum(r[2] for r in plain(rows, lines)) > 50


def test_defined_cases(make_docs):
    text = "a one\nb two\nc three\nd four\ne five"
    rows = [(3, text), (1, text), (1, text), (None, text), (None, text), (5, None), (6, ""), (7, "\n\n\n\n"), (8, "\n\n\n\n"), (9, "one line"), (10, "one line"),
            (11, "é\nü\r\n" * 20_000), (2, "b two\nc three\nd four\ne five\nf six")]
    assert got(remove_chunks(make_docs(rows), block_bytes=100)) == plain(rows)
    assert got(remove_chunks(make_docs([]))) == []
    assert got(remove_chunks(make_docs(rows).withColumnRenamed("lang", "n_lines"))) == plain(rows)


def test_marks_follow_the_content():
    rng = random.Random(4)
    lines = [f"line {rng.random()}".encode() for _ in range(300)]
    cut = lambda x, k: {tuple(x[a : a + 2]) for a in marks([x], k)[0]}
    for k in (2, 3, 5, 9):
        whole, moved = cut(lines, k), cut(lines[:100] + [b"new"] + lines[100:], k)
        assert len(whole & moved) >= len(whole) - 3 and abs(len(whole) / 299 - 2 / k) < 0.15
        for a in range(300 - k + 1):  # every stretch has a mark that it alone decides
            assert any(tuple(lines[p : p + 2]) in whole for p in range(a, a + k - 1))


def test_recall_by_length(make_docs):
    """Planted passages between unlike lines: of three lines on all are removed, shorter ones stay."""
    rng = random.Random(6)
    fresh = lambda n: [f"own {rng.random()}" for _ in range(n)]
    for n, removed in ((2, 0), (3, 3), (5, 5), (7, 7), (10, 10)):
        passages = [fresh(n) for _ in range(20)]
        rows = [(i, "\n".join(fresh(rng.randrange(5)) + passages[i % 20] + fresh(rng.randrange(5)))) for i in range(40)]
        found = {r.doc_id: r.n_removed for r in remove_chunks(make_docs(rows), block_bytes=300).collect()}
        assert found == {i: removed if i >= 20 else 0 for i in range(40)}
