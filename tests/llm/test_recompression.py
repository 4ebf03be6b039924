"""Substring dedup against brute force, with many small blocks and buckets."""

import random

import numpy as np
import pyarrow as pa
import pytest

from cohortspark.llm.recompression import Block, Words, parse, remove_repeats


def plain(rows, w=13):
    first = {}
    words = [(d, (t or "").encode().split()) for d, t in rows]
    for d, ws in words:
        for i in range(len(ws) - w + 1):
            g = tuple(ws[i : i + w])
            key = float("inf") if d is None else d
            first[g] = min(first.get(g, float("inf")), key)
    out = []
    for d, ws in words:
        gone = {j for i in range(len(ws) - w + 1) if first[tuple(ws[i : i + w])] < (float("inf") if d is None else d) for j in range(i, i + w)}
        out.append((d, len(ws), len(gone), b" ".join(x for j, x in enumerate(ws) if j not in gone).decode()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.id, r.n_words, r.n_removed, r.kept) for r in df.collect()), key=str)


def corpus(seed, n=60, vocabulary=4):
    """Texts over few words, so that runs, periods and chance repeats abound."""
    rng = random.Random(seed)
    passage = " ".join(f"p{rng.randrange(30)}" for _ in range(40))
    out = []
    for i in range(n):
        words = [rng.choice("abcd"[:vocabulary]) for _ in range(rng.randrange(60))]
        if i % 3 == 0:
            words += ["x"] * rng.randrange(40) + ["y", "z"] * rng.randrange(12)
        if i % 4 == 0:
            words.insert(rng.randrange(len(words) + 1), passage)
        out.append((rng.randrange(40) if i % 7 == 0 else i, "\t ".join(words) if i % 2 else " ".join(words)))
    return out


@pytest.mark.parametrize("seed,vocabulary,block_bytes", [(1, 4, 300), (2, 2, 900), (3, 3, 4_000_000)])
def test_against_brute_force(spark, make_docs, seed, vocabulary, block_bytes):
    rows = corpus(seed, vocabulary=vocabulary)
    df = make_docs(rows).withColumnRenamed("source", "block").withColumnRenamed("lang", "id").repartition(3)
    assert got(remove_repeats(df, block_bytes=block_bytes, bucket_bytes=1500)) == plain(rows)


def test_defined_cases(make_docs):
    long = " ".join(f"w{i % 700}" for i in range(30000))
    copy = " ".join(f"u{i}" for i in range(14))
    rows = [(4, None), (5, ""), (6, " \n\t "), (7, copy), (3, copy), (3, copy), (None, copy), (None, copy), (8, long), (9, "é " + copy + " ñ x"), (10, "one two"), (2, long)]
    assert got(remove_repeats(make_docs(rows), block_bytes=200)) == plain(rows)
    assert got(remove_repeats(make_docs([]))) == []


def test_words_are_those_of_split():
    texts = [None, "", "a", " b\x0b\x0ccc ", "d e", "ff", "gg hh"]
    w = Words(pa.array(texts))
    got = [w.data[a:b].tobytes() for a, b in zip(w.start, w.stop)]
    assert got == [x for t in texts for x in (t or "").encode().split()]
    assert w.doc.tolist() == [i for i, t in enumerate(texts) for _ in (t or "").encode().split()]
    names = Words(pa.array(["aa b aa", "b aa"])).names()
    assert names[0] == names[2] == names[4] and names[1] == names[3] != names[0]


def test_equal_words_give_equal_symbols():
    """Wherever the words of a symbol's interval stand, the symbol stands too."""
    rng = np.random.default_rng(4)
    for _ in range(40):
        inner = rng.integers(0, 3, 30).astype(np.uint64)
        seen = []
        for _ in range(4):
            a, b = rng.integers(0, 3, (2, 12)).astype(np.uint64)
            names = np.concatenate((a, inner, b))
            name, _, low, high = parse(names, np.zeros(len(names), np.int64))
            seen.append({(int(n), int(x) - 12, int(y) - 12) for n, x, y in zip(name, low, high) if x >= 12 and y <= 42})
        assert all(s == seen[0] for s in seen)


def test_few_windows_are_left_to_verify():
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(500)}" for _ in range(300)) for _ in range(20)]
    b = Block(pa.array(texts), pa.array(range(20), pa.int64()), 13)
    assert len(b.candidates(np.zeros(len(b.unique), bool))) < 0.02 * len(b.words)
