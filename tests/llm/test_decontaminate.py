"""Decontamination against brute force, with many shards and short items."""

import random
import re

import pytest

from cohortspark.llm.decontaminate import Automaton, cut_text, decontaminate, find_matches, words_of


def plain_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain(docs, items, n=10):
    out = []
    for d, t in docs:
        w, hit, found = plain_words(t), set(), set()
        for i, x in items:
            ws = plain_words(x)
            k = min(n, len(ws))
            grams = {tuple(ws[j : j + k]) for j in range(len(ws) - k + 1)} if k and i is not None else set()
            for j in range(len(w) - k + 1):
                if tuple(w[j : j + k]) in grams:
                    hit.update(range(j, j + k))
                    found.add(i)
        out.append((d, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_words, sum(h.stop - h.start for h in r.hit), list(r["items"])) for r in df.collect()), key=str)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh")
    items = [(i, " ".join(word() for _ in range(rng.choice([0, 1, 3, 9, 10, 11, 25])))) for i in range(12)]
    items = [(i, t) for i, t in items if len(t.split()) != 1] + [(None, "a b c"), (90, None), (91, "!!"), (3, "Zed zed ZED"), (92, "é ü ñ ß")]
    docs = [(i, " ".join(word() for _ in range(rng.randrange(120)))) for i in range(40)]
    docs += [(50 + k, "x y. " + (t or "").upper() + ", z " + (t or "")) for k, (_, t) in enumerate(items)]
    return docs + [(99, None), (99, ""), (None, "zed zed zed"), (None, None), (100, "É ü ñ ß é Ü ñ ß é ü ñ ß"), (101, "q " * 100_000 + "zed zed zed")], items


@pytest.mark.parametrize("seed,shard_bytes", [(1, 4_000_000), (2, 60)])
def test_against_brute_force(spark, make_docs, seed, shard_bytes):
    docs, items = corpus(seed)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    df = make_docs(docs).withColumnRenamed("lang", "start").withColumnRenamed("source", "hit")
    assert got(find_matches(df, bench, shard_bytes=shard_bytes)) == plain(docs, items)


def test_spans_are_cut(spark, make_docs):
    item = " ".join(f"t{i}" for i in range(12))
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    filler = " ".join(f"f{i}" for i in range(40))
    docs = [(1, f"Before, {filler} T0, {item[3:].upper()}!  (after)"), (2, item), (3, filler), (4, None), (5, item[: item.index(" t9")])]
    out = {r.doc_id: (r.clean_text, r.drop) for r in decontaminate(make_docs(docs).withColumnRenamed("lang", "drop"), bench).collect()}
    assert out == {1: (f"Before, {filler} !  (after)", False), 2: ("", True), 3: (filler, False), 4: (None, False), 5: (docs[4][1], False)}
    long = {r.doc_id: r.clean_text for r in decontaminate(make_docs(docs), bench, max_span=12).collect()}
    assert long[1] == docs[0][1]


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert got(find_matches(make_docs(["a b"]), none)) == [(0, 2, 0, [])]
    assert find_matches(make_docs([]), none).count() == 0


def test_longest_matches():
    a = Automaton([(1, "a b c d e"), (2, "c d e f g")], 3)
    spans, items = a.scan(words_of("x a b c d e f y d e f"))
    assert spans == [(1, 7, 5), (8, 11, 3)] and items == {1, 2}
    assert cut_text("One, two three. Four", [(1, 3)]) == "One, . Four"
