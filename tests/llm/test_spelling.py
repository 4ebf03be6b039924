"""Spelling variants against all pairs, with filters in one and in many rounds."""

import random
import re
import zlib
from collections import Counter

import pytest

from cohortspark.llm import spelling as s


def plain_words(rows, least_length=5, least_count=3, drop_every=0):
    out = Counter()
    for doc, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for w in re.findall("[a-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if drop_every and h % drop_every == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            out[w] += 1
    return {w: n for w, n in out.items() if len(w) >= least_length and n >= least_count}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(words, times=2):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    best = {w: min(near[w], key=lambda v: (-words[v], v)) for w in words if near[w]}
    form = {w: v for w, v in best.items() if words[v] >= times * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (n, len(near[w]), form.get(w), words[form[w]] if w in form else None, root(w)) for w, n in words.items()}


def got(df):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


def random_texts(seed, docs=40):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcéÀ") for _ in range(rng.randrange(4, 8))) for _ in range(40)]

    def word():
        w = rng.choice(stems)
        if rng.random() < 0.5:
            at, kind = rng.randrange(len(w) + 1), rng.randrange(3)
            w = w[:at] + (rng.choice("abcÿ") if kind else "") + w[at + (kind < 2) :]
        return w.upper() if rng.random() < 0.1 else w

    return [(i, " ".join(word() for _ in range(120))) for i in range(docs)]


@pytest.mark.parametrize(("seed", "rounds"), [(1, s.ROUND_BLOCKS), (2, 3)])
def test_against_all_pairs(make_docs, seed, rounds):
    rows = random_texts(seed)
    want = plain(plain_words(rows, drop_every=13))
    assert got(s.group_variants(make_docs(rows), drop_every=13, round_blocks=rounds)) == want
    assert sum(v[2] is not None for v in want.values()) > 20 and len({v[4] for v in want.values()}) < len(want)


def test_chains_reach_their_end(make_docs):
    counts = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "abbbb": 48, "bbbbb": 96}
    found = got(s.group_variants(make_docs([" ".join(w for w, n in counts.items() for _ in range(n))])))
    assert {w: v[4] for w, v in found.items()} == dict.fromkeys(counts, "bbbbb")
    assert found["aaaaa"] == (3, 1, "aaaab", 6, "bbbbb")


def test_ties_and_thresholds(make_docs):
    text = "wordz " * 3 + "words " * 6 + "wordy " * 6 + "wordlike " * 5 + "wordlika " * 3
    found = got(s.group_variants(make_docs([text])))
    assert found["wordz"][2:] == ("words", 6, "words")
    assert found["wordy"][2:] == (None, None, "wordy")  # the other has as many
    assert found["wordlika"][2] is None  # five are not twice three


def test_defined_cases(make_docs):
    long_word = "xyz" * 4000
    rows = [(None, "alpha alpha"), (1, None), (2, ""), (3, "ALPHA 12 alphq'alphq alphq, ÀÉÎÕÜ àéîõü"), (4, f"{long_word} {long_word}q {long_word}" * 3), (4, f"{long_word} {long_word}q {long_word}" * 3)]
    docs = make_docs(rows).withColumnRenamed("lang", "word").withColumnRenamed("source", "n")
    found = got(s.group_variants(docs))
    assert found == plain(plain_words(rows))
    assert found[long_word][1] == 2 and found["alpha"][1] == 1
    assert s.group_variants(make_docs([])).count() == 0


def test_a_text_is_cut_between_words(monkeypatch, make_docs):
    run = re.compile("[a-z]+")
    for most in (1, 2, 3, 7):
        assert [w for p in s.stretches("ab cde fghij k", run, most) for w in run.findall(p)] == ["ab", "cde", "fghij", "k"]
    assert sum(map(len, s.stretches("ab" * 50, run, 3))) == 100


def test_filters_hold_every_word():
    words = ["alpha", "beta", "gamma", "longer" * 20]
    import numpy as np

    shards = s.Shards(Counter(min(len(w), s.LONGEST) for w in words))
    lanes = np.zeros((8, shards.size), np.uint32)
    hashed = lambda w: (s._values(s._codes([w], len(w))) * s._powers(len(w))).sum(1, dtype=np.uint64)
    for w in words:
        block, bits = shards.places(hashed(w), len(w))
        for i in range(8):
            lanes[i, block] |= np.uint32(1) << (bits >> np.uint64(5 * i) & np.uint64(31)).astype(np.uint32)
    p = s.Prober(shards, 0, lanes, np.array(sorted({ord(c) for w in words for c in w}), np.uint32))
    assert all(len(p.held(hashed(w), len(w))) for w in words)
    assert (0, "alpha") in set(p.edits(["alphaa"])) and (0, "gamma") in set(p.edits(["gaama"]))
