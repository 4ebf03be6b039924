"""Personal data against plain patterns, and disclosing terms against recounting."""

import math
import random
import re

import pytest

from cohortspark.llm import sanitise as s
from cohortspark.llm.sanitise_queries import PATTERNS

ID = "doc_id bigint, text string"


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def plain_base(text):
    """The patterns as they are given, with their tests after the match."""
    out = []
    for rank, kind in enumerate(s.KINDS):
        for m in re.finditer(PATTERNS[kind], text):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(d) <= 19 and luhn(d)):
                continue
            if kind == "phone" and not 10 <= len(d) <= 15:
                continue
            out.append((m.start(), rank, m.end()))
    return sorted(out)


def plain(rows, support=2, share=0.9):
    docs = [(i, t or "") for i, t in rows]
    low = ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for _, t in docs]
    base = [s.base_spans(t) for _, t in docs]
    words = [[m for m in re.finditer("[a-z0-9À-ɏ]+", x) if len(m[0]) >= 4] for x in low]
    outside = [[m for m in w if not any(a < m.end() and m.start() < z for a, _, z, _ in b)] for w, b in zip(words, base, strict=True)]
    near = [{(e, m[0]) for a, _, z, e in b for m in o if (a - 100 <= m.start() and m.end() <= a) or (z <= m.start() and m.end() <= z + 100)} for b, o in zip(base, outside, strict=True)]
    told = set()
    for pair in set().union(*near):
        have = [k for k, n in enumerate(near) if pair in n]
        n_e, n_t = sum(any(x[3] == pair[0] for x in b) for b in base), sum(any(m[0] == pair[1] for m in w) for w in words)
        info = math.log2(len(docs) / n_e)
        if len({docs[k][1] for k in have}) >= support and info > 0 and math.log2(len(docs) * len(have) / (n_e * n_t)) >= share * info - 1e-9:
            told.add(pair)
    out = []
    for (i, _), b, o, n in zip(docs, base, outside, near, strict=True):
        terms = {t for e, t in n if (e, t) in told}
        out.append((i, sorted([(a, r, z) for a, r, z, _ in b] + [(m.start(), 4, m.end()) for m in o if m[0] in terms])))
    return out


def got(df):
    kinds = [*s.KINDS, "term"]
    return [(r.doc, [(x.start, kinds.index(x.kind), x.stop) for x in r.spans]) for r in df.orderBy("doc").collect()]


def random_text(rng, n):
    bits = ["@", ".", "+", "-", " ", " ", "(", ")", "a.b@c.de", "x@y", "1.2.3.4", "300.1.1.1", "01.002.3.255", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 123-4567", "+44.20 7946 0958", "é", "Z", "9", "77", "user", "\n"]
    return "".join(rng.choice(bits) for _ in range(n))


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(3)
    kinds = set()
    for _ in range(3000):
        text = random_text(rng, rng.randrange(1, 25))
        found = [(a, k, z) for a, k, z, _ in s.base_spans(text)]
        assert found == plain_base(text)
        kinds |= {k for _, k, _ in found}
    assert kinds == {0, 1, 2, 3}


@pytest.mark.parametrize("sign", ["a", "1", "1.", "1 ", "+1", "a@", "@a", "a.", "-", "+ ", "("])
def test_base_patterns_are_linear(sign):
    s.base_spans(sign * (1_000_000 // len(sign)))


def corpus(seed):
    rng = random.Random(seed)
    common = ["lorem", "ipsum", "dolor", "amet", "tempor", "magna"]
    people = [(f"p{k}@mail.org", [f"clue{k}x{j}" for j in range(3)]) for k in range(6)]
    rows = []
    for i in range(90):
        text = [rng.choice(common) for _ in range(rng.randrange(10, 60))]
        if rng.random() < 0.5:
            who, clues = rng.choice(people)
            at = rng.randrange(len(text))
            text[at:at] = [rng.choice(clues), who.upper() if rng.random() < 0.2 else who, rng.choice([*clues, "Ördög2"])]
        elif rng.random() < 0.1:
            text.append("clue1x1")
        rows.append((i, " ".join(text)))
    return rows + [(100 + i, t) for i, t in rows[:20]] + [(i, t) for i, t in rows[:5]]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_recounting(spark, seed):
    rows = corpus(seed)
    want = plain(rows)
    assert sorted(got(s.find_personal(spark.createDataFrame(rows, ID)))) == sorted(want)
    assert sum(k == 4 for _, v in want for _, k, _ in v) > 10


def test_copies_are_no_evidence(spark):
    rows = [(i, "call zanzibar a@b.org now") for i in range(20)] + [(30 + i, f"plain words number{i}") for i in range(20)]
    assert got(s.find_personal(spark.createDataFrame(rows, ID)))[0] == (0, [(14, 0, 21)])
    rows[0] = (0, "call zanzibar a@b.org later")
    assert (5, 4, 13) in got(s.find_personal(spark.createDataFrame(rows, ID)))[0][1]


def test_terms_are_generalised_or_removed(spark):
    rows = [(0, "zanzibar a@b.org one"), (1, "zanzibar a@b.org two")] + [(10 + i, f"zandalar text {i}") for i in range(9)]
    rows += [(2, "quxquux77 c@d.org one"), (3, "quxquux77 c@d.org two"), (4, None), (5, "")]
    df = spark.createDataFrame([(*r, "e") for r in rows], f"{ID}, clean_text string")
    clean = {r.doc_id: r.clean_text for r in s.sanitise(df).collect()}
    assert clean[0] == "zan* [EMAIL] one" and clean[2] == "[TERM] [EMAIL] one"  # others begin with zan, none look like quxquux##
    assert clean[10] == "zandalar text 0" and clean[4] is None and clean[5] == ""
    actions = {r.doc: [x.action for x in r.spans] for r in s.find_personal(df).collect()}
    assert actions[0] == ["generalise", "remove"] and actions[2] == ["remove", "remove"]


def test_defined_cases(spark):
    rows = [(None, "x@y.org"), (1, None), (2, ""), (3, "word " * 300_000 + "me@here.net"), (4, "a@b.c" * 3), (4, "a@b.c" * 3)]
    df = spark.createDataFrame([(*r, "d", 1, "s") for r in rows], f"{ID}, digest string, what int, spans string")
    found = got(s.find_personal(df))
    assert found == [(None, [(0, 0, 7)]), (1, []), (2, []), (3, [(1_500_000, 0, 1_500_011)]), *[(4, plain_base("a@b.c" * 3))] * 2]
    assert s.find_personal(df.limit(0)).count() == 0 and s.sanitise(df.limit(0)).count() == 0
    text_ids = spark.createDataFrame([("k", "x@y.org")], "doc_id string, text string")
    assert got(s.find_personal(text_ids)) == [("k", [(0, 0, 7)])]
