"""Secret scans against a plain scan with recounted windows."""

import math
import random
import re
import string
from collections import Counter

import pytest

from cohortspark.llm import secrets as s

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def plain(text):
    text = text or ""
    base = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    base += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    base += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    fresh = []
    for m in re.finditer(s.CANDIDATE, text):
        if any(re.search(p, m[0]) for p in s.ALLOWED):
            continue
        bits = next(c.bits for c in s.CLASSES if re.search(c.pattern, m[0]))
        spans = []
        for i in range(len(m[0]) - s.WINDOW + 1):
            n = Counter(m[0][i : i + s.WINDOW]).values()
            if -sum(x / s.WINDOW * math.log2(x / s.WINDOW) for x in n) >= bits:
                a, b = m.start() + i, m.start() + i + s.WINDOW
                if spans and spans[-1][1] >= a:
                    spans[-1][1] = b
                else:
                    spans.append([a, b])
        fresh += [(a, 3, b, "entropy") for a, b in spans if not any(x[0] <= a and b <= x[2] for x in base)]
    return [(k, a, b, text[a:b]) for a, _, b, k in sorted(base + fresh)]


def random_texts(seed):
    rng = random.Random(seed)
    bits = ["password=", 'Token: "', "api_key = '", "secret:", "AKIA", "password=token:", "é", "ſecret=", " ", "\n", "toKen==", "passwd"]
    sets = [string.ascii_letters + string.digits, string.hexdigits, "0123456789abcdef", string.ascii_letters + string.digits + "+/_-", "abcde", string.ascii_uppercase + string.digits]
    return ["".join(rng.choice(bits) if rng.random() < 0.4 else "".join(rng.choice(rng.choice(sets[i % 6 :] or sets)) for _ in range(rng.randrange(45))) for _ in range(14)) for i in range(120)]


def got(df):
    return [(r.doc_id, [tuple(x) for x in r.secrets]) for r in df.orderBy("doc_id").collect()]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_plain_scan(make_docs, seed):
    texts = random_texts(seed)
    assert got(s.find_secrets(make_docs(texts).withColumnRenamed("lang", "spans"))) == [(i, plain(t)) for i, t in enumerate(texts)]
    assert sum(len([x for x in plain(t) if x[0] == "entropy"]) for t in texts) > 20


def test_defined_cases(make_docs):
    texts = [None, "", "plain words here", "x" * 100_000, "password=" + "k9Q" * 20_000, "héé password: 'abcDEF123456.=' end", "password=short token=abcdefghijkl"]
    assert got(s.find_secrets(make_docs(texts))) == [(i, plain(t)) for i, t in enumerate(texts)]
    assert s.find_secrets(make_docs([])).count() == 0
    assert got(s.find_secrets(make_docs(texts).withColumnRenamed("lang", "secrets"))) == [(i, plain(t)) for i, t in enumerate(texts)]


def test_allow_list(make_docs):
    token = "Zk3xQ9vT7bLm2Rw8YpN4sD6f"
    kinds = lambda t, **k: [x[0] for x in got(s.find_secrets(make_docs([t]), **k))[0][1]]
    assert kinds(f"see {token} there") == ["entropy"]
    assert kinds(f"see {token} there", allowed_strings=[token]) == []
    assert kinds("id 123e4567-e89b-42d3-a456-426614174000 and EXAMPLEZk3xQ9vT7bLm2Rw8 and some/long/path-of-words/here") == []


def test_no_python_in_the_plan(make_docs):
    plan = s.find_secrets(make_docs(["a"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_weights_are_exact():
    assert s.weights()[:3] == [0, 0, 2_000_000_000]


@pytest.mark.parametrize("text", [
    "ab-" * 200_000, "a/1_" * 100_000, "password" + " " * 1_000_000 + "=abcdefghijklmnop", "AKIA" + "A1" * 500_000, "0f" * 500_000, "12345678-1234-" * 70_000, "x" * 1_000_000,
    "-" * 1_000_000, "example" * 150_000], ids=lambda t: t[:9])
def test_patterns_on_a_megabyte(make_docs, text):
    n = len(text)
    want = {"p": [("assign", 0, n)], "A": [("access", 0, n)], "0": [("hex", 0, n)]}.get(text[0], [])
    assert [x[:3] for x in got(s.find_secrets(make_docs([text])))[0][1]] == want


def test_texts_dense_with_secrets(make_docs):
    import hashlib
    import time

    keys = [hashlib.md5(str(i).encode()).hexdigest() for i in range(16_000)]
    texts = [" ".join(keys), " ".join(f"Zk3xQ9vT7bLm2Rw8YpN4sD6f{k[:6]}" for k in keys[:2000])]
    begun = time.time()
    found = got(s.find_secrets(make_docs(texts)))
    assert time.time() - begun < 60  # quadratic work would take minutes
    assert found[0][1] == [("hex", 33 * i, 33 * i + 32, k) for i, k in enumerate(keys)]
    assert found[1][1] == plain(texts[1])


def test_words_between_signs_are_allowed():
    flat, nested = s.ALLOWED[1], r"^[A-Za-z]*([/_-]+[A-Za-z]+|[/_-]+[0-9]{1,4})+[/_-]*$"
    rng = random.Random(11)
    seen = set()
    for _ in range(20_000):
        value = "".join(rng.choice("aB1/_-+" if rng.random() < 0.9 else "1111") for _ in range(rng.randrange(1, 9)))
        seen.add(bool(re.search(flat, value)))
        assert bool(re.search(flat, value)) == bool(re.search(nested, value))
    assert seen == {True, False}
