"""SimHash near-duplicates against brute force."""

import random

import numpy as np
import pytest
import xxhash

from cohortspark.llm.simhash import Planes, band_hashes, band_keys, block_keys, bucket_links, fingerprint, jaccard, links, near_duplicates, shingle_hashes, shingle_set, similar_documents

FOLDER = "/root/testdata/sf0.001"


def plain_fingerprint(text, k):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(rows, k=4, radius=4):
    fps = [plain_fingerprint(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d, fps[i], low.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def got(df):
    return sorted(((r.doc, r.fp[0] % 2**64, r.component) for r in df.collect()), key=str)


def near(text, rng, n=1):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = "changed"
    return " ".join(words)


def test_defined_cases(make_docs):
    rng = random.Random(3)
    base = " ".join(f"w{rng.randrange(900)}" for _ in range(400))
    rows = [(5, base), (3, base), (9, near(base, rng)), (2, near(base, rng)), (7, None), (8, ""), (1, " \t\n"), (11, "One two"), (12, "one  two"),
            (None, base), (None, None), (3, base), (20, "x " * 3000), (21, "ünï cødé wörds hére")]
    assert got(near_duplicates(make_docs(rows).withColumnRenamed("source", "node"))) == plain_components(rows)


def test_empty_table(make_docs):
    assert got(near_duplicates(make_docs([]))) == []


@pytest.mark.parametrize("bucket", [4096, 7])
def test_no_link_is_lost(spark, bucket):
    rng = random.Random(1)
    seeds = [rng.getrandbits(64) for _ in range(40)]
    fps = list({s ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(9))) for s in seeds for _ in range(12)})
    classes = spark.createDataFrame([(i, [f - 2**64 if f >> 63 else f]) for i, f in enumerate(fps)], "node bigint, fp array<bigint>")
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for r in links(classes, block_keys(4, 6), 4, bucket).collect():
        assert (fps[r.u] ^ fps[r.v]).bit_count() <= 4
        root[find(r.u)] = find(r.v)
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                assert find(i) == find(j)


@pytest.mark.parametrize("width,radius", [(1, 4), (1, 3), (1, 7), (4, 44)])
def test_vertical_counters(width, radius):
    rng = np.random.default_rng(width + radius)
    fps = rng.integers(0, 2**64, (300, width), np.uint64)
    fps[1::3] = fps[:-1:3] ^ (np.uint64(1) << rng.integers(0, 64, (100, width), np.uint64))
    planes = Planes(fps)
    for shift in (1, 2, 63, 64, 65, 200):
        lanes = np.arange(300) + shift < 300
        want = [i for i in range(300 - shift) if np.bitwise_count(fps[i] ^ fps[i + shift]).sum() <= radius]
        assert planes.close(shift, lanes, radius).tolist() == want


def test_bucket_links_stay_inside():
    fps = np.zeros((6, 1), np.uint64)
    assert sorted(bucket_links(np.array([2, 1, 3]), fps, 4)) in ([(0, 1), (3, 4), (3, 5)], [(0, 1), (3, 4), (4, 5)])


def test_wide_fingerprints_find_copies(make_docs):
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(5000)}" for _ in range(300)) for _ in range(30)]
    rows = list(enumerate(texts + [near(t, rng, 3) for t in texts]))
    found = near_duplicates(make_docs(rows), words=5, width=4, radius=44, tables=band_keys(4))
    assert sorted((r.doc, r.component) for r in found.collect()) == [(i, i % 30) for i in range(60)]


def test_fingerprint_of_long_text():
    text = "a b c d e f g " * 30000
    assert fingerprint(shingle_hashes(text, 4))[0] % 2**64 == plain_fingerprint(text, 4)


def test_query(spark):
    from cohortspark.llm.load import QUERIES

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    mine = sorted(((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in QUERIES["op8_simhash"](spark, FOLDER).collect()), key=str)
    assert mine == plain_components(rows)


def by_similarity(rows, least=0.8, words=5):
    sets = [set(shingle_set(t, words).tolist()) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d, low.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def alike(rng, n, similarity):
    """Two texts of ``n`` shingles each, all distinct, that have about ``similarity`` of them in common."""
    words = [f"w{rng.randrange(10**9)}" for _ in range(n + 4)]
    own = round(n * (1 - similarity) / (1 + similarity))
    return " ".join(words), " ".join(words[:-own] + [f"x{rng.randrange(10**9)}" for _ in range(own)])


def test_links_hold_by_exact_similarity(make_docs):
    rng = random.Random(8)
    rows = [(2 * k + side, t) for k in range(120) for side, t in enumerate(alike(rng, 300, (0.7, 0.75, 0.79, 0.82, 0.9)[k % 5]))]
    out = {r.doc: r.component for r in similar_documents(make_docs(rows)).collect()}
    for k in range(120):
        assert (out[2 * k + 1] == 2 * k) == (jaccard(*(shingle_set(t, 5) for _, t in rows[2 * k : 2 * k + 2])) >= 0.8)


@pytest.mark.parametrize(("bucket", "side"), [(4096, 64), (16, 2)])
def test_further_links_where_the_first_fail(make_docs, bucket, side):
    rng = random.Random(9)
    rows = [(None, None), (900, ""), (901, "one two"), (902, "One  two"), (None, "one two"), (903, "a b c d e " * 400 + "x y z q r"), (904, "a b c d e " * 400 + "k l m n o p")]
    for k in range(4):
        base = [f"w{rng.randrange(10**9)}" for _ in range(300)]
        for j in range(12):
            cut = rng.randrange(0, 75)
            rows.append((100 * k + j, " ".join(base[: 300 - cut] + [f"y{rng.randrange(10**9)}" for _ in range(cut)])))
    rng.shuffle(rows)
    out = similar_documents(make_docs(rows), bands=64, rows=1, radius=110, bucket=bucket, side=side)
    assert sorted(((r.doc, r.component) for r in out.collect()), key=str) == by_similarity(rows)


def test_similar_documents_of_an_empty_table(make_docs):
    assert similar_documents(make_docs([])).count() == 0


def test_bands_meet_by_similarity():
    rng = random.Random(4)
    for similarity, low, high in ((0.8, 0.98, 1), (0.3, 0, 0.08), (0.05, 0, 0)):
        met = [bool(set(band_hashes(a, 24, 6).tolist()) & set(band_hashes(b, 24, 6).tolist()))
               for a, b in ((shingle_set(x, 5), shingle_set(y, 5)) for x, y in (alike(rng, 200, similarity) for _ in range(150)))]
        assert low <= sum(met) / len(met) <= high
    assert len(band_hashes(shingle_set("", 5), 24, 6)) == 0


def test_a_large_bucket_loses_no_link(make_docs):
    """Chains of texts, each only like its neighbours, that all meet in the same bands; parts of five rows."""
    rng = random.Random(12)
    common = [f"c{rng.randrange(10**9)}" for _ in range(300)]
    rows = []
    for chain in range(4):
        text = common[:150] + [f"d{rng.randrange(10**9)}" for _ in range(150)]
        for j in range(10):
            rows.append((100 * chain + j, " ".join(text)))
            text[150 + 14 * j : 164 + 14 * j] = [f"e{rng.randrange(10**9)}" for _ in range(14)]
    rng.shuffle(rows)
    out = similar_documents(make_docs(rows), bands=64, rows=1, radius=120, bucket=5)
    assert sorted(((r.doc, r.component) for r in out.collect()), key=str) == by_similarity(rows)
