"""Mixing to target weights with soft domains.

A softmax classifier, trained on a bounded sample of the labelled table, gives every document
posteriors over domains. Then every document gets a rate, the expected number of times it is
taken, such that the expected tokens of each domain come close to the targets: least squares over
nonnegative rates, with a small pull to the rate 1 that makes the solution unique. It is found
by projected gradient steps with momentum. Weighing documents by their tokens, the gradient at a
document depends on its posteriors alone, so documents with equal posteriors have equal rates:
posteriors are taken to a grid, tokens are summed by grid cell, and every step is one Spark
aggregation over the cells. A cell's rate is folded from the steps' residuals, a few numbers each,
which is all the driver gets.

The fixed sizes: about ``per_domain`` labelled rows a domain for training, ``STEPS`` grid steps
(comb(STEPS + domains - 1, domains - 1) cells at most). Rates count and fit all documents.

Defined cases: a null text has no words, hence no tokens; its posteriors are those of the surface of
an empty text. Labels without an id, a domain or a document don't train. Without any usable label
every document has equal posteriors over the targets' domains. Domains that no label has get the
posterior 0 and can't be reached; a target's weight must not be negative. Repeated rows are rated
alike. Empty tables give empty results; other columns pass untouched, those named as results give
way to them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint
from .arrow import map_batches, pieces
from .recompression import LETTERS as BYTE_VALUES
from .recompression import hash_mix, powers

WORDS = 1 << 16
#: Bytes of the beginnings.
PREFIXES = (3, 6)
SURFACE, BINS = 5, 10
PER_DOMAIN = 1500
STEPS = 100
#: Bytes of text that are worked on together.
LOT = 1_000_000
#: Weight of the pull to rate 1, and when the steps end.
PULL, CLOSE, MOST_STEPS = 1e-3, 1e-3, 300

RESULTS = ("n_tokens", "posterior", "domain", "rate", "copies")

LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
#: Bytes that are no capital letters, no letters, no signs (signs are what is neither letter nor digit, blank, full stop or comma).
NO_UPPER = bytes(c for c in range(256) if not 65 <= c <= 90)
NO_LETTERS = bytes(c for c in range(128) if not chr(c).isalpha())
NO_SIGNS = bytes(c for c in range(256) if c <= 32 or c >= 128 or chr(c).isalnum() or c in b".,")


def _groups(doc: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, name) pairs and how often they stand."""
    both = hash_mix(name + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(both)
    first = np.flatnonzero(_changes(both[order]))
    at = order[first]
    return doc[at], name[at], np.diff(np.append(first, len(both)))


def _changes(x: np.ndarray) -> np.ndarray:
    """Where a sorted array has a new value."""
    out = np.ones(len(x), bool)
    out[1:] = x[1:] != x[:-1]
    return out


def features_of(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Which features texts have: their distinct words and their beginnings, hashed, and bins of surface measures.

    One array for all texts, where each one's begin in it, and their numbers of tokens.
    """
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(x.translate(LETTERS) for x in raw), np.uint8)
    at = np.cumsum([0, *(len(x) + 1 for x in raw)])
    inside = np.concatenate(([False], data != 32, [False]))
    start, stop = np.flatnonzero(inside[1:-1] & ~inside[:-2]), np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
    doc = np.searchsorted(at, start, "right") - 1
    up, down = powers(len(data))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTE_VALUES[data] * up[:-1])))
    of, words, _ = _groups(doc, (sums[stop] - sums[start]) * down[start])
    width = 2 * WORDS
    key = lambda of, name: of * width + (name & np.uint64(WORDS - 1)).astype(np.int64)
    found = [key(of, hash_mix(words))]
    distinct = np.bincount(of, minlength=len(raw))
    for size in PREFIXES:
        of, begun, n = _groups(doc, (sums[np.minimum(stop, start + size)] - sums[start]) * down[start])
        for k in range(int(n.max(initial=0)).bit_length()):  # about how often they stand
            some = n >> k > 0
            found.append(key(of[some], hash_mix(begun[some] + np.uint64(16 * size + k + 1))))
    tokens, surface = [], []
    for i, (x, words, kinds) in enumerate(zip(raw, np.bincount(doc, minlength=len(raw)).tolist(), distinct.tolist(), strict=True)):
        tokens.append(len(x.split()))
        letters = len(x.translate(None, NO_LETTERS)) or 1
        shares = (len(x.translate(None, NO_UPPER)) / letters, min(1.0, 4 * len(x.translate(None, NO_SIGNS)) / (len(x) or 1)), kinds / (words or 1),
                  min(1.0, letters / (words or 1) / 20), min(1.0, math.log1p(tokens[-1]) / 12))
        surface += [i * width + WORDS + k * BINS + min(BINS - 1, int(s * BINS)) for k, s in enumerate(shares)]
    keys = np.sort(np.concatenate([*found, np.array(surface, np.int64)]))
    keys = keys[_changes(keys)]
    return keys % width, np.searchsorted(keys // width, np.arange(len(raw))), tokens


def features(text: str | None) -> tuple[np.ndarray, int]:
    x, _, tokens = features_of([text])
    return x, tokens[0]


class Softmax:
    """Softmax regression over present features, by AdaGrad, with weights drawn to zero so that few words count.

    ``prior`` has the logarithms of what sampling has left out.
    """

    def __init__(self, rows: Sequence[np.ndarray], labels: Sequence[int], domains: Sequence[str], prior: np.ndarray,
                 epochs: int = 12, rate: float = 0.15, sparse: float = 0.02):
        self.domains, k = list(domains), len(domains)
        w = np.zeros((WORDS + SURFACE * BINS, k))
        seen = np.full_like(w, 1e-2)
        order = np.random.default_rng(5)
        for _ in range(epochs):
            for i in order.permutation(len(rows)):
                x = rows[i]
                g = self._share(w[x].sum(0))
                g[labels[i]] -= 1
                seen[x] += g * g
                pace = rate / np.sqrt(seen[x])
                v = w[x] - pace * g
                w[x] = np.sign(v) * np.maximum(0, np.abs(v) - pace * sparse)
        self.weights, self.prior = w.astype(np.float32), prior

    @staticmethod
    def _share(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max())
        return e / e.sum()

    def posteriors(self, x: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Of texts whose features stand one after another; each has some."""
        z = np.add.reduceat(self.weights[x], begin, axis=0, dtype=np.float64) + self.prior
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", domain_col: str = "domain",
          per_domain: int = PER_DOMAIN) -> Softmax | None:
    """A classifier of the labelled documents; None without any. The sample is chosen by a hash of the id."""
    known = labels.select(F.col(id_col).alias("_id"), F.col(domain_col).cast("string").alias("domain")).where("_id IS NOT NULL AND domain IS NOT NULL").distinct()
    counts = {r.domain: r["count"] for r in known.groupBy("domain").count().collect()}
    cut = F.lit(0)
    for domain, n in counts.items():
        cut = F.when(F.col("domain") == domain, int(min(1.0, per_domain / n) * 2**32)).otherwise(cut)
    some = known.where(F.pmod(F.xxhash64("_id", F.lit(3)), F.lit(2**32)) < cut)  # bounded by per_domain, so it may be broadcast

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            yield {"domain": b.column(1), "x": [features(t)[0].tobytes() for t in b.column(0).to_pylist()]}

    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    sample = texts.join(F.broadcast(some), "_id").select("text", "domain")
    # A document that many rows repeat trains once.
    once = sample.dropDuplicates(["text", "domain"])
    rows = sorted(map_batches(once, run, "domain string, x binary").collect(), key=lambda r: (r.domain, bytes(r.x)))
    domains = sorted({r.domain for r in rows})
    if not domains:
        return None
    at = [domains.index(r.domain) for r in rows]
    share = np.array([counts[d] for d in domains], float) / np.bincount(at, minlength=len(domains))
    return Softmax([np.frombuffer(r.x, np.int64) for r in rows], at, domains, np.log(share / share.sum()))


def posteriors(docs: DataFrame, model: Softmax | None, domains: Sequence[str], *, text_col: str = "text", steps: int = STEPS) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``posterior``: the domains' shares in whole ``steps``-ths, which sum up to ``steps``."""
    given = docs.columns
    at = given.index(text_col)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = list(domains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        own = sent.value
        place = [names.index(d) if d in names else None for d in own.domains] if own else []
        for batch in batches:
            for b in pieces(batch, text_col, LOT):
                x, begin, tokens = features_of(b.column(at).to_pylist())
                p = np.zeros((b.num_rows, len(names)))
                for k, d in enumerate(own.posteriors(x, begin).T if own else ()):
                    if place[k] is not None:
                        p[:, place[k]] += d
                total = p.sum(1, keepdims=True)
                p = np.where(total > 0, p / np.where(total > 0, total, 1), 1 / len(names))
                edge = np.floor(np.cumsum(p, axis=1) * steps + 0.5).astype(np.int64)
                edge[:, -1] = steps
                yield {c: b.column(i) for i, c in enumerate(given)} | {"n_tokens": tokens, "posterior": np.diff(edge, axis=1, prepend=0).tolist()}

    return map_batches(docs, run, docs.select("*", F.lit(None).cast("bigint").alias("n_tokens"), F.lit(None).cast("array<int>").alias("posterior")).schema)


def _folded(history: list[tuple[list[float], float]], steps: int, pull: float) -> Column:
    """The state of a cell after the steps of ``history`` (residuals and momentum): rate, the point ahead of it, and both before."""
    start = F.struct(*(F.lit(1.0).alias(n) for n in ("rate", "ahead", "rate0", "ahead0")))
    if not history:
        return start
    taken = F.array(*(F.struct(F.array(*(F.lit(float(x)) for x in residual)).alias("residual"), F.lit(float(momentum)).alias("momentum")) for residual, momentum in history))

    def step(s: Column, h: Column) -> Column:
        slope = F.aggregate(F.zip_with(h["residual"], F.col("posterior"), lambda r, p: r * p / steps), F.lit(0.0), lambda a, x: a + x) + pull * (s["ahead"] - 1)
        rate = F.greatest(F.lit(0.0), s["ahead"] - slope / (1 + pull))
        return F.struct(rate.alias("rate"), (rate + h["momentum"] * (rate - s["rate"])).alias("ahead"), s["rate"].alias("rate0"), s["ahead"].alias("ahead0"))

    return F.aggregate(taken, start, step)


def fit_rates(cells: DataFrame, weights: Sequence[float], budget: float, *, steps: int = STEPS, pull: float = PULL, close: float = CLOSE, most_steps: int = MOST_STEPS) -> tuple[Column, list[float]]:
    """The rate of a cell as a column of ``posterior``, and the expected share of the budget for each domain.

    ``cells``: ``posterior, tokens``. One aggregation a step. Misses count relative to a domain's tokens,
    now or wanted, whichever are more; with shares that sum up to one, a step of 1 is then
    safe. The last steps change no domain by more than ``close`` of that.
    """
    target = np.array(weights, float) / sum(weights)
    total = cells.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    history: list[tuple[list[float], float]] = []
    if not total or not budget:
        return F.lit(1.0), [0.0] * len(weights)
    share, momentum, got, calm = F.col("tokens") / total, 1.0, None, 0
    wanted = target * budget / total
    for n in range(most_steps + 1):
        state = F.col("s")
        sums = lambda point: [F.sum(share * state[point] * F.get("posterior", F.lit(k)) / steps) for k in range(len(weights))]
        back = F.sum(share * (state["ahead0"] - state["rate"]) * (state["rate"] - state["rate0"]))
        row = cells.withColumn("s", _folded(history, steps, pull)).agg(*sums("ahead"), *sums("rate"), back).first()
        ahead, now = np.array(row[: len(weights)]), np.array(row[len(weights) : -1])
        if got is None:
            scale = 1 / np.maximum(np.maximum(now, wanted), 1e-12)
        calm = calm + 1 if got is not None and (scale * np.abs(now - got)).max() < close else 0
        got = now
        if calm >= 3 or n == most_steps:
            break
        if row[-1] > 0:  # the last step went back: momentum starts afresh
            momentum = 1.0
            ahead = now
            history[-1] = (history[-1][0], 0.0)
        after = (1 + math.sqrt(1 + 4 * momentum * momentum)) / 2
        history.append(((scale * (ahead - wanted)).tolist(), (momentum - 1) / after))
        momentum = after
    return _folded(history, steps, pull)["rate"], (got * total / budget).tolist()


def mix(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float | None], *, id_col: str = "doc_id", text_col: str = "text", domain_col: str = "domain",
        budget: float | None = None, per_domain: int = PER_DOMAIN, steps: int = STEPS, pull: float = PULL) -> DataFrame:
    """``docs`` with ``n_tokens``, ``posterior`` (shares in the targets' order), ``domain`` (the likeliest), ``rate`` and ``copies``.

    A weight of None is the domain's share of the expected tokens as they stand. If all others are 0, what has no part in those
    is thus taken once or more. ``budget`` tokens are wanted in all, by default as many as there are. A small ``pull`` meets the targets
    closely, if need be by rates far from 1; a larger one keeps rates near 1 where posteriors say little.
    ``copies`` is the rate,
    rounded up or down by a hash of the document.
    """
    docs = docs.drop(*RESULTS)
    given = [w for w in targets.values() if w is not None]
    if not targets or min(given, default=0) < 0 or (len(given) == len(targets) and not sum(given)):
        raise ValueError("targets are nonnegative weights, one above 0 at least")
    domains = list(targets)
    model = train(docs, labels, id_col=id_col, text_col=text_col, domain_col=domain_col, per_domain=per_domain)
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.col(text_col).alias("text"))
    scored = checkpoint(posteriors(keyed, model, domains, text_col="text", steps=steps).drop("text"))
    cells = checkpoint(scored.groupBy("posterior").agg(F.sum("n_tokens").alias("tokens")))
    stand = [F.sum(F.col("tokens") * F.get("posterior", F.lit(k)) / steps) for k in range(len(domains))]
    total, *shares = (x or 0 for x in cells.agg(F.sum("tokens"), *stand).first())
    weights = [x / (total or 1) if targets[d] is None else targets[d] for d, x in zip(domains, shares, strict=True)]
    if total and not sum(weights):  # nothing that is wanted is there
        rate = F.lit(0.0)
    else:
        rate, _ = fit_rates(cells, weights if sum(weights) else [1.0] * len(weights), float(total if budget is None else budget), steps=steps, pull=pull)
    rates = checkpoint(cells.select("posterior", rate.alias("rate")))
    if math.comb(steps + len(domains) - 1, len(domains) - 1) <= 200_000:  # so many cells at most
        rates = F.broadcast(rates)
    shares = F.transform("posterior", lambda p: p / steps)
    likeliest = F.array_position("posterior", F.array_max("posterior")).cast("int")
    chance = F.pmod(F.xxhash64(F.col("row")[id_col], F.col("row")[text_col], F.lit(17)), F.lit(2**32)) / 2**32
    return scored.join(rates, "posterior").select(
        "row.*", "n_tokens", shares.alias("posterior"), F.get(F.array(*map(F.lit, domains)), likeliest - 1).alias("domain"), "rate",
        (F.floor("rate") + F.when(chance < F.col("rate") - F.floor("rate"), 1).otherwise(0)).cast("bigint").alias("copies"))


def label_domains(labels: DataFrame) -> DataFrame:
    """``doc_id, domain`` of the quality and toxicity labels: toxic, else good or poor."""
    return labels.select("doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor").alias("domain"))
