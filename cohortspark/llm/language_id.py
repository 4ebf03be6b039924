"""Language identification in two steps: the family first, then one-versus-one linear SVMs within it.

A text becomes a vector of hashed counts of its letters' 1-, 2- and 3-grams, at unit length after
a square root. The family model is one linear SVM a pair of families; within a family there is one
for every pair of its languages. Votes, and between equal votes the margins, decide each step.

The models are trained on a bounded sample, about ``per_language`` labelled texts of each language
at most, chosen by a hash of the text. Nothing else is bounded: whole texts are predicted, in
one pass without a shuffle. The models are broadcast; their size is ``DIMENSIONS`` times the
pairs of languages.

Defined cases: a text that is null or has no letter is ``und`` with score 0. Without training rows
every text is ``und``; with one language every text with a letter has it, with score 1. A language
without a family in ``FAMILIES`` is a family of its own. Repeated rows are judged alike. Other
columns pass untouched; those named as results give way to them.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrow import map_batches

#: Language codes of some families.
FAMILIES = {
    "germanic": ("en", "de", "nl", "da", "sv", "nb", "nn", "no", "is", "af", "lb"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "bg", "mk", "sr", "hr", "bs", "sl", "cs", "sk", "pl"),
    "uralic": ("fi", "et", "hu"),
    "baltic": ("lt", "lv"),
    "turkic": ("tr", "az", "kk", "uz"),
    "indic": ("hi", "bn", "mr", "ne", "ur", "pa", "gu"),
}
DIMENSIONS = 1 << 12
#: Training rows of a language.
PER_LANGUAGE = 400
#: Characters whose n-grams are counted at a time.
COUNTED = 1 << 18

LETTER = regex.compile(r"\p{L}")


def features(text: str, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Hashed n-grams of the letters in lower case; what lies between words is one blank."""
    count = np.zeros(dimensions)
    for at in range(0, len(text), COUNTED):
        part = text[max(0, at - 2) : at + COUNTED].lower()
        code = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        # Below 128 only a-z are letters; beyond, nearly all signs are.
        code = np.where((code >= 128) | ((code >= 97) & (code <= 122)), code, np.uint64(32))
        keep = np.ones(len(code), bool)
        keep[1:] = (code[1:] != 32) | (code[:-1] != 32)
        code = code[keep]
        gram = np.zeros(len(code), np.uint64)
        for n in range(1, 4):
            if len(code) < n:
                break
            gram = gram[: len(code) - n + 1] * np.uint64(0x100000001B3) + code[n - 1 :]
            hashed = (gram * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - dimensions.bit_length() + 1)
            count += np.bincount(hashed.astype(np.int64), minlength=dimensions)
    count = np.sqrt(count)
    norm = np.sqrt(count @ count)
    return count / norm if norm else count


def train_svm(x: np.ndarray, y: np.ndarray, strength: float = 1e-4, epochs: int = 12) -> tuple[np.ndarray, float]:
    """Linear SVM by dual coordinate descent on the squared hinge loss; y is 1 or -1. The last weight is the bias.

    Classes weigh alike, however many rows each has.
    """
    x = np.hstack((x, np.full((len(x), 1), 0.5)))
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    slack = 0.5 * strength / share  # 1 / (2 C) of each row
    norm = (x * x).sum(1) + slack
    a, w = np.zeros(len(x)), np.zeros(x.shape[1])
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(x)):
            new = max(0.0, a[i] - (y[i] * (w @ x[i]) - 1 + slack[i] * a[i]) / norm[i])
            if new != a[i]:
                w += (new - a[i]) * y[i] * x[i]
                a[i] = new
    return w[:-1], float(w[-1] * 0.5)


class PairwiseModel:
    """One linear SVM for every pair of classes."""

    def __init__(self, x: np.ndarray, labels: Sequence[str]):
        self.classes = sorted(set(labels))
        self.pairs = list(combinations(range(len(self.classes)), 2))
        names = np.array(labels)
        fitted = []
        for i, j in self.pairs:
            one, two = names == self.classes[i], names == self.classes[j]
            fitted.append(train_svm(x[one | two], np.where(one[one | two], 1.0, -1.0)))
        self.weights = np.array([w for w, _ in fitted], np.float32).reshape(len(fitted), x.shape[1])
        self.bias = np.array([b for _, b in fitted])

    def decide(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The class of each row, and a score from 0.5 to 1: the logistic of its weakest margin over the others."""
        margins = x @ self.weights.T + self.bias
        votes = np.zeros((len(x), len(self.classes)))
        support = np.zeros_like(votes)
        least = np.full_like(votes, np.inf)
        for k, (i, j) in enumerate(self.pairs):
            m = margins[:, k]
            for c, side in ((i, m), (j, -m)):
                votes[:, c] += side > 0
                support[:, c] += side
                least[:, c] = np.minimum(least[:, c], side)
        best = np.lexsort((support, votes), axis=1)[:, -1] if len(self.classes) > 1 else np.zeros(len(x), np.int64)
        weakest = least[np.arange(len(x)), best]
        return best, 1 / (1 + np.exp(-4 * np.maximum(weakest, 0)))


class Hierarchy:
    """The family model and the models within families."""

    def __init__(self, x: np.ndarray, labels: Sequence[str], families: Mapping[str, Sequence[str]] = FAMILIES):
        of = {lang: family for family, members in families.items() for lang in members}
        group = [of.get(lang, f"only {lang}") for lang in labels]
        self.family = PairwiseModel(x, group) if group else None
        self.within = {f: PairwiseModel(x[[g == f for g in group]], [n for n, g in zip(labels, group, strict=True) if g == f]) for f in sorted(set(group))}

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray, list[str]]:
        family, sure = self.family.decide(x)
        out, names = np.full(len(x), "", object), [self.family.classes[f] for f in family]
        for k, f in enumerate(self.family.classes):
            rows = np.flatnonzero(family == k)
            if len(rows):
                best, score = self.within[f].decide(x[rows])
                out[rows] = [self.within[f].classes[b] for b in best]
                sure[rows] *= score
        return out.tolist(), sure, names


def sample(docs: DataFrame, text_col: str, lang_col: str, per_language: int) -> DataFrame:
    """About ``per_language`` distinct labelled texts with a letter of each language at most.

    A hash of the text decides, below a cut that follows from the language's row count, so nothing
    is sorted; copies of a text are taken once.
    """
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(F.col("lang").isNotNull())
    cuts = F.lit(0)
    for lang, n in rows.groupBy("lang").count().collect():
        cuts = F.when(F.col("lang") == lang, int(min(1.0, per_language / n) * 2**32)).otherwise(cuts)
    hashed = rows.withColumn("hash", F.xxhash64("text", F.lit(11)))
    return hashed.where((F.pmod("hash", F.lit(2**32)) < cuts) & F.col("text").rlike(r"\p{L}")).dropDuplicates(["lang", "hash"]).select("text", "lang")


def train(labelled: DataFrame, *, text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE,
          dimensions: int = DIMENSIONS, families: Mapping[str, Sequence[str]] = FAMILIES) -> Hierarchy:
    """Models of the labelled rows; the driver gets the sample's vectors alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            yield {"lang": b.column(1), "x": [features(t, dimensions).astype(np.float32).tobytes() for t in b.column(0).to_pylist()]}

    rows = map_batches(sample(labelled, text_col, lang_col, per_language), run, "lang string, x binary").collect()
    rows.sort(key=lambda r: (r.lang, bytes(r.x)))
    x = np.array([np.frombuffer(r.x, np.float32) for r in rows], float).reshape(len(rows), dimensions)
    return Hierarchy(x, [r.lang for r in rows], families)


def identify(docs: DataFrame, models: Hierarchy, *, text_col: str = "text", dimensions: int = DIMENSIONS) -> DataFrame:
    """``docs`` with ``lang_pred``, ``family_pred`` and ``score``."""
    docs = docs.drop("lang_pred", "family_pred", "score")
    given = docs.columns
    at = given.index(text_col)
    sent = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            texts = b.column(at).to_pylist()
            lang, family, score = ["und"] * len(texts), [None] * len(texts), [0.0] * len(texts)
            rows = [i for i, t in enumerate(texts) if t and LETTER.search(t)] if sent.value.family else []
            for k in range(0, len(rows), 512):
                part = rows[k : k + 512]
                for i, name, s, f in zip(part, *sent.value.predict(np.array([features(texts[i], dimensions) for i in part], np.float32)), strict=True):
                    lang[i], score[i], family[i] = name, float(s), f
            yield {c: b.column(i) for i, c in enumerate(given)} | {"lang_pred": lang, "family_pred": family, "score": score}

    shape = docs.select("*", F.lit("").alias("lang_pred"), F.lit("").alias("family_pred"), F.lit(0.0).alias("score")).schema
    for name in ("lang_pred", "family_pred", "score"):
        shape[name].nullable = True
    return map_batches(docs, run, shape)


def held_out(id_col: str = "doc_id") -> Column:
    """A third of the documents, by a checksum of their id; a null id counts as an empty one."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 3 == 1
