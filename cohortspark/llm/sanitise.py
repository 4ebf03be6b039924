"""Personal data, and the terms that give it away.

Base patterns find e-mail addresses, IP addresses, card and phone numbers. Each value is a protected entity. A term
next to an entity discloses it by their pointwise mutual information,

    pmi(entity, term) = log2(documents x documents with both / (documents with entity x documents with term)),

held against the information of the entity itself, log2(documents / documents with entity): a term with
``SHARE`` of it or more all but names the entity. That takes ``SUPPORT`` different texts, so that copies of
one text are no evidence. In a text where such a term stands beside its entity every occurrence of it
is generalised to its class (the first three letters, or the digits blotted out), or removed where the class
discloses the entity as well.

Texts are read twice: once for spans, pairs and term counts, which leave as numbers and combine before they move;
and once more those texts alone that hold a disclosing term, each distinct one once, found by a bitmap of fixed size.
Nothing pairs up terms of a whole text: a mention meets the terms within ``REACH`` code points.

Defined cases: null and empty texts have no spans. Very long texts are read in stretches where terms are counted, and
base patterns are linear in them. Repeated rows count as documents, not as texts. A term that discloses
several entities is removed if one of them asks for it. Spans are ordered by start, then kind as listed, terms last. Empty tables
give empty results; other columns pass ``sanitise`` untouched, but for its result columns of that name.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, ByteType, LongType, StringType, StructField, StructType, _parse_datatype_string

from ..session import checkpoint
from .arrow import map_batches
from .spelling import stretches

#: The kinds of base spans in their order, and signs of a local part.
KINDS = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
#: The patterns, without the ways to match that lead nowhere: runs are taken whole.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile("[^0-9]+")
DIGIT = re.compile("[0-9]")

#: A term: letters and digits, this many at least. Code points to both sides of a mention that are its surroundings.
TERM = re.compile("[A-Za-z0-9À-ɏ]+")
LEAST_TERM, REACH = 4, 100
#: Different texts a pair must stand in, and the share of an entity's information that discloses it.
SUPPORT, SHARE = 2, 0.9
#: Counted terms a task holds.
HELD = 1 << 18
#: Bits of the map of texts that are read again: a megabyte, however many texts.
MAP_BITS = 23

SPAN = "struct<kind: string, start: int, stop: int>"
FOUND = "array<struct<kind: string, start: int, stop: int, action: string>>"


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(2 * d - 9 * (d > 4) for d in map(int, digits[-2::-2]))) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ with what may stand before and behind it; a match ends what the next may begin with."""
    free, at = 0, text.find("@")
    while at >= 0:
        behind = DOMAIN.match(text, at + 1)
        if behind and free < at:
            begin = free + len(text[free:at].rstrip(LOCAL))
            if begin < at:
                yield begin, behind.end()
                free = behind.end()
        # Before the next @ nothing up to this one can belong to it.
        free = max(free, at + 1)
        at = text.find("@", free)


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """``start, rank of the kind, stop, entity`` in order."""
    out = []
    if "@" in text:
        out += [(a, 0, b, f"email:{text[a:b].lower()}") for a, b in _emails(text)]
    for m in IP.finditer(text):
        if all(len(x.lstrip("0")) < 4 and int(x.lstrip("0") or 0) < 256 for x in m.groups()):
            out.append((m.start(), 1, m.end(), "ip:" + ".".join(x.lstrip("0") or "0" for x in m.groups())))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end(), f"card:{d}"))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(d := NOT_DIGIT.sub("", m[0])) <= 15:
                out.append((m.start(), 3, m.end(), f"phone:{d}"))
    return sorted(out)


def _lower(text: str) -> str:
    """A-Z alone; positions stay."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def term_class(term: str) -> str:
    """What a term is generalised to; no term has its last sign."""
    return (DIGIT.sub("#", term) if DIGIT.search(term) else term[:3]) + "*"


class Apart:
    """Tells what no base span touches."""

    def __init__(self, spans: list[tuple[int, int, int, str]]):
        self.starts, self.stops = [], []
        for a, _, b, _ in spans:
            if self.stops and a <= self.stops[-1]:
                self.stops[-1] = max(self.stops[-1], b)
            else:
                self.starts.append(a)
                self.stops.append(b)

    def __call__(self, a: int, b: int) -> bool:
        i = bisect_right(self.starts, b - 1) - 1
        return i < 0 or self.stops[i] <= a


def surroundings(low: str, spans: list[tuple[int, int, int, str]], reach: int = REACH) -> set[tuple[str, str]]:
    """(entity, term) of all terms that lie whole within reach of a mention and touch no span."""
    apart, out = Apart(spans), set()
    for start, _, stop, entity in spans:
        for a, b in ((max(0, start - reach), start), (stop, min(len(low), stop + reach))):
            for m in TERM.finditer(low, a, b):
                if m.end() - m.start() < LEAST_TERM or (m.start() == a and a and TERM.match(low[a - 1])) or (m.end() == b and b < len(low) and TERM.match(low[b])):
                    continue
                if apart(*m.span()):
                    out.add((entity, m[0]))
    return out


DOCUMENT, PAIR, COUNT, ENTITY = range(4)


def scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One reading of the texts: rows of documents with their base spans, of pairs, term counts and entities; a checkpoint without texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: dict[str, int] = {}
        empty = {"what": [], "doc": [], "digest": [], "spans": [], "entity": [], "term": [], "n": []}

        def counts() -> dict:
            k = len(held)
            return {"what": [COUNT] * k, "doc": [None] * k, "digest": [None] * k, "spans": [None] * k, "entity": [None] * k, "term": list(held), "n": list(held.values())}

        for b in batches:
            out: dict[str, list] = {c: [] for c in empty}

            def put(what, doc=None, digest=None, spans=None, entity=None, term=None, n=1, out=out):
                for c, v in zip(empty, (what, doc, digest, spans, entity, term, n), strict=True):
                    out[c].append(v)

            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                text = text or ""
                spans, low, digest = base_spans(text), _lower(text), None
                terms: set[str] = set()
                for piece in stretches(low, TERM):
                    terms.update(TERM.findall(piece))
                terms = {t for t in terms if len(t) >= LEAST_TERM}
                for t in terms:
                    held[t] = held.get(t, 0) + 1
                for t in {term_class(t) for t in terms}:
                    held[t] = held.get(t, 0) + 1
                if spans:
                    digest = hashlib.md5(text.encode("utf-8", "surrogatepass"), usedforsecurity=False).digest()
                    pairs = surroundings(low, spans)
                    for entity, term in pairs | {(e, term_class(t)) for e, t in pairs}:
                        put(PAIR, digest=digest, entity=entity, term=term)
                    for entity in {s[3] for s in spans}:
                        put(ENTITY, entity=entity)
                put(DOCUMENT, doc=doc, digest=digest, spans=[{"kind": KINDS[k], "start": a, "stop": z} for a, k, z, _ in spans])
                if len(held) > HELD:
                    yield counts()
                    held.clear()
            yield out
        if held:
            yield counts()

    shape = StructType([StructField("what", ByteType()), StructField("doc", docs.schema[id_col].dataType), StructField("digest", BinaryType()),
                        StructField("spans", _parse_datatype_string(f"array<{SPAN}>")), StructField("entity", StringType()), StructField("term", StringType()), StructField("n", LongType())])
    return checkpoint(map_batches(docs.select(id_col, text_col), run, shape))


def disclosing(scanned: DataFrame, support: int = SUPPORT, share: float = SHARE) -> DataFrame:
    """``entity, term, action`` of the terms that give an entity away."""
    of = lambda what: scanned.where(F.col("what") == what)
    total = of(DOCUMENT).agg(F.count(F.lit(1)).alias("total"))
    pairs = of(PAIR).groupBy("entity", "term", "digest").agg(F.sum("n").alias("n")).groupBy("entity", "term").agg(F.sum("n").alias("n_both"), F.count(F.lit(1)).alias("n_texts")).where(F.col("n_texts") >= support)
    entities = of(ENTITY).groupBy("entity").agg(F.sum("n").alias("n_entity"))
    terms = of(COUNT).groupBy("term").agg(F.sum("n").alias("n_term"))
    d = pairs.join(entities, "entity").join(terms, "term").join(F.broadcast(total))  # one row
    information = F.log2(F.col("total") / F.col("n_entity"))
    pmi = F.log2(F.col("total") * F.col("n_both").cast("double") / (F.col("n_entity") * F.col("n_term").cast("double")))
    told = checkpoint(d.where((information > 0) & (pmi >= share * information - 1e-9)).select("entity", "term"))
    terms, classes = told.where(~F.col("term").endswith("*")), told.where(F.col("term").endswith("*"))
    general = F.concat(F.when(F.col("term").rlike("[0-9]"), F.regexp_replace("term", "[0-9]", "#")).otherwise(F.substring("term", 1, 3)), F.lit("*"))
    classes = classes.select("entity", F.col("term").alias("general"), F.lit("remove").alias("action"))
    return terms.withColumn("general", general).join(classes, ["entity", "general"], "left").select("entity", "term", F.coalesce("action", F.lit("generalise")).alias("action"))


def _slot(digest: Column) -> Column:
    return F.shiftright(F.conv(F.hex(F.substring(digest, 1, 4)), 16, 10).cast("bigint"), 32 - MAP_BITS)


def _marked(docs: DataFrame, digests: DataFrame) -> DataFrame:
    """``docs`` with ``_hit``: false where their ``_digest`` is surely none of ``digests``.

    The map has 2 ** MAP_BITS bits in rows of 64, a table of 131,072 rows at most.
    """
    bits = digests.select(_slot(F.col("digest")).alias("slot")).groupBy(F.shiftright("slot", 6).alias("_row")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("slot").bitwiseAND(F.lit(63)).cast("int"))).alias("_bits"))
    d = docs.withColumn("_slot", _slot(F.col("_digest"))).withColumn("_row", F.shiftright("_slot", 6))
    d = d.join(F.broadcast(bits), "_row", "left")
    hit = F.coalesce(F.call_function("shiftrightunsigned", F.col("_bits"), F.col("_slot").bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1, F.lit(False))
    return d.withColumn("_hit", hit).drop("_row", "_bits", "_slot")


def term_spans(text: str, actions: dict[str, str]) -> list[dict]:
    """Occurrences of the terms apart from base spans."""
    low, apart = _lower(text), Apart(base_spans(text))
    return [{"kind": "term", "start": m.start(), "stop": m.end(), "action": actions[m[0]]} for m in TERM.finditer(low) if m[0] in actions and apart(*m.span())]


def _added(docs: DataFrame, scanned: DataFrame, text_col: str, support: int, share: float) -> DataFrame:
    """``digest, added`` of the distinct texts that hold a disclosing term beside its entity."""
    told = disclosing(scanned, support, share)
    lists = checkpoint(scanned.where(F.col("what") == PAIR).select("digest", "entity", "term").join(told, ["entity", "term"]).groupBy("digest", "term")
                       .agg(F.max("action").alias("action")).groupBy("digest").agg(F.collect_list("term").alias("terms"), F.collect_list("action").alias("actions")))
    texts = docs.select(F.col(text_col).alias("text"), F.unhex(F.md5(text_col)).alias("_digest")).where(F.col("text").isNotNull())
    once = _marked(texts, lists).where("_hit").groupBy(F.col("_digest").alias("digest")).agg(F.first("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            yield {"digest": b.column(0), "added": [term_spans(text, dict(zip(terms, actions, strict=True))) for text, terms, actions in zip(*(c.to_pylist() for c in b.columns[1:]), strict=True)]}

    return checkpoint(map_batches(once.join(lists, "digest").select("digest", "text", "terms", "actions"), run, f"digest binary, added {FOUND}"))


def find_personal(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT, share: float = SHARE) -> DataFrame:
    """``doc, spans`` of every row: ``kind, start, stop, action`` in order; base spans have the action remove."""
    scanned = scan(docs, id_col, text_col)
    added = _added(docs, scanned, text_col, support, share)
    rows = scanned.where(F.col("what") == DOCUMENT).select("doc", "digest", F.transform("spans", lambda s: F.struct(s["kind"], s["start"], s["stop"], F.lit("remove").alias("action"))).cast(FOUND).alias("spans"))
    # Rows without base spans have no digest and nothing to join.
    held = rows.where(F.col("digest").isNotNull()).join(added, "digest", "left")
    rank = lambda s: F.struct(s["start"].alias("start"), F.array_position(F.array(*map(F.lit, (*KINDS, "term"))), s["kind"]).alias("rank"), s["stop"].alias("stop"), s["kind"].alias("kind"), s["action"].alias("action"))
    every = F.array_sort(F.transform(F.concat("spans", F.coalesce("added", F.array().cast(FOUND))), rank))
    held = held.select("doc", F.transform(every, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), s["action"].alias("action"))).alias("spans"))
    return held.unionByName(rows.where(F.col("digest").isNull()).select("doc", "spans"))


def cleaned(text: str | None, added: list[dict] | None) -> str | None:
    """The text with base spans as their kind, and terms as their class or as nothing."""
    if text is None:
        return None
    pieces, at = [], 0
    spans = [(a, z, f"[{KINDS[k].upper()}]") for a, k, z, _ in base_spans(text)]
    for s in added or ():
        spans.append((s["start"], s["stop"], term_class(_lower(text[s["start"] : s["stop"]])) if s["action"] == "generalise" else "[TERM]"))
    for a, z, label in sorted(spans, key=lambda s: (s[0], -s[1])):
        if z <= at:
            continue
        if a >= at:  # of spans that overlap the first gives the label
            pieces += [text[at:a], label]
        at = z
    return "".join([*pieces, text[at:]])


def sanitise(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT, share: float = SHARE) -> DataFrame:
    """``docs`` with ``clean_text``. Only texts that hold a disclosing term are shuffled."""
    docs = docs.drop("clean_text")
    added = _added(docs, scan(docs, id_col, text_col), text_col, support, share)
    marked = _marked(docs.withColumn("_digest", F.unhex(F.md5(text_col))), added)
    none = F.lit(None).cast(FOUND).alias("_added")
    hit = marked.where("_hit").join(added.select(F.col("digest").alias("_digest"), F.col("added").alias("_added")), "_digest", "left").select(*docs.columns, "_added")
    every = hit.unionByName(marked.where(~F.col("_hit")).select(*docs.columns, none))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            texts, more = b.column(at).to_pylist(), b.column(b.num_columns - 1).to_pylist()
            yield dict(zip(given, b.columns, strict=False)) | {"clean_text": [cleaned(t, a) for t, a in zip(texts, more, strict=True)]}

    given, at = docs.columns, docs.columns.index(text_col)
    return map_batches(every, run, StructType([*docs.schema.fields, StructField("clean_text", StringType())]))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
