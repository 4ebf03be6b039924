"""A corpus from raw documents to a mixture, in five stages.

Each stage takes ``(spark, docs, sf_dir)``, works on all that its predecessor kept and returns a table that
is written as Parquet before the next one reads it. All but the last return the columns of ``docs``; extra
columns pass whatever their names, and ``n_chars`` follows an edited text.

1. language identification: texts without a language go, as do those whose family and language are both next to a guess;
2. line dedup: chunks of lines that stand before are cut out, documents left blank by it go;
3. SimHash near-duplicates, links checked by the Jaccard similarity of five-word shingles: the document with the smallest id of each group stays;
4. benchmark decontamination: spans of test items are cut out, documents with most of their words hit go;
5. mixing to target weights: every document gets a rate; those go whose likeliest domain has the weight 0, all others stay,
   whatever fraction their rate is.

Null and empty texts leave in the first stage. Rows without an id leave the third stage once a text, rows that
repeat an id once. Empty tables pass as empty tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark.llm.decontaminate import decontaminate
from cohortspark.llm.language_id import identify, train
from cohortspark.llm.line_chunks import remove_chunks
from cohortspark.llm.mixing import label_domains, mix
from cohortspark.llm.simhash import similar_documents
from cohortspark.session import new_folder

#: Two coin flips have a score of a quarter.
LEAST_SCORE = 0.3
#: Links have 0.8 of their distinct shingles in common. Of 256 bits about 39 differ then, and hardly ever over 55.
WIDTH, RADIUS, SHINGLE, ALIKE = 4, 55, 5, 0.8
#: Of the words; a document that is mostly test items is no training text.
MOST_HIT = 0.5
#: Weights of the domains' tokens: as they stand in the corpus, but without what is toxic.
TARGETS = {"good": None, "poor": None, "toxic": 0.0}


def _aside(docs: DataFrame) -> DataFrame:
    """Id and text, and the other columns where no name can clash."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.struct(*(c for c in docs.columns if c not in ("doc_id", "text"))).alias("_rest"))


def _restored(docs: DataFrame, text: Column | None = None, *more: Column) -> list[Column]:
    """The columns of ``docs`` again, with a new text where one is given."""
    out = []
    for c, kind in docs.dtypes:
        if c == "doc_id":
            out.append(F.col(c))
        elif c == "text":
            out.append((F.col(c) if text is None else text).alias(c))
        elif c == "n_chars" and text is not None:
            out.append(F.when(text.eqNullSafe(F.col("text")), F.col(f"_rest.{c}")).otherwise(F.length(text)).cast(kind).alias(c))
        else:
            out.append(F.col("_rest")[c].alias(c))
    return [*out, *more]


def _blank(text: Column) -> Column:
    return ~text.rlike(r"\S")


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = identify(_aside(docs), train(docs))
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(*_restored(docs))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = remove_chunks(_aside(docs))
    return found.where((F.col("n_removed") == 0) | ~_blank(F.col("clean_text"))).select(*_restored(docs, F.col("clean_text")))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = similar_documents(docs.select("doc_id", "text"), words=SHINGLE, width=WIDTH, radius=RADIUS, least=ALIKE)
    # An id whose rows differ stays with the row that its component is named after, one of the component.
    own = found.where(F.col("doc") == F.col("component")).groupBy("doc").agg(F.min("text_hash").alias("text_hash"))
    ids = found.join(own, ["doc", "text_hash"]).groupBy("doc", "text_hash").agg(F.count(F.lit(1)).alias("_times"))
    d = _aside(docs)
    named = ids.select(F.col("doc").alias("doc_id"), F.col("text_hash").alias("_hash"), "_times")
    kept = d.withColumn("_hash", F.xxhash64(F.coalesce("text", F.lit("")))).join(named, ["doc_id", "_hash"]).drop("_hash")
    once, many = kept.where("_times = 1"), kept.where("_times > 1").dropDuplicates(["doc_id"])
    nameless = d.where("doc_id IS NULL").dropDuplicates(["text"])
    return once.unionByName(many).drop("_times").unionByName(nameless).select(*_restored(docs))


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate(_aside(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), max_coverage=MOST_HIT)
    kept = found.where(~F.col("drop") & ((F.size("hit") == 0) | ~_blank(F.col("clean_text"))))
    return kept.select(*_restored(docs, F.col("clean_text")))


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = mix(_aside(docs), label_domains(spark.read.parquet(f"{sf_dir}/labels.parquet")), TARGETS)
    found = found.where(~F.col("domain").isin([d for d, w in TARGETS.items() if w == 0])).withColumn("copies", F.greatest("copies", F.lit(1)))
    more = [F.col(c).alias(c if c not in docs.columns else f"mixed_{c}") for c in ("domain", "rate", "copies")]
    return found.select(*_restored(docs, None, *more))


STAGES = [
    ("language ID", keep_known_languages),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", keep_one_of_near_duplicates),
    ("benchmark decontamination", cut_benchmark),
    ("mixing to target weights", mix_domains),
]

#: Trained models and XXH64 are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = new_folder(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
