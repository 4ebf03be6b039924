"""An inventory that grows by batches: a bucketed table whose buckets split as it fills.

Rows lie in buckets by a hash of their key, addressed by linear hashing: with level L and split pointer
s there are 2 ** L + s buckets, and those before s (and their images) use one more bit of the
hash. So the table grows bucket by bucket, a split moves the rows of one bucket only, and a batch adds rows to no
bucket that none of its keys falls into.

Each batch writes its new rows, and the rows of buckets that split or have gathered too many parts, sorted by bucket into
``_batch=<n>/_shelf=<s>``. A shelf holds as many neighbouring buckets as have ``SHELF`` rows, so folders follow the rows and not the
buckets, whose names never pass through the driver. Then it writes a state below ``_state``: the parts that make up each bucket (its rows of
one batch), and totals. What is left of a shelf is written anew once three quarters of its rows are in no part any more. The digest limbs of
the keys add up, so the fingerprint follows from the state before and the new keys, without reading the inventory.
A state counts once its totals are there; a batch that is run again starts from the state before it and replaces its own
folders. Folders no state refers to any more are removed one batch later; until then only ``Inventory.read`` tells
them apart.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import digest_limbs, digest_of_limbs
from ..session import checkpoint, children, exists, remove

#: Rows of a bucket on average, above which the table gets another bucket, and parts of a bucket before they are made one.
LOAD, MOST_FOLDERS = 1_000_000, 8
#: Rows of a shelf on average, unless one bucket has more; buckets that a reading names to Parquet.
SHELF, NAMED = 250_000, 200
LIMBS = ("l0", "l1", "l2", "l3")
PARTS = "bucket bigint, batch bigint, n bigint, shelf bigint, written bigint"
TOTALS = "seq bigint, source string, batch_id bigint, level int, split bigint, n_rows bigint, n_buckets bigint, folders_read bigint, l0 decimal(38,0), l1 decimal(38,0), l2 decimal(38,0), l3 decimal(38,0)"


@dataclass(frozen=True)
class Layout:
    """``2 ** level + split`` buckets."""

    level: int = 0
    split: int = 0

    @property
    def buckets(self) -> int:
        return (1 << self.level) + self.split

    @classmethod
    def of(cls, buckets: int) -> Layout:
        level = buckets.bit_length() - 1
        return cls(level, buckets - (1 << level))

    def address(self, key: Column) -> Column:
        h = F.xxhash64(key)
        low = F.pmod(h, F.lit(1 << self.level))
        return F.when(low < self.split, F.pmod(h, F.lit(2 << self.level))).otherwise(low)

    def modulus(self, bucket: Column) -> Column:
        """What a bucket's rows agree in: a bucket whose modulus stays keeps its rows."""
        return F.when((bucket < self.split) | (bucket >= 1 << self.level), 2 << self.level).otherwise(1 << self.level)


class Inventory:
    """Rows with distinct keys below ``folder``; one writer at a time."""

    def __init__(self, spark: SparkSession, folder: str, key: str, *, load: int = LOAD, most_folders: int = MOST_FOLDERS):
        self.spark, self.folder, self.key, self.load, self.most_folders = spark, folder.rstrip("/"), key, load, most_folders

    def _state(self, seq: int) -> str:
        return f"{self.folder}/_state/{seq}"

    def _data(self, batch: int, shelf: int) -> str:
        return f"{self.folder}/_batch={batch}/_shelf={shelf}"

    def _shelf(self, bucket: str) -> Column:
        return F.floor(F.col(bucket) / max(1, SHELF // self.load)).cast("bigint")

    def states(self) -> list[int]:
        """Numbers of the states that count; old ones are removed, so there are few."""
        return sorted(int(n) for n in children(self.spark, f"{self.folder}/_state") if n.isdigit() and exists(self.spark, f"{self._state(int(n))}/totals/_SUCCESS"))

    def totals(self, seq: int):
        return self.spark.read.schema(TOTALS).parquet(f"{self._state(seq)}/totals").first()

    def parts(self, seq: int) -> DataFrame:
        return self.spark.read.schema(PARTS).parquet(f"{self._state(seq)}/parts")

    def _rows(self, parts: DataFrame, schema) -> tuple[DataFrame, int]:
        """The rows of ``parts`` and how many parts there are; only shelves come to the driver."""
        shelves = parts.groupBy("batch", "shelf").agg(F.count(F.lit(1)).alias("n"), (F.sum("n") == F.max("written")).alias("whole")).collect()
        empty, found = self.spark.createDataFrame([], schema), sum(r.n for r in shelves)
        if not shelves:
            return empty, 0
        read = self.spark.read.schema(f"{self._ddl(empty)}, _bucket bigint, _seq bigint").parquet(*(self._data(r.batch, r.shelf) for r in shelves))
        if found <= NAMED:
            read = read.where(F.col("_bucket").isin(*{r.bucket for r in parts.select("bucket").collect()}))
        if not all(r.whole for r in shelves):
            live = parts.select(F.col("bucket").alias("_bucket"), F.col("batch").alias("_seq"))
            read = read.join(live, ["_bucket", "_seq"], "left_semi")
        return read.select(*empty.columns), found

    @staticmethod
    def _ddl(rows: DataFrame) -> str:
        return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)

    def fold(self, rows: DataFrame, source: str = "", batch_id: int | None = None) -> None:
        """Add the rows whose key is new; of unlike rows of one key that with the least digest of its content stays.

        ``source`` and ``batch_id`` name the batch: the last one may come again and changes nothing.
        """
        key, spark = F.col(self.key), self.spark
        states = self.states()
        if states and batch_id is not None and (t := self.totals(states[-1])).source == source and t.batch_id == batch_id:
            states = states[:-1]  # again what the last state holds
        before = states[-1] if states else None
        seq = 0 if before is None else before + 1
        known = self.totals(before) if before is not None else None
        old = Layout(known.level, known.split) if known else Layout()
        parts = self.parts(before) if known else spark.createDataFrame([], PARTS)

        content = F.sha2(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}), 256)
        one = checkpoint(rows.groupBy(key.alias("_key")).agg(F.min_by(F.struct(*rows.columns), content).alias("_row")).select("_row.*"))
        touched = one.select(old.address(key).alias("bucket")).distinct()
        met, folders_read = self._rows(parts.join(touched, "bucket", "left_semi"), rows.schema)
        fresh = one
        if folders_read:
            seen = met.select(key.alias("_seen"))
            fresh = checkpoint(one.join(seen, key.eqNullSafe(F.col("_seen")), "left_anti"))
        added = fresh.agg(F.count(F.lit(1)).alias("n"), *digest_limbs(F.sha2(key.cast("string"), 256), LIMBS)).first()
        n_rows = added.n + (known.n_rows if known else 0)
        new = Layout.of(max(old.buckets, -(-n_rows // self.load)))

        # Buckets that split, those the batch adds to that have many parts, and what is left of a shelf that is mostly given up are written anew.
        b = F.col("bucket")
        moves = parts.where(new.modulus(b) != old.modulus(b)) if new != old else parts.limit(0)
        full = parts.groupBy("bucket").agg(F.count(F.lit(1)).alias("f")).where(F.col("f") >= self.most_folders).join(touched, "bucket", "left_semi")
        moves = checkpoint(moves.unionByName(parts.join(full, "bucket", "left_semi")).distinct())
        left = parts.join(moves, ["bucket", "batch"], "left_anti")
        thin = left.groupBy("batch", "shelf").agg(F.sum("n").alias("n"), F.max("written").alias("written")).where("4 * n < written")
        moves = checkpoint(moves.unionByName(left.join(thin, ["batch", "shelf"], "left_semi").select(*moves.columns)))
        moved, more = self._rows(moves, rows.schema)
        data = f"{self.folder}/_batch={seq}"
        placed = fresh.unionByName(moved).withColumns({"_bucket": new.address(key), "_seq": F.lit(seq).cast("bigint")}).withColumn("_shelf", self._shelf("_bucket"))
        placed.repartition("_shelf").sortWithinPartitions("_shelf", "_bucket").write.mode("overwrite").partitionBy("_shelf").parquet(data)
        counts = spark.read.schema("_bucket bigint, _seq bigint").parquet(data).groupBy(F.col("_bucket").alias("bucket"), F.col("_seq").alias("batch")).agg(F.count(F.lit(1)).alias("n"))
        counts = checkpoint(counts.withColumn("shelf", self._shelf("bucket")))
        counts = counts.join(counts.groupBy("shelf").agg(F.sum("n").alias("written")), "shelf").select(*moves.columns)
        stay = parts.join(moves, ["bucket", "batch"], "left_anti").select(*moves.columns)
        stay.unionByName(counts).coalesce(1).write.mode("overwrite").parquet(f"{self._state(seq)}/parts")
        sums = [(getattr(added, c) or Decimal(0)) + (getattr(known, c) if known else Decimal(0)) for c in LIMBS]
        row = (seq, source, batch_id, new.level, new.split, n_rows, new.buckets, folders_read + more, *sums)
        spark.createDataFrame([row], TOTALS).coalesce(1).write.mode("overwrite").parquet(f"{self._state(seq)}/totals")
        self._tidy(states)

    def _tidy(self, states: list[int]) -> None:
        """Remove states before the last but one, and the folders only they refer to."""
        if len(states) < 2:
            return
        last = states[-1]
        shelves = lambda seq: self.parts(seq).select("batch", "shelf").distinct()
        for old in states[:-1]:
            gone = shelves(old).join(shelves(last), ["batch", "shelf"], "left_anti").join(shelves(last + 1), ["batch", "shelf"], "left_anti")
            for r in gone.collect():  # what one batch has moved
                remove(self.spark, self._data(r.batch, r.shelf))
            remove(self.spark, self._state(old))

    def read(self, schema) -> DataFrame:
        """All rows as of the last state."""
        states = self.states()
        return self._rows(self.parts(states[-1]), schema)[0] if states else self.spark.createDataFrame([], schema)

    def fingerprint(self) -> DataFrame:
        """``source, n_items, digest`` of the keys, from the totals alone; equals the digest of a whole reading."""
        states = self.states()
        d = self.spark.read.schema(TOTALS).parquet(f"{self._state(states[-1])}/totals") if states else self.spark.createDataFrame([], TOTALS)
        return d.select(F.lit("inventory").alias("source"), F.col("n_rows").alias("n_items"), digest_of_limbs(F.col("n_rows"), [F.col(c) for c in LIMBS]).alias("digest"))
