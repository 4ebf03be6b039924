"""Incremental arrivals: fold new rows into an inventory, once each, across restarts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.skew import set_digest
from .inventory import LOAD, MOST_FOLDERS, Inventory


def fold_arrivals(stream: DataFrame, key: str, inventory: str, checkpoint: str, *, load: int = LOAD, most_folders: int = MOST_FOLDERS) -> StreamingQuery:
    """Add rows whose key is new to the ``inventory`` folder (see ``Inventory``), however late they come.

    A batch is made distinct by key, a NULL key included, and held against those buckets alone that its keys fall
    into. Replayed batches change nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        Inventory(batch.sparkSession, inventory, key, load=load, most_folders=most_folders).fold(batch, checkpoint, batch_id)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def inventory_counts(inventory: DataFrame, by: Sequence[str], ts: str) -> DataFrame:
    return inventory.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"))


def inventory_fingerprint(inventory: DataFrame, key: str) -> DataFrame:
    """Digest of the keys present: equal sets of arrivals give equal digests."""
    return set_digest(inventory.select(F.lit("inventory").alias("source"), F.col(key).cast("string").alias("_k")), ["source"], F.col("_k"))


def windowed_counts(stream: DataFrame, ts: str, by: Sequence[str], window: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Arrivals per time window, of a batch or a stream. A stream gives up rows later than ``late``;
    counts of the inventory lose none."""
    d = stream.withColumn("_event_time", F.col(ts).cast("timestamp"))
    d = d.withWatermark("_event_time", late) if d.isStreaming else d
    return d.groupBy(F.window("_event_time", window), *by).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("window_start"), *by, "n")
