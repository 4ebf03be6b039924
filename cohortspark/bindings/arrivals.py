"""Streaming arrivals replay the events table in batches, with every third row twice."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming import arrivals as A
from ..streaming.inventory import Inventory
from .checks import _limbs
from .records import _folder
from .registry import SQL, query, rnd

#: Rows of a bucket, so that the inventory splits while it takes in these small tables.
LOAD = 500


def _fold(t):
    """Fold the later half of the events as arriving files (with copies), then the earlier half and the copies again."""
    source, inventory, state = (_folder(t, n) for n in ("incoming", "inventory", "state"))
    e = t.events
    seconds = F.col("ts").cast("timestamp").cast("double")
    middle = e.select(F.percentile_approx(seconds, 0.5)).first()[0]
    late = F.coalesce(seconds < middle, F.lit(False))
    copies = e.where("event_id % 3 = 0")
    for part in (e.where(~late).unionByName(copies.where(~late)), e.where(late).unionByName(copies)):
        part.repartition(4, "event_type").write.mode("append").parquet(source)
        stream = t.spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 2).parquet(source)
        A.fold_arrivals(stream, "event_id", inventory, state, load=LOAD, most_folders=3).awaitTermination()
    return Inventory(t.spark, inventory, "event_id"), e.schema


@query("m01_incremental_inventory", "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def _inventory(t):
    inventory, schema = _fold(t)
    return inventory.read(schema).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), rnd(F.sum("value"), 2).alias("total"))


@query("m01_arrival_counts", "SELECT user_id, count(*) AS n, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_seen, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_seen FROM events GROUP BY 1")
def _counts(t):
    inventory, schema = _fold(t)
    d = A.inventory_counts(inventory.read(schema), ["user_id"], "ts")
    return d.withColumns({c: F.substring(F.col(c).cast("string"), 1, 19) for c in ("first_seen", "last_seen")})


@query("m01_windowed_arrivals", "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def _windowed(t):
    d = A.windowed_counts(t.events, "ts", ["event_type"])
    return d.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@query("m01_inventory_fingerprint", f"""WITH h AS (SELECT DISTINCT sha256(CAST(event_id AS VARCHAR)) AS h FROM events)
SELECT 'inventory' AS source, count(*) AS n_items, sha256(concat_ws('|', CAST(count(*) AS VARCHAR), {_limbs('h')})) AS digest FROM h""")
def _fingerprint(t):
    inventory, schema = _fold(t)
    return A.inventory_fingerprint(inventory.read(schema), "event_id")


@query("m01_fingerprint_by_deltas", SQL["m01_inventory_fingerprint"])
def _fingerprint_by_deltas(t):
    return _fold(t)[0].fingerprint()
