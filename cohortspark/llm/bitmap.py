"""A map of bits that says which rows surely have none of a set of keys.

It has a fixed size, a megabyte, so it may be broadcast whatever the size of the set: a large set only makes it
let through more. What it lets through is for an exact join to decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a slot number; the map is a table of 2 ** (MAP_BITS - 6) rows of 64 bits at most.
MAP_BITS = 23


def _slot(key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - MAP_BITS)


def marked(rows: DataFrame, key: Column, keys: DataFrame, name: str = "_maybe") -> DataFrame:
    """``rows`` with a flag: false where the key is surely none of the first column of ``keys``."""
    bit = lambda c: F.col(c).bitwiseAND(F.lit(63)).cast("int")
    slots = keys.select(_slot(F.col(keys.columns[0])).alias("_slot"))
    bits = slots.groupBy(F.shiftright("_slot", 6).alias("_row")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit("_slot"))).alias("_bits"))
    placed = rows.withColumn("_slot", _slot(key)).withColumn("_row", F.shiftright("_slot", 6)).join(F.broadcast(bits), "_row", "left")
    flag = F.coalesce(F.call_function("shiftrightunsigned", F.col("_bits"), bit("_slot")).bitwiseAND(F.lit(1)) == 1, F.lit(False))
    return placed.select(*rows.columns, flag.alias(name))


def maybe_in(rows: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """The ``rows`` whose key may be one of the first column of ``keys``."""
    return marked(rows, key, keys).where("_maybe").drop("_maybe")
