"""Rows gathered in blocks, for operators that pass over texts several times.

A block is a stretch of rows with a few megabytes of text. Blocks are written once, as a table in the
shared folder that is bucketed by block; what a later pass must know of each block is joined
to it without moving a text again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from ..session import new_folder
from .arrow import map_batches, pieces

#: Bytes of text in a block, one row at least.
BLOCK_BYTES = 4_000_000


def gather_blocks(df: DataFrame, text_col: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``block, rows, size``: the rows as structs, and their bytes of text."""
    at, names = df.columns.index(text_col), df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        n = TaskContext.get().partitionId() << 32
        for batch in batches:
            for b in pieces(batch, text_col, block_bytes):
                rows = pa.StructArray.from_arrays(b.columns, names) if names else pa.array([{}] * b.num_rows)
                size = pc.sum(pc.fill_null(pc.binary_length(b.column(at)), 0)).as_py()
                yield {"block": [n], "rows": pa.ListArray.from_arrays(pa.array([0, b.num_rows], pa.int32()), rows), "size": [size]}
                n += 1

    spark = df.sparkSession
    shape = StructType([StructField("block", LongType()), StructField("rows", ArrayType(df.schema)), StructField("size", LongType())])
    blocks = map_batches(df, run, shape)
    name = f"blocks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks.write.bucketBy(buckets, "block").option("path", new_folder(spark, "blocks")).option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


def with_lists(blocks: DataFrame, **found: DataFrame) -> DataFrame:
    """``rows, block`` and, for each table of ``found``, the list of its rows of that block."""
    for name, t in found.items():
        fields = [c for c in t.columns if c != "block"]
        blocks = blocks.join(t.groupBy("block").agg(F.collect_list(F.struct(*fields)).alias(name)), "block", "left")
    return blocks.select("rows", "block", *found)


def block_rows(batch: pa.RecordBatch) -> Iterator[tuple[pa.StructArray, list]]:
    """Each block's rows, and the other columns' values."""
    for i in range(batch.num_rows):
        yield batch.column(0)[i].values, [c[i].as_py() for c in batch.columns[1:]]
