"""Small helpers for stages that work on Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[dict[str, list]]], schema: str | StructType) -> DataFrame:
    """``mapInArrow`` for a function that yields columns as ``{name: values}``."""
    kind = schema if isinstance(schema, StructType) else _parse_datatype_string(schema)
    shape = to_arrow_schema(kind)

    def run(batches):
        for columns in fn(batches):
            yield pa.RecordBatch.from_arrays([v if isinstance(v := columns[f.name], pa.Array) else pa.array(v, f.type) for f in shape], schema=shape)

    return df.mapInArrow(run, kind)


def pieces(batch: pa.RecordBatch, column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``most_bytes`` of a text column each, one row at least."""
    start, size = 0, 0
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    for i, n in enumerate(lengths):
        if size and size + n > most_bytes:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < len(lengths):
        yield batch.slice(start)
