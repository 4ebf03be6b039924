"""Tile containers to problems and a pass/fail summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.rules import rules_to_rows
from ..operators.summarise import attach, rollup_status
from ..operators.tiles import geometry_check, pixel_type_name, shape_rules, support_mismatch, tile_bounds, tile_summary
from ..session import checkpoint
from ..sources.tiles import decode_tile_index


def verify_containers(files: DataFrame, meta: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(problems, status)`` of ``(path, content)`` containers.

    ``meta``: ``path, directory, true_w, true_h``. A container never stops the run: what is
    wrong with it becomes rows.
    """
    tiles = checkpoint(decode_tile_index(files))
    good = tiles.where(F.col("problem").isNull()).withColumn("channel", F.col("channel").cast("bigint"))
    kind = good.groupBy("path").agg(F.min("tile_x").alias("tile_w"), F.min("tile_y").alias("tile_h"), F.min("samples_per_tile").alias("samples_per_tile"),
                                    pixel_type_name(F.min("pixel_type")).alias("dtype"))
    summary = attach(attach(tile_summary(good, "path"), kind, ["path"]), meta.select("path", "true_w", "true_h"), ["path"])
    shape = shape_rules(geometry_check(summary), "path")
    unread = rules_to_rows(tiles.where(F.col("problem").isNotNull()), F.col("path"), [("unreadable", "ERROR", F.lit(True), F.col("problem"))])
    bounds = rules_to_rows(tile_bounds(good, "path"), F.col("path"), [
        ("past_end", "ERROR", F.col("n_overflowing") > 0, F.col("n_overflowing")), ("negative_position", "ERROR", F.col("n_negative") > 0, F.col("n_negative")),
        ("unknown_type", "ERROR", F.col("n_unknown_type") > 0, F.col("n_unknown_type"))])
    support = rules_to_rows(support_mismatch(good, "path"), F.col("path"), [("channel_support", "ERROR", F.col("mismatched") != "", F.col("mismatched"))])
    empty = rules_to_rows(files.select("path").join(tiles.select("path").distinct(), "path", "left_anti"), F.col("path"), [("no_tiles", "ERROR", F.lit(True), F.lit("no tiles in the chunk table"))])
    problems = checkpoint(unread.unionByName(shape).unionByName(bounds).unionByName(support).unionByName(empty))
    return problems, rollup_status(problems.withColumnRenamed("key", "path"), meta.select("path", "directory"), "path", "directory")
