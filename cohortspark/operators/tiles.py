"""Tile-grid accounting: extents, sparsity, per-channel support, fit to the true image."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tiles import PIXEL_TYPES
from .rules import rules_to_rows
from .summarise import attach

# Fixed values.
SPARSITY_WARN = (0.005, 0.30)
MAX_SPARSITY = 0.30
MAX_OVERESTIMATE = 0.15


def positions(tiles: DataFrame, container: str) -> DataFrame:
    """The distinct channels of every tile position and level, one row each."""
    return tiles.select(container, "level", "col", "row", "channel").distinct()


def tile_summary(tiles: DataFrame, container: str) -> DataFrame:
    """Levels, contiguity and, at the base level, grid extent, occupancy and sparsity."""
    per_level = positions(tiles, container).groupBy(container, "level").agg(
        F.min("col").alias("min_col"), F.min("row").alias("min_row"), (F.max("col") + 1).alias("grid_cols"),
        (F.max("row") + 1).alias("grid_rows"), F.count_distinct("col", "row").alias("tiles_present"), F.count_distinct("channel").alias("n_channels"))
    base = F.min(F.struct("level", "min_col", "min_row", "grid_cols", "grid_rows", "tiles_present", "n_channels"))
    g = per_level.groupBy(container).agg(base.alias("b"), F.max("level").alias("max_level"), F.count(F.lit(1)).alias("n_levels"))
    return g.select(
        container, F.col("b.level").alias("base_level"), "n_levels",
        ((F.col("max_level") - F.col("b.level") + 1) == F.col("n_levels")).alias("levels_contiguous"),
        "b.min_col", "b.min_row", "b.grid_cols", "b.grid_rows", "b.tiles_present",
        (F.col("b.grid_cols") * F.col("b.grid_rows")).alias("tiles_in_bbox"),
        (1 - F.try_divide(F.col("b.tiles_present"), F.col("b.grid_cols") * F.col("b.grid_rows"))).alias("sparsity_fraction"),
        "b.n_channels")


def support_mismatch(tiles: DataFrame, container: str) -> DataFrame:
    """Channels that do not cover the positions of the first channel at the base level."""
    pos = positions(tiles, container)
    base = pos.groupBy(container).agg(F.min(F.struct("level", "channel")).alias("b")).select(container, F.col("b.level").alias("base"), F.col("b.channel").alias("first"))
    d = attach(pos, base, [container]).where(F.col("level") == F.col("base"))
    spots = d.groupBy(container, "col", "row").agg(F.max(F.col("channel") == F.col("first")).alias("has_first"), F.count(F.lit(1)).alias("n"))
    both = attach(d, spots, [container, "col", "row"]).groupBy(container, "channel").agg(F.count_if("has_first").alias("inside"), F.count_if(~F.col("has_first")).alias("outside"))
    whole = spots.groupBy(container).agg(F.count_if("has_first").alias("first_spots"))
    each = attach(both, whole, [container])
    wrong = F.when((F.col("inside") < F.col("first_spots")) | (F.col("outside") > 0), F.col("channel"))
    g = each.groupBy(container).agg(F.array_join(F.array_sort(F.collect_list(wrong)).cast("array<string>"), ",").alias("mismatched"), F.count(F.lit(1)).alias("all"))
    n = attach(spots, g.select(container, "all"), [container]).groupBy(container).agg(F.count_if(~F.col("has_first") | (F.col("n") < F.col("all"))).alias("n_positions"))
    return attach(g.drop("all"), n, [container]).select(container, "mismatched", "n_positions")


def tile_bounds(tiles: DataFrame, container: str) -> DataFrame:
    """Tiles outside their file, negative positions and unknown pixel types.

    ``tiles`` carries ``offset, nbytes, file_bytes, pixel_type``."""
    over = (F.col("offset") < 0) | (F.col("nbytes") < 0) | (F.col("offset") + F.col("nbytes") > F.col("file_bytes"))
    return tiles.groupBy(container).agg(
        F.count(F.lit(1)).alias("n_tiles"), F.count_if(over).alias("n_overflowing"),
        F.count_if((F.col("col") < 0) | (F.col("row") < 0)).alias("n_negative"),
        F.count_if(~F.col("pixel_type").isin(*PIXEL_TYPES)).alias("n_unknown_type"))


def geometry_check(summary: DataFrame) -> DataFrame:
    """Compare the grid with the true image: ``tile_w, tile_h, true_w, true_h`` are known."""
    c = F.col
    grid = (c("grid_cols") * c("tile_w")).cast("double") * (c("grid_rows") * c("tile_h"))
    nominal_cols, nominal_rows = F.ceil(c("true_w") / c("tile_w")), F.ceil(c("true_h") / c("tile_h"))
    sparse = c("sparsity_fraction")
    return summary.withColumns({
        "grid_overestimate": F.try_divide(grid, c("true_w").cast("double") * c("true_h")) - 1,
        "origin_outside": ((c("grid_cols") - 1) * c("tile_w") >= c("true_w")) | ((c("grid_rows") - 1) * c("tile_h") >= c("true_h")),
        "nominal_cols": nominal_cols, "nominal_rows": nominal_rows,
        "sparsity_vs_true": 1 - F.try_divide(c("tiles_present"), nominal_cols * nominal_rows),
        "sparsity_warning": ~sparse.between(*SPARSITY_WARN),
    })


def shape_rules(checked: DataFrame, key: str, dtype: str = "uint16", channels: int = 3, samples: int = 1) -> DataFrame:
    """Problems of containers that are not shaped like tissue."""
    c = F.col
    return rules_to_rows(checked, c(key).cast("string"), [
        ("dtype", "ERROR", c("dtype") != dtype, c("dtype")),
        ("channel_count", "ERROR", c("n_channels") != channels, c("n_channels").cast("string")),
        ("samples_per_tile", "ERROR", c("samples_per_tile") != samples, c("samples_per_tile").cast("string")),
        ("sparsity", "ERROR", c("sparsity_vs_true") > MAX_SPARSITY, F.lit("positions without data")),
        ("grid_overestimate", "ERROR", F.abs(c("grid_overestimate")) > MAX_OVERESTIMATE, F.lit("grid and image size disagree")),
        ("origin_outside", "ERROR", c("origin_outside"), F.lit("grid does not fit the image")),
    ])


def pixel_type_name(code: Column) -> Column:
    pairs = F.create_map(*[F.lit(v) for kv in PIXEL_TYPES.items() for v in kv])
    return F.coalesce(F.try_element_at(pairs, code), F.concat(F.lit("unknown("), code.cast("string"), F.lit(")")))


def choose_level(levels: DataFrame, container: str, pixel_um: Column, target_um: float = 10.0) -> DataFrame:
    """Pyramid level closest to the target scale; the finer one wins a tie."""
    want = F.greatest(F.lit(0), F.bround(F.log2(F.lit(target_um) / pixel_um)))
    d = levels.withColumn("_want", want)
    return d.groupBy(container).agg(F.min(F.struct(F.abs(F.col("level") - F.col("_want")).alias("d"), F.col("level").alias("l")))["l"].alias("level"))
