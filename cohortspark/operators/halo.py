"""Neighbourhoods of pixels: planes are dealt once into square tiles with a rim, and kernels are array steps in a tile.

A tile has ``TILE`` pixels a side and a rim as wide as the kernels reach, so it is of bounded size whatever the plane's,
every pixel is shuffled once (those near an edge to the neighbours too), and all kernels and scales share that one shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType

#: Pixels along a tile's side, without its rim.
TILE = 64

Kernel = Callable[[np.ndarray, np.ndarray], Mapping[str, np.ndarray]]


def by_tiles(px: DataFrame, by: Sequence[str], value: str, rim: int, names: Sequence[str], kernel: Kernel, tile: int = TILE) -> DataFrame:
    """``px`` with the columns ``names``, which ``kernel`` computes on each tile.

    The kernel gets the values as an array, NaN where there are none, and which pixels have a row; of its
    results the rows' pixels are kept, NaN as NULL. ``by, x, y`` must be unique.
    """
    px = px.drop(*names)
    shape = StructType([*px.schema.fields, *(StructField(n, DoubleType()) for n in names)])
    arrow, given = to_arrow_schema(shape), px.columns
    cover = lambda c: F.sequence(F.floor((F.col(c) - rim) / tile), F.floor((F.col(c) + rim) / tile))
    dealt = px.withColumn("_tx", F.explode(cover("x"))).withColumn("_ty", F.explode(cover("y")))

    def run(t: pa.Table) -> pa.Table:
        x, y = t["x"].to_numpy(), t["y"].to_numpy()
        inner = (x // tile == t["_tx"][0].as_py()) & (y // tile == t["_ty"][0].as_py())
        if not inner.any():  # the rim of a tile without pixels
            return arrow.empty_table()
        x, y = x - x.min(), y - y.min()
        values, present = np.full((y.max() + 1, x.max() + 1), np.nan), np.zeros((y.max() + 1, x.max() + 1), bool)
        values[y, x] = t[value].cast(pa.float64()).to_numpy(zero_copy_only=False)
        present[y, x] = True
        out = kernel(values, present)
        own = t.select(given).filter(pa.array(inner))
        more = [pa.array(out[n][y[inner], x[inner]], from_pandas=True) for n in names]
        return pa.Table.from_arrays([*own.columns, *more], names=[*own.column_names, *names]).cast(arrow)

    return dealt.groupBy(*by, "_tx", "_ty").applyInArrow(run, shape)


def _shifted(a: np.ndarray, offset: int, axis: int) -> np.ndarray:
    """``a`` seen from ``offset`` pixels before, NaN beyond the edge."""
    out = np.full_like(a, np.nan)
    n = a.shape[axis]
    if abs(offset) < n:
        to, of = slice(max(0, -offset), n - max(0, offset)), slice(max(0, offset), n - max(0, -offset))
        out[(slice(None),) * axis + (to,)] = a[(slice(None),) * axis + (of,)]
    return out


def _sums(a: np.ndarray, weights: Mapping[int, float], axis: int) -> tuple[np.ndarray, np.ndarray]:
    """Weighted sums along an axis over what is there, and the weights that count."""
    num, den = np.zeros_like(a), np.zeros_like(a)
    for o, w in weights.items():
        s = _shifted(a, o, axis)
        known = ~np.isnan(s)
        num[known] += w * s[known]
        den[known] += w
    return num, den


def _only(a: np.ndarray, where: np.ndarray) -> np.ndarray:
    return np.where(where, a, np.nan)


def gaussian_weights(sigma: float) -> dict[int, float]:
    r = max(1, math.ceil(3 * sigma))
    return {o: math.exp(-o * o / (2.0 * sigma * sigma)) for o in range(-r, r + 1)}


def blur(a: np.ndarray, present: np.ndarray, sigma: float) -> np.ndarray:
    """Separable Gaussian; weights renormalise at missing pixels."""
    for axis in (1, 0):
        num, den = _sums(a, gaussian_weights(sigma), axis)
        a = _only(num / np.where(den > 0, den, 1), present & (den > 0))
    return a


def multiscale(sigmas: Sequence[float]) -> tuple[int, list[str], Kernel]:
    """Rim, names and kernel of Gaussian, weighted deviation, Laplacian and gradient magnitude at each scale."""
    tags = {s: f"s{s:g}".replace(".", "_") for s in sigmas}

    def kernel(v: np.ndarray, present: np.ndarray) -> dict[str, np.ndarray]:
        out = {}
        for s, t in tags.items():
            g = blur(v, present, s)
            near = [np.where(np.isnan(n := _shifted(g, o, axis)), g, n) for axis in (1, 0) for o in (-1, 1)]
            left, right, up, down = near
            out |= {f"gauss_{t}": g, f"std_{t}": np.sqrt(np.maximum(blur(v * v, present, s) - g * g, 0)), f"laplace_{t}": left + right + up + down - 4 * g,
                    f"gradient_{t}": np.sqrt(((right - left) / 2) ** 2 + ((down - up) / 2) ** 2)}
        return out

    return 1 + max(max(gaussian_weights(s)) for s in sigmas), [f"{k}_{t}" for t in tags.values() for k in ("gauss", "std", "laplace", "gradient")], kernel


def local_moments(radius: int, mode: str, floor: float) -> Kernel:
    """A pixel less the mean of the box around it, over its deviation where the mode asks for that."""
    box = dict.fromkeys(range(-radius, radius + 1), 1.0)

    def kernel(v: np.ndarray, present: np.ndarray) -> dict[str, np.ndarray]:
        sums = []
        for a in (v, v * v, np.where(np.isnan(v), np.nan, 1.0)):
            a = _only(_sums(a, box, 1)[0], present)
            sums.append(_sums(a, box, 0)[0])
        s, q, n = sums
        with np.errstate(invalid="ignore", divide="ignore"):
            mean = s / np.where(n > 0, n, np.nan)
            std = np.sqrt(np.maximum(q / np.where(n > 0, n, np.nan) - mean * mean, 0))
            by = {"mean": np.ones_like(std), "zscore": np.where(std > 0, std, np.nan), "floor": np.maximum(std, floor)}[mode]
            return {"normalised": (v - mean) / np.where(by != 0, by, np.nan)}

    return kernel


def lower_envelope(height: np.ndarray) -> np.ndarray:
    """min over j of height[j] + (i - j) ** 2 for each i: the lowest of parabolas, found from left to right in linear time.

    Infinite heights stand for no parabola.
    """
    n = len(height)
    places = np.flatnonzero(np.isfinite(height))
    if not len(places):
        return np.full(n, np.inf)
    tops, begins = [int(places[0])], [-math.inf]
    squared = (height + np.arange(n, dtype=float) ** 2).tolist()
    for q in places[1:].tolist():
        while True:
            p = tops[-1]
            cut = (squared[q] - squared[p]) / (2.0 * (q - p))
            if cut > begins[-1]:
                break
            tops.pop(), begins.pop()
        tops.append(q), begins.append(cut)
    at = np.array(tops)[np.searchsorted(np.array(begins), np.arange(n), side="right") - 1]
    return height[at] + (np.arange(n) - at) ** 2
