"""Column expressions on numbers: tolerances, areas, units, rescaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def within_tol(values: Sequence[Column], expected: Sequence[float | Column], tol: float, relative: bool = False) -> Column:
    """All values within tolerance of the expected ones; a missing value is not."""
    out = F.lit(True)
    for v, e in zip(values, expected):
        e = e if isinstance(e, Column) else F.lit(float(e))
        bound = F.lit(float(tol)) * F.greatest(F.abs(v), F.abs(e)) if relative else F.lit(float(tol))
        out = out & F.coalesce(F.abs(v - e) <= bound, F.lit(False))
    return out


def area_um2(width: Column, height: Column, pixel_um: Column) -> Column:
    """Physical area; NULL if any input is missing or zero."""
    px = F.nullif(width.cast("double") * height.cast("double"), F.lit(0.0))
    size = F.nullif(pixel_um.cast("double"), F.lit(0.0))
    return F.round(px * size * size, 1)


def us_to_ms(c: Column) -> Column:
    return c / F.lit(1000.0)


def iso_utc(epoch_seconds: Column) -> Column:
    """Epoch seconds to ISO-8601 text in UTC, whatever the session zone."""
    days = F.floor(epoch_seconds / 86400)
    rest = epoch_seconds - days * 86400
    pad = lambda c: F.lpad(c.cast("bigint").cast("string"), 2, "0")
    date = F.date_add(F.lit("1970-01-01").cast("date"), days.cast("int")).cast("string")
    clock = F.concat_ws(":", pad(F.floor(rest / 3600)), pad(F.floor((rest % 3600) / 60)), pad(rest % 60))
    return F.concat(date, F.lit("T"), clock, F.lit("+00:00"))


def coarsen(c: Column, digits: int) -> Column:
    """Fewer digits, so that a value cannot fingerprint a row."""
    return F.round(c, digits)


def rescale(value: Column, low_anchor: Column, high_anchor: Column) -> Column:
    """``(value - low) / (high - low)``; NULL where the span is zero."""
    return F.try_divide(value - low_anchor, high_anchor - low_anchor)
