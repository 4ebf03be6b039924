"""Imports every binding module, which registers its queries."""

from importlib import import_module

from .registry import QUERIES, SQL

for _m in ("records", "scalars", "joins", "checks", "ordering", "blinding", "planes", "regions", "cohort", "arrivals"):
    import_module(f"cohortspark.bindings.{_m}")

__all__ = ["QUERIES", "SQL"]
