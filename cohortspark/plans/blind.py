"""Codes, split, audit and gated write in one call."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators.audit import N_PERM, audit_blinded
from ..operators.blinding import assign_codes, extend_codes, split_private_blinded, unresolved_rows
from ..session import checkpoint
from ..sources.sinks import write_blinded


def blind(manifest: DataFrame, groups: DataFrame, seed, private_dir: str, blinded_dir: str, *, entity: str = "tube_id", group: str = "group",
          existing: DataFrame | None = None, width: int | None = None, exposure: Sequence[str] = (), preferred_only: bool = True, n_perm: int = N_PERM) -> DataFrame:
    """Blind a resolved manifest; returns the findings. ``groups``: ``entity, group``.

    Refuses rows without a condition, and writes nothing if any finding is a leak.
    """
    stopped = unresolved_rows(manifest).select(entity).limit(5).collect()
    if stopped:
        raise ValueError(f"unresolved rows, e.g. of {[r[0] for r in stopped]}: exclude and report them first")
    ids = manifest.select(entity)
    if existing is None:
        key = assign_codes(ids, entity, seed, width=width)
    else:
        if width is None:
            raise ValueError("extending a key needs the width its codes were issued with")
        key = extend_codes(existing, ids, entity, seed, width=width)
    key = checkpoint(key)
    private, blinded, _ = split_private_blinded(manifest, key, entity, exposure=exposure, preferred_only=preferred_only)
    blinded = checkpoint(blinded)
    findings = checkpoint(audit_blinded(blinded, key.join(groups, entity, "left"), entity, group, n_perm=n_perm))
    write_blinded(private, blinded, key, findings, private_dir, blinded_dir)
    return findings
