"""Time the headline queries: one JSON line on standard output."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cohortspark.bindings.load import QUERIES  # noqa: E402
from cohortspark.session import local_session  # noqa: E402

HEADLINE = (
    "slide_report", "e01_gap_split", "c01_enrich", "c04_nearest_match", "c09_paired_acquisitions", "c11_patch_overlay",
    "e02_preferred_row", "e03_replicate_index", "e04_spearman", "d06_tile_summary", "d07_support_mismatch", "d12_manifest_rules",
    "d14_fingerprint", "d15_masked_percentiles", "d19_percent_area", "b16_scan_identifiers", "b18_redact", "h01_seeded_codes",
    "h03_private_blinded_split", "h05_audit_ids", "h10_column_statistics", "i03_clipped_otsu", "i06_components", "i08_tissue_mask",
    "i11_marker_index", "i10_multiscale_features", "j05_dice", "j06_rigid_fit", "k02_class_separation", "k04_agreement_summary",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": folder.rstrip("/").rsplit("sf", 1)[-1], "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
