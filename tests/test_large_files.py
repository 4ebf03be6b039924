"""Digests of files that do not fit a row."""

from __future__ import annotations

import hashlib

from cohortspark.sources import records as R


def test_files_beyond_a_row(spark, tmp_path):
    (tmp_path / "large one%20.bin").write_bytes(bytes(range(256)) * 400)
    (tmp_path / "small.bin").write_bytes(b"x" * 50)
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", 1000)
    try:
        got = {(r.n_bytes, r.sha256) for r in R.file_inventory(spark, str(tmp_path), "*.bin", whole_file=1000).collect()}
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert got == {(len(b), hashlib.sha256(b).hexdigest()) for b in (bytes(range(256)) * 400, b"x" * 50)}
