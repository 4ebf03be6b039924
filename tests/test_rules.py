"""The section table's rules keep the rows of a task bounded."""

from collections import Counter

from pyspark.sql import functions as F

from cohortspark.operators import rules as U
from cohortspark.session import checkpoint

SCHEMA = """row_kind string, tube_id bigint, `group` string, arm string, scan string, section_label string, physical_section_label string, box string, condition string, has_negative_control boolean,
n_sections_recorded bigint, n_sections_on_slide bigint, in_record boolean, in_index boolean, exposure_is_standard boolean, pixel_size_um double, notes string, use_for_measurement boolean, tube_id_in_file string, path string"""


def test_a_file_has_no_more_rows_than_asked(spark):
    d = checkpoint(spark.range(1000).coalesce(1), rows_a_file=100)
    assert d.count() == 1000 and d.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] <= 100


def test_the_section_table_is_written_in_small_files(spark, monkeypatch):
    monkeypatch.setattr(U, "ROWS_A_FILE", 50)
    rows = [("section", i // 4, "a", "diet", "original", f"0{i % 4 + 1}", f"0{i % 4 + 1}", "near_label", "positive", False, 4, 4, True, True, True, 0.325, "", True, str(i // 4), f"/raw/{i // 4}") for i in range(400)]
    found = U.validate_manifest(spark.createDataFrame([*rows, rows[7]], SCHEMA).coalesce(1), forbidden=[59])
    assert len(found.inputFiles()) >= 8
    assert Counter((r.rule, r.key) for r in found.collect()) == {("forbidden_entity", "59"): 1, ("double_counted", "1/04"): 1, ("duplicate_key", "1/original/04"): 1}
