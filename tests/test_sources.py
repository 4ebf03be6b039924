"""Readers, the tile index, gated writes and the arrival stream."""

import struct

import pytest
from pyspark.sql import functions as F

from cohortspark.operators.matching import grid_fits
from cohortspark.sources import records as R
from cohortspark.sources import sinks as S
from cohortspark.sources.tiles import decode_tile_index, read_tile_index
from cohortspark.streaming import arrivals as A


def container(chunks, n_dim=4, cut=0):
    head = b"SIS\x00" + bytes(4) + struct.pack("<II", 1, n_dim) + struct.pack("<Q", 64) + bytes(8) + struct.pack("<Q", 104) + struct.pack("<I", len(chunks)) + bytes(20)
    block = b"ETS\x00" + bytes(4) + struct.pack("<8i", 4, 1, 1, 2, 90, 512, 512, 1)
    table = b"".join(bytes(4) + struct.pack(f"<{n_dim}i", *c) + struct.pack("<Qi", o, n) + bytes(4) for c, o, n in chunks)
    data = head + block + table
    return bytearray(data[:len(data) - cut] if cut else data)


def test_tile_index(spark):
    ok = [((0, 0, 0, 0), 200, 10), ((1, 0, 1, 0), 2**40, 7), ((3, 2, 2, 1), 5, 5)]
    files = spark.createDataFrame([("a", container(ok)), ("b", container(ok, cut=8)), ("c", bytearray(b"nope")), ("d", container([])), ("e", container([((1, 2), 3, 4)], 2))], "path string, content binary")
    got = decode_tile_index(files, batch_rows=2).collect()
    a = [(r.col, r.row, r.channel, r.level, r.offset, r.nbytes) for r in got if r.path == "a"]
    assert a == [(0, 0, 0, 0, 200, 10), (1, 0, 1, 0, 2**40, 7), (3, 2, 2, 1, 5, 5)]
    assert {r.path: r.problem for r in got if r.problem} == {"b": "chunk table runs past the end of the file", "c": "bad magic"}
    assert [(r.col, r.channel, r.level) for r in got if r.path == "e"] == [(1, 0, 2)] and not [r for r in got if r.path == "d"]


def test_stems_never_match_by_prefix(spark):
    idx = spark.createDataFrame([("/r/Image_5.idx",), ("/r/Image_51.idx",), ("/r/Image_7.idx",)], "path string")
    fold = spark.createDataFrame([("_Image_51_",), ("Image_51",), ("Image_7",)], "name string")
    got = {r.path: r.payload for r in R.pair_payload(idx, fold).collect()}
    assert got == {"/r/Image_5.idx": None, "/r/Image_51.idx": "_Image_51_", "/r/Image_7.idx": "Image_7"}


def test_record_reader(spark, tmp_path):
    p = tmp_path / "slides.csv"
    p.write_text("tube_id,label\n 29 , 01\n,02\n29,03\nx,04\n")
    d = R.read_record(spark, str(p), "tube_id", ["tube_id", "label"])
    assert {(r.tube_id, r.label) for r in d.collect()} == {("29", "01"), ("29", "03"), ("x", "04")}
    assert {(r.key, r.problem) for r in R.record_problems(d, "tube_id").collect()} == {("29", "duplicate key"), ("x", "key is not a whole number")}
    assert R.read_optional(spark, str(tmp_path / "none.csv"), d.schema).count() == 0


def test_digest_of_streamed_file(spark, tmp_path):
    import hashlib
    p = tmp_path / "big.bin"
    p.write_bytes(bytes(range(256)) * 50_000)
    files = R.file_inventory(spark, str(tmp_path), "*.bin", digest=False)
    got = R.streamed_digests(files, chunk_bytes=4096, tasks=2).first()
    assert got.sha256 == hashlib.sha256(p.read_bytes()).hexdigest() and got.n_bytes == 256 * 50_000
    assert R.file_inventory(spark, str(tmp_path), "*.bin").first().sha256 == got.sha256


def test_gate_refuses(spark, tmp_path):
    d = spark.createDataFrame([("A01", 1)], "code string, v int")
    leak = spark.createDataFrame([("LEAK", "id_value", "v", "1")], "severity string, check string, column string, detail string")
    a, b = str(tmp_path / "private"), str(tmp_path / "blinded")
    with pytest.raises(ValueError):
        S.write_blinded(d, d, d, leak, a, b)
    with pytest.raises(ValueError):
        S.write_blinded(d, d, d, leak.where("severity = 'RISK'"), a, a + "/inside")
    S.write_blinded(d, d, d, leak.where("severity = 'RISK'"), a, b)
    with pytest.raises(Exception):
        S.write_blinded(d, d, d, leak.where("severity = 'RISK'"), a, b)
    other = str(tmp_path / "other")
    with pytest.raises(ValueError):
        S.write_blinded(d, d, d, leak.where("severity = 'RISK'"), other, b)
    assert not (tmp_path / "other").exists()  # nothing is left behind


def test_late_rows_are_kept(spark, tmp_path):
    src, inv, state = (str(tmp_path / n) for n in ("src", "inv", "state"))
    e = spark.createDataFrame([(1, "2026-03-10 00:00:00"), (2, "2026-03-01 00:00:00")], "id int, ts string")
    for k in (1, 2):
        e.where(f"id = {k}").write.mode("append").parquet(src)
        A.fold_arrivals(spark.readStream.schema(e.schema).parquet(src), "id", inv, state).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(inv).collect()) == [1, 2]


def test_arrivals_are_folded_once(spark, tmp_path):
    src, inv, state = (str(tmp_path / n) for n in ("src", "inv", "state"))
    e = spark.range(50).select(F.col("id"), F.timestamp_seconds(F.col("id") * 60 + 1_700_000_000).alias("ts"))

    def fold():
        A.fold_arrivals(spark.readStream.schema(e.schema).parquet(src), "id", inv, state).awaitTermination()
        return spark.read.parquet(inv)

    e.where("id < 30").write.parquet(src)
    one = fold()
    first = A.inventory_fingerprint(one, "id").first()
    assert one.count() == 30
    assert fold().count() == 30
    e.where("id >= 20").write.mode("append").parquet(src)
    two = fold()
    assert two.count() == two.select("id").distinct().count() == 50
    assert A.inventory_fingerprint(two, "id").first().digest != first.digest == A.inventory_fingerprint(e.where("id < 30"), "id").first().digest


def test_grid_fits(spark):
    d = spark.createDataFrame([(10, 5000), (11, 5000), (8, 5000)], "cols int, w int")
    got = [r[0] for r in d.select(grid_fits(F.col("cols"), F.lit(1), F.lit(512), F.lit(512), F.col("w"), F.lit(600))).collect()]
    assert got == [True, False, True]


def test_verify_plan(spark):
    from cohortspark.plans.verify import verify_containers

    def grid(skip=()):
        return [((c, r, ch, 0), 200, 10) for c in range(3) for r in range(3) for ch in range(3) if (c, r, ch) not in skip]

    files = spark.createDataFrame([
        ("good", container(grid())), ("hole", container(grid({(1, 1, 2)}))), ("cut", container(grid(), cut=4)), ("far", container([*grid(), ((0, 0, 0, 0), 10**9, 9)])),
        ("none", container([]))], "path string, content binary")
    meta = files.select("path", F.lit("d").alias("directory"), F.lit(1500).alias("true_w"), F.lit(1490).alias("true_h"))
    problems, status = verify_containers(files, meta)
    assert {(r.key, r.rule) for r in problems.collect()} == {("hole", "channel_support"), ("cut", "unreadable"), ("far", "past_end"), ("none", "no_tiles")}
    r = status.first()
    assert (r.n_total, r.n_passed, r.n_failed, r.ok) == (5, 1, 4, False)


def test_blind_plan(spark, tmp_path):
    from cohortspark.plans.blind import blind
    rows = [(t, ("alpha", "beta", "gamma")[t % 3], f"0{s}", "positive" if s < 3 else "negative", True) for t in range(100, 124) for s in (1, 2, 3)]
    d = spark.createDataFrame(rows, "tube_id int, group string, section_label string, condition string, scan_is_preferred boolean")
    groups = d.select("tube_id", "group").distinct()
    found = blind(d.drop("group"), groups, "orchid-7-basalt-19", str(tmp_path / "p"), str(tmp_path / "b"), n_perm=199)
    assert found.where("severity = 'LEAK'").count() == 0
    out = spark.read.parquet(str(tmp_path / "b" / "blinded"))
    assert out.count() == len(rows) and "tube_id" not in out.columns and spark.read.parquet(str(tmp_path / "p" / "provenance")).count() == len(rows)
    with pytest.raises(ValueError):
        blind(d.withColumn("condition", F.lit("pending")), groups, "orchid-7-basalt-19", str(tmp_path / "p2"), str(tmp_path / "b2"))


def test_ranged_reads_touch_headers_alone(spark, tmp_path):
    from cohortspark.sources import tiles

    for k in range(3):
        with open(tmp_path / f"frame_{k}.ets", "wb") as f:
            f.write(container([((i, k, i % 3, 0), 10**9 + i, 7) for i in range(200 + k)]))
    with open(tmp_path / "huge.ets", "r+b" if (tmp_path / "huge.ets").exists() else "wb") as f:
        f.write(container([((i, 9, 0, 1), i, 1) for i in range(1000)]))
        f.truncate(3 << 30)  # sparse
    (tmp_path / "short.ets").write_bytes(bytes(container([((0, 0, 0, 0), 1, 1)], cut=3)))
    (tmp_path / "notes.txt").write_bytes(b"no container")
    got = read_tile_index(spark, str(tmp_path), ".ets", files=2)
    assert got.rdd.getNumPartitions() == 3
    by_file = {r[0]: (r.n, r.problem) for r in got.groupBy(F.element_at(F.split("path", "/"), -1)).agg(F.count("*").alias("n"), F.max("problem").alias("problem")).collect()}
    assert by_file == {"frame_0.ets": (200, None), "frame_1.ets": (201, None), "frame_2.ets": (202, None), "huge.ets": (1000, None), "short.ets": (1, "chunk table runs past the end of the file")}
    r = got.where("row = 9 AND col = 500").first()
    assert (r.file_bytes, r.offset, r.nbytes, r.level, r.tile_x) == (3 << 30, 500, 1, 1, 512)
    seen = []
    with open(tmp_path / "huge.ets", "rb") as f:
        def read(at, n):
            seen.append(n)
            f.seek(at)
            return f.read(n)

        assert sum(b.num_rows for b in tiles.index_rows("x", 3 << 30, read, 300)) == 1000
    assert sum(seen) < 50_000
    assert read_tile_index(spark, str(tmp_path), ".nothing").count() == 0
