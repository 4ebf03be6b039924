"""The growing inventory: splits, replays, NULL keys, and what a batch reads."""

from pyspark.sql import functions as F

from cohortspark.streaming import arrivals as A
from cohortspark.streaming.inventory import Inventory, Layout

SCHEMA = "id bigint, v string"


def rows(spark, ids, v="a"):
    return spark.createDataFrame([(i, v) for i in ids], SCHEMA)


def held(inv):
    return sorted(((r.id, r.v) for r in inv.read(SCHEMA).collect()), key=str)


def last(inv):
    return inv.totals(inv.states()[-1])


def test_splits_move_only_their_bucket(spark):
    d = spark.range(5000)
    for n in (1, 3, 8, 21):
        old, new = Layout.of(n), Layout.of(n + 1)
        assert (old.buckets, new.buckets) == (n, n + 1)
        both = d.select(old.address(F.col("id")).alias("a"), new.address(F.col("id")).alias("b"))
        assert both.agg(F.max("a")).first()[0] == n - 1 and both.agg(F.max("b")).first()[0] == n
        moved = both.where("a <> b").select("a", "b").distinct().collect()
        assert [(r.a, r.b) for r in moved] == [(old.split, n)]
        assert both.where(new.modulus(F.col("a")) != old.modulus(F.col("a"))).select("a").distinct().count() == 1


def test_a_batch_reads_its_buckets_alone(spark, tmp_path):
    inv = Inventory(spark, str(tmp_path / "inv"), "id", load=20, most_folders=3)
    for part in (range(400), range(300, 700), range(650, 1000)):
        inv.fold(rows(spark, part))
    assert held(inv) == sorted(((i, "a") for i in range(1000)), key=str)
    t = last(inv)
    assert t.n_rows == 1000 and t.n_buckets == 50
    inv.fold(rows(spark, [3, 5001]))
    folders = inv.parts(inv.states()[-1]).count()
    assert last(inv).folders_read <= 2 * 3 + 2 * 3 < folders  # at most three folders of two buckets, and a split
    assert len(held(inv)) == 1001
    assert inv.fingerprint().first() == A.inventory_fingerprint(inv.read(SCHEMA), "id").first()


def test_many_small_batches_are_compacted(spark, tmp_path):
    inv = Inventory(spark, str(tmp_path / "inv"), "id", load=1000, most_folders=3)
    for k in range(7):
        inv.fold(rows(spark, range(10 * k, 10 * k + 15)))
    assert last(inv).n_rows == 75 and inv.parts(inv.states()[-1]).count() <= 3
    assert len(list((tmp_path / "inv").glob("_batch=*/_bucket=*"))) <= 5  # folders that were moved are gone
    assert [i for i, _ in held(inv)] == sorted(range(75), key=lambda i: str((i, "a")))


def test_replays_nulls_and_unlike_copies(spark, tmp_path):
    inv = Inventory(spark, str(tmp_path / "inv"), "id", load=4)
    inv.fold(rows(spark, [1, None, 2]), "s", 0)
    inv.fold(rows(spark, [2, None, 3, 4, 5], "b"), "s", 1)
    want = held(inv)
    assert want == sorted([(1, "a"), (2, "a"), (None, "a"), (3, "b"), (4, "b"), (5, "b")], key=str)
    inv.fold(rows(spark, [2, None, 3, 4, 5], "b"), "s", 1)
    assert held(inv) == want and last(inv).n_rows == 6
    assert inv.fingerprint().first() == A.inventory_fingerprint(inv.read(SCHEMA), "id").first()
    inv.fold(rows(spark, [7]), "other stream", 0)  # a new checkpoint starts at batch 0 again
    assert len(held(inv)) == 7
    copies = rows(spark, [9], "x").unionByName(rows(spark, [9], "y"))
    two = [Inventory(spark, str(tmp_path / f"inv{k}"), "id") for k in (0, 1)]
    two[0].fold(copies)
    two[1].fold(copies.orderBy(F.desc("v")))
    assert held(two[0]) == held(two[1]) and len(held(two[0])) == 1


def test_empty_batches(spark, tmp_path):
    inv = Inventory(spark, str(tmp_path / "inv"), "id")
    assert held(inv) == [] and inv.fingerprint().count() == 0
    inv.fold(rows(spark, []))
    assert held(inv) == []
    inv.fold(rows(spark, [1]))
    inv.fold(rows(spark, []))
    assert held(inv) == [(1, "a")]


def test_folders_follow_the_rows_and_not_the_buckets(spark, tmp_path):
    inv = Inventory(spark, str(tmp_path / "inv"), "id", load=5, most_folders=3)
    inv.fold(rows(spark, range(300)))
    inv.fold(rows(spark, range(200, 500)))
    assert last(inv).n_buckets == 100 and len(list((tmp_path / "inv").glob("_batch=*/_*=*"))) <= 2
    reader = Inventory(spark, str(tmp_path / "inv"), "id")  # opened with another load
    assert [i for i, _ in held(reader)] == sorted(range(500), key=lambda i: str((i, "a")))
