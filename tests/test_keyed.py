"""Loads that keep a table's key, and commits by one rename."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from shelfwise.cli import main
from shelfwise.operators import quality
from shelfwise.session import commit_folder, list_names
from shelfwise.sources import csv_io, keyed
from shelfwise.sources.tables import create_table_if_absent
from shelfwise.streaming.ingest import start_snapshot_ingest

from .handmade import frames


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def city(spark, *pairs):
    return spark.createDataFrame(list(pairs), "store_id long, city_name string")


def test_rejected_rows_are_told_and_the_key_stays_unique(spark, scratch):
    path = os.path.join(scratch, "store_city")
    first = city(spark, (1, "A"), (2, "B"), (2, "B"), (2, None), (None, "C"), (None, "C"), (3, None))
    assert keyed.load(first, path, keyed.STORE_CITY, "a") == {"accepted": 3, "rejected": 4}
    table = keyed.read_table(spark, path, keyed.STORE_CITY)
    assert rows(table, "store_id", "city_name") == [(1, "A"), (2, None), (3, None)]      # NULL sorts first
    assert rows(keyed.read_rejects(spark, path, keyed.STORE_CITY), "store_id", "city_name", "reason", "copies") == [
        (2, "B", keyed.IN_BATCH, 2), (None, "C", keyed.NULL_KEY, 2)]
    # the same keys again, also with other values, and a new one
    second = city(spark, (1, "A"), (1, "Z"), (4, "D"), (4, "D"))
    assert keyed.load(second, path, keyed.STORE_CITY, "b", source=F.lit("b.csv")) == {"accepted": 1, "rejected": 3}
    assert rows(keyed.read_rejects(spark, path, keyed.STORE_CITY).filter("batch = 'b'"),
                "store_id", "city_name", "reason", "copies", "source_file") == [
        (1, "A", keyed.IN_TABLE, 1, "b.csv"), (1, "Z", keyed.IN_TABLE, 1, "b.csv"), (4, "D", keyed.IN_BATCH, 1, "b.csv")]
    table = keyed.read_table(spark, path, keyed.STORE_CITY)
    assert quality.duplicate_keys(table, ["store_id"]).isEmpty() and table.count() == 4


def test_a_load_is_not_repeated_and_nothing_is_left_behind(spark, scratch):
    path = os.path.join(scratch, "t")
    one = city(spark, (1, "A"))
    assert keyed.load(one, path, keyed.STORE_CITY, "x")["accepted"] == 1
    assert keyed.load(city(spark, (9, "other")), path, keyed.STORE_CITY, "x") is None
    # a run that died between its two commits: rejects are there, the load is not
    os.makedirs(f"{path}-rejects/batch=y")
    assert keyed.load(city(spark, (1, "B"), (2, "B")), path, keyed.STORE_CITY, "y") == {"accepted": 1, "rejected": 1}
    assert rows(keyed.read_table(spark, path, keyed.STORE_CITY), "store_id", "batch") == [(1, "x"), (2, "y")]
    for folder in (path, f"{path}-rejects"):
        assert {n for n in list_names(spark, folder) if not n.startswith("batch=")} == set()


def test_strict_load_commits_nothing(spark, scratch):
    path = os.path.join(scratch, "t")
    with pytest.raises(keyed.KeyViolation, match="1 of 3"):
        keyed.load(city(spark, (1, "A"), (2, "B"), (2, "C")), path, keyed.STORE_CITY, "x", strict=True)
    assert keyed.read_table(spark, path, keyed.STORE_CITY).isEmpty() and not list_names(spark, path)
    assert keyed.load(city(spark, (1, "A"), (2, "B")), path, keyed.STORE_CITY, "x", strict=True)["rejected"] == 0


def test_empty_loads(spark, scratch):
    snap, _, _ = frames(spark)
    path = os.path.join(scratch, "t")
    with_day = keyed.with_partition(snap, keyed.SNAPSHOTS)
    assert keyed.load(with_day.limit(0), path, keyed.SNAPSHOTS, "0") == {"accepted": 0, "rejected": 0}
    assert keyed.read_table(spark, path, keyed.SNAPSHOTS).isEmpty()
    assert keyed.load(with_day, path, keyed.SNAPSHOTS, "1") == {"accepted": snap.count(), "rejected": 0}
    assert keyed.load(with_day, path, keyed.SNAPSHOTS, "2") == {"accepted": 0, "rejected": snap.count()}
    got = keyed.read_table(spark, path, keyed.SNAPSHOTS)
    assert rows(got, *snap.columns) == rows(snap, *snap.columns)


@pytest.mark.parametrize("broadcast_rows", [0, 1_000_000])
def test_one_key_with_a_third_of_all_rows(spark, scratch, broadcast_rows):
    many = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("store_id"),
                                    (F.col("id") % 5).cast("string").alias("city_name"))
    path = os.path.join(scratch, "t")
    got = keyed.load(many, path, keyed.STORE_CITY, "x", broadcast_rows=broadcast_rows)
    assert got == {"accepted": 2000, "rejected": 1000}      # 7 is one of the others too
    rejects = keyed.read_rejects(spark, path, keyed.STORE_CITY)
    assert rejects.count() == 5 and rejects.agg(F.sum("copies")).first()[0] == 1000
    assert rows(keyed.read_table(spark, path, keyed.STORE_CITY).filter("store_id = 7"), "city_name") == [("0",)]


def test_only_touched_days_of_the_table_are_read(spark, scratch):
    snap, _, _ = frames(spark)
    path = os.path.join(scratch, "t")
    with_day = keyed.with_partition(snap, keyed.SNAPSHOTS)
    keyed.load(with_day, path, keyed.SNAPSHOTS, "1")
    day = with_day.agg(F.min("snapshot_date")).first()[0]
    known = keyed._known_keys(with_day.filter(F.col("snapshot_date") == day), path, keyed.SNAPSHOTS)
    plan = known._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan or "snapshot_date#" in plan.split("PartitionFilters")[1]
    assert known.count() == with_day.filter(F.col("snapshot_date") == day).count()


def test_ingest_rejects_repeated_keys_across_drops(spark, scratch):
    snap, _, _ = frames(spark)
    src, out = os.path.join(scratch, "drops"), os.path.join(scratch, "table")
    csv_io.write_csv(snap, f"{src}/1")
    start_snapshot_ingest(spark, f"{src}/*", out).awaitTermination()
    csv_io.write_csv(snap.limit(3).withColumn("inventory", F.lit(99)), f"{src}/2")
    start_snapshot_ingest(spark, f"{src}/*", out).awaitTermination()
    table = keyed.read_table(spark, out, keyed.SNAPSHOTS)
    assert rows(table, *snap.columns) == rows(snap, *snap.columns)
    rejects = keyed.read_rejects(spark, out, keyed.SNAPSHOTS).collect()
    assert [r.reason for r in rejects] == [keyed.IN_TABLE] * 3 and {r.inventory for r in rejects} == {99}
    assert all("/2/" in r.source_file for r in rejects)
    csv_io.write_csv(snap.limit(1), f"{src}/3")
    with pytest.raises(Exception, match="rule"):
        start_snapshot_ingest(spark, f"{src}/*", out, strict=True).awaitTermination()
    assert keyed.read_table(spark, out, keyed.SNAPSHOTS).count() == snap.count()


def test_load_command(spark, scratch, capsys):
    snap, stores, cats = frames(spark)
    for name, df in (("s", snap), ("c", cats.unionByName(cats.limit(1))), ("m", stores)):
        csv_io.write_csv(df, f"{scratch}/{name}")
    args = ["load", "--snapshots", f"{scratch}/s", "--categories", f"{scratch}/c", "--store-city", f"{scratch}/m",
            "--out", f"{scratch}/out"]
    main(args, spark)
    said = capsys.readouterr().out
    assert f"inventory_snapshots: {snap.count()} rows loaded, 0 rejected" in said
    assert f"category_dim: {cats.count()} rows loaded, 1 rejected" in said
    main(args, spark)
    assert capsys.readouterr().out.count("loaded before") == 3
    with pytest.raises(keyed.KeyViolation):
        main([*args, "--batch", "again", "--strict"], spark)


def test_interleaved_builders_make_one_table(spark, scratch):
    """A second builder that starts and ends while the first one builds wins; the first one's rows are dropped."""
    path = os.path.join(scratch, "t")
    inner = []

    def slow():
        inner.append(create_table_if_absent(spark, lambda: city(spark, (1, "inner")), path=path))
        return city(spark, (1, "outer"))

    assert not create_table_if_absent(spark, slow, path=path) and inner == [True]
    assert rows(spark.read.parquet(path), "city_name") == [("inner",)]
    assert set(os.listdir(scratch)) == {"t"}


def test_builders_at_the_same_time_make_one_table(spark, scratch):
    path, gate, won = os.path.join(scratch, "t"), threading.Barrier(4), []

    def build(i):
        def rows_():
            gate.wait()
            return city(spark, *[(n, str(i)) for n in range(50)])
        won.append(create_table_if_absent(spark, rows_, path=path))

    threads = [threading.Thread(target=build, args=(i,)) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(won) == [False, False, False, True]
    got = spark.read.parquet(path)
    assert got.count() == 50 and got.select("city_name").distinct().count() == 1
    assert set(os.listdir(scratch)) == {"t"}


def test_a_build_that_fails_leaves_nothing(spark, scratch):
    path = os.path.join(scratch, "t")
    with pytest.raises(Exception, match="boom"):
        create_table_if_absent(spark, lambda: spark.range(3).select(F.raise_error(F.lit("boom"))), path=path)
    assert os.listdir(scratch) == []
    os.makedirs(path)                                       # an empty folder is no table
    assert create_table_if_absent(spark, lambda: city(spark, (1, "A")), path=path)
    assert spark.read.parquet(path).count() == 1


def test_a_folder_is_never_moved_into_another(spark, scratch):
    for name in ("made", "there"):
        os.makedirs(f"{scratch}/{name}")
        open(f"{scratch}/{name}/{name}.txt", "w").close()
    assert not commit_folder(spark, f"{scratch}/made", f"{scratch}/there")
    assert [f for f in os.listdir(f"{scratch}/there") if not f.startswith(".")] == ["there.txt"]
    assert "made" not in os.listdir(scratch)
