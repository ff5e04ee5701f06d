"""Incremental snapshot ingest: each file once, across restarts, for each table."""

import os

import pytest

from shelfwise.sources import csv_io
from shelfwise.streaming.ingest import start_snapshot_ingest

from .handmade import frames


def test_ingest_is_incremental_and_exactly_once(spark, scratch):
    snap, _, _ = frames(spark)
    src, out = os.path.join(scratch, "drops"), os.path.join(scratch, "table")
    first = snap.filter("store_id < 3")
    second = snap.filter("store_id >= 3")
    csv_io.write_csv(first, os.path.join(src, "batch1"), mode="overwrite")
    start_snapshot_ingest(spark, os.path.join(src, "*"), out).awaitTermination()
    assert spark.read.parquet(out).count() == first.count()
    csv_io.write_csv(second, os.path.join(src, "batch2"), mode="overwrite")
    for _ in range(2):
        start_snapshot_ingest(spark, os.path.join(src, "*"), out).awaitTermination()
        got = spark.read.parquet(out).drop("snapshot_date")
        assert sorted(got.select(snap.columns).collect()) == sorted(snap.collect())


def test_one_source_into_two_tables(spark, scratch):
    snap, _, _ = frames(spark)
    src = os.path.join(scratch, "drops")
    csv_io.write_csv(snap, src)
    for table in ("a", "b"):
        start_snapshot_ingest(spark, src, os.path.join(scratch, table)).awaitTermination()
        assert spark.read.parquet(os.path.join(scratch, table)).count() == snap.count()


def test_a_second_source_into_one_table_is_an_error(spark, scratch):
    snap, _, _ = frames(spark)
    table = os.path.join(scratch, "t")
    for name in ("x", "y"):
        csv_io.write_csv(snap, os.path.join(scratch, name))
    start_snapshot_ingest(spark, os.path.join(scratch, "x"), table).awaitTermination()
    with pytest.raises(ValueError):
        start_snapshot_ingest(spark, os.path.join(scratch, "y"), table)
    assert spark.read.parquet(table).count() == snap.count()
