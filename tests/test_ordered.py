"""Tables stored in order."""

import os

import pytest
from pyspark.sql import functions as F

from shelfwise.plans.city_insights import build_city_insights, ordered
from shelfwise.sources import ordered as stored

from .handmade import frames
from .test_plans import plan


def test_insights_are_read_in_order_without_a_sort(spark, scratch):
    ins = build_city_insights(*frames(spark))
    path = os.path.join(scratch, "t")
    assert stored.write_ordered(ins, path, ["date", "city_name", "sku_id"], files=3)
    assert not stored.write_ordered(ins, path, ["date"])                         # there already
    got = stored.read_ordered(spark, path, ins.schema)
    p = plan(got)
    assert "Sort" not in p and "Exchange" not in p
    keys = ["date", "city_name", "sku_id"]
    want = [tuple(r) for r in ordered(ins).select(*keys).collect()]
    assert [tuple(r) for r in got.select(*keys).collect()] == want
    assert [tuple(r) for r in got.select(*keys).limit(2).collect()] == want[:2]
    assert sorted(got.collect(), key=repr) == sorted(ins.collect(), key=repr)


@pytest.mark.parametrize("split", ["1000b", "128m"])
def test_order_and_positions_with_split_files(spark, scratch, split):
    """NULLs last, ties in one range, files that a reader splits."""
    df = spark.range(5000).select(
        F.when(F.col("id") % 11 != 0, F.col("id") * 7919 % 1000).alias("a.b"), F.col("id").alias("id"),
        F.repeat(F.lit("x"), 50).alias("fill")).repartition(5)
    path = os.path.join(scratch, "t")
    spark.conf.set("parquet.block.size", "2000")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        stored.write_ordered(df, path, ["a.b", "id"], files=4)
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        got = stored.with_position(stored.read_ordered(spark, path, df.schema)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("parquet.block.size")
    key = [(r["a.b"] is None, r["a.b"] or 0, r.id) for r in got]
    assert key == sorted(key) and [r.position for r in got] == list(range(1, 5001))


def test_empty_and_absent_tables(spark, scratch):
    none = spark.createDataFrame([], "k long, v string")
    assert stored.read_ordered(spark, os.path.join(scratch, "nothing"), none.schema).isEmpty()
    stored.write_ordered(none, os.path.join(scratch, "t"), ["k"])
    assert stored.with_position(stored.read_ordered(spark, os.path.join(scratch, "t"), none.schema)).isEmpty()
