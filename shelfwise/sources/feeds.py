"""Stand-in inputs built from the driver's test tables.

The reference's own CSV files are not public, so the operators run on rows
derived from the test tables with the rules of FIXTURES.md section 3.  These
functions rename and re-type columns into the declared schemas (the bench-only
bulk feed also keeps one row per declared key); they do none of the
operators' work, and nothing downstream relies on how the rows were made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.joins import sized_broadcast
from .schemas import ATTENDANCE_SCHEMA, CATEGORY_SCHEMA, SNAPSHOT_SCHEMA, STORE_CITY_SCHEMA

# Fixed values (FIXTURES.md section 3): event type -> sku id.
SKU_OF_EVENT = {"click": 1, "view": 2, "purchase": 3, "error": 4, "signup": 5}
# Event type -> attendance action.
ACTION_OF_EVENT = {"click": "In", "view": "Out"}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sku(event_type: Column) -> Column:
    expr = None
    for name, sku in SKU_OF_EVENT.items():
        expr = (F.when(event_type == name, F.lit(sku)) if expr is None
                else expr.when(event_type == name, F.lit(sku)))
    return expr.cast("long")


def _conform(df: DataFrame, schema) -> DataFrame:
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def snapshot_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """inventory_snapshots from ``events``: one snapshot per event."""
    ev = _table(spark, sf_dir, "events")
    sku = _sku(F.col("event_type"))
    df = ev.select(
        F.col("ts").cast("timestamp").alias("created_at"),
        (sku % 2).alias("l1_category_id"),
        sku.alias("l2_category_id"),
        F.col("user_id").alias("store_id"),
        sku.alias("sku_id"),
        F.col("event_type").alias("sku_name"),
        (F.lit(90) + F.lit(5) * (F.col("event_id") % 3)).alias("selling_price"),
        (F.lit(100) + F.lit(10) * (F.col("user_id") % 3)).alias("mrp"),
        F.get_json_object("props", "$.k").cast("int").alias("inventory"),
        F.lit("img").alias("image_url"),
        (sku % 3).alias("brand_id"),
        F.concat(F.lit("brand_"), (sku % 3).cast("string")).alias("brand"),
        F.lit("unit").alias("unit"),
    )
    return _conform(df, SNAPSHOT_SCHEMA)


def store_city_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """store_city from ``customer`` and ``nation``: customer key -> nation name."""
    c = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    df = (c.join(sized_broadcast(n), c.c_nationkey == n.n_nationkey, "left")
          .select(F.col("c_custkey").alias("store_id"), F.col("n_name").alias("city_name")))
    return _conform(df, STORE_CITY_SCHEMA)


def category_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """category_dim: one row per event type, through the same sku rule."""
    ev = _table(spark, sf_dir, "events").select("event_type").distinct()
    sku = _sku(F.col("event_type"))
    df = ev.filter(sku.isNotNull()).select(
        F.concat(F.lit("group_"), (sku % 2).cast("string")).alias("l1_category"),
        (sku % 2).alias("l1_category_id"),
        F.col("event_type").alias("l2_category"),
        sku.alias("l2_category_id"),
    )
    return _conform(df, CATEGORY_SCHEMA)


def attendance_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """attendance_log from ``events``: click = In, view = Out, per user."""
    ev = _table(spark, sf_dir, "events")
    action = F.when(F.col("event_type") == "click", "In").when(F.col("event_type") == "view", "Out")
    df = (ev.filter(F.col("event_type").isin(*ACTION_OF_EVENT))
          .select(F.col("user_id").cast("string").alias("employee_id"),
                  action.alias("action"),
                  F.col("ts").alias("created_at")))
    return _conform(df, ATTENDANCE_SCHEMA)


def bulk_snapshot_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Larger inventory_snapshots from ``lineitem`` (bench input; FIXTURES.md section 3).

    created_at = ship date + (order key % 24) hours, store = supplier,
    sku = part size; rows are reduced to one per (created_at, sku, store) key
    (max quantity as stock) because the declared key is unique.
    """
    li = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey",
                                                   "l_quantity", "l_shipdate")
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_size")
    rows = (li.join(part, li.l_partkey == part.p_partkey, "inner")
              .select((F.col("l_shipdate").cast("timestamp")
                       + F.make_dt_interval(F.lit(0), F.col("l_orderkey") % 24)).alias("created_at"),
                      F.col("l_suppkey").alias("store_id"),
                      F.col("p_size").cast("long").alias("sku_id"),
                      F.col("l_quantity"), F.col("l_orderkey")))
    snap = (rows.groupBy("created_at", "sku_id", "store_id")
                .agg(F.max("l_quantity").cast("int").alias("inventory"),
                     F.min("l_orderkey").alias("_o")))
    sku = F.col("sku_id")
    df = snap.select(
        "created_at", (sku % 5).alias("l1_category_id"), sku.alias("l2_category_id"),
        "store_id", "sku_id", F.concat(F.lit("size_"), sku.cast("string")).alias("sku_name"),
        (F.lit(90) + F.lit(5) * (F.col("_o") % 3)).alias("selling_price"),
        (F.lit(100) + F.lit(10) * (F.col("store_id") % 3)).alias("mrp"),
        "inventory", F.lit("img").alias("image_url"), (sku % 7).alias("brand_id"),
        F.concat(F.lit("brand_"), (sku % 7).cast("string")).alias("brand"), F.lit("unit").alias("unit"))
    return _conform(df, SNAPSHOT_SCHEMA)


def bulk_store_city_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """store_city for the bulk feed: supplier key -> nation name."""
    s = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    df = (s.join(sized_broadcast(n), s.s_nationkey == n.n_nationkey, "left")
          .select(F.col("s_suppkey").alias("store_id"), F.col("n_name").alias("city_name")))
    return _conform(df, STORE_CITY_SCHEMA)


def bulk_category_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """category_dim for the bulk feed: one row per part size."""
    sizes = _table(spark, sf_dir, "part").select(F.col("p_size").cast("long").alias("s")).distinct()
    df = sizes.select(F.concat(F.lit("group_"), (F.col("s") % 5).cast("string")).alias("l1_category"),
                      (F.col("s") % 5).alias("l1_category_id"),
                      F.concat(F.lit("size_"), F.col("s").cast("string")).alias("l2_category"),
                      F.col("s").alias("l2_category_id"))
    return _conform(df, CATEGORY_SCHEMA)
