"""Registered queries: one callable per operator, each taking (spark, sf_dir).

Each callable loads the stand-in inputs from the test tables at ``sf_dir``,
runs the library operator over the whole tables and returns its result with
``comparable`` applied: output values are unchanged, only represented in
plain types the DuckDB oracle also produces (see ``plans.oracle``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import analyses, attendance, insights, movement, pricing, quality
from ..session import staging_dir
from ..sources import csv_io, feeds, keyed, schemas
from ..sources import ordered as stored
from ..streaming.ingest import start_snapshot_ingest
from .city_insights import build_city_insights, build_daily, materialize, ordered
from .oracle import WINDOW_END, WINDOW_START

# Rows per key from which the ``*_split`` queries split, far below production's, so that most keys are.
SPLIT_ROWS = 5

Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """Plain output types: 0-place decimals and small ints -> bigint, 1-2 place
    decimals -> double, wider decimals -> plain text, dates/timestamps -> text."""
    cols = []
    for f in df.schema.fields:
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, T.DecimalType):
            c = c.cast("bigint") if t.scale == 0 else c.cast("double") if t.scale <= 2 else c.cast("string")
        elif isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(cols)


def nullable_counts(df: DataFrame, *cols: str) -> DataFrame:
    """Integer columns that hold NULLs, shown as DOUBLE (exact below 2^53).

    pandas turns a nullable BIGINT into float64 from Spark but Int64 from
    DuckDB; DOUBLE reads the same from both engines however it is collected.
    """
    return df.select([F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])


def _inputs(spark: SparkSession, sf_dir: str):
    """Snapshots, store map and categories."""
    return (feeds.snapshot_feed(spark, sf_dir), feeds.store_city_feed(spark, sf_dir),
            feeds.category_feed(spark, sf_dir))


def _moves(spark, sf_dir, **options):
    snap, city, _ = _inputs(spark, sf_dir)
    return movement.inventory_movement(snap, city, **options)


def _insights(spark, sf_dir, **options):
    return build_city_insights(*_inputs(spark, sf_dir), **options)


def _movement(m):
    return nullable_counts(comparable(m.drop("created_at")), "inventory", "next_inventory")


def inventory_movement(spark, sf_dir):
    return _movement(_moves(spark, sf_dir))


def inventory_movement_split(spark, sf_dir):
    """``inventory_movement`` with long sequences split at about SPLIT_ROWS snapshots."""
    return _movement(_moves(spark, sf_dir, max_rows_per_segment=SPLIT_ROWS))


def direct_sales(spark, sf_dir):
    s = movement.direct_sales(_moves(spark, sf_dir))
    return nullable_counts(comparable(s.select("store_id", "sku_id", "event_time", "inventory",
                                               "next_inventory", "direct_qty_sold")),
                           "inventory", "next_inventory", "direct_qty_sold")


def avg_historical_sales(spark, sf_dir):
    return comparable(movement.avg_historical_sales(movement.direct_sales(_moves(spark, sf_dir))))


def estimated_qty(spark, sf_dir):
    snap, city, _ = _inputs(spark, sf_dir)
    e = movement.estimated_sales(snap, city)
    return comparable(e.select("store_id", "sku_id", "event_time", "est_qty_sold_per_record"))


def stock_status(spark, sf_dir):
    snap, city, _ = _inputs(spark, sf_dir)
    return comparable(movement.stock_status(snap, city))


def price_modes(spark, sf_dir):
    e = movement.direct_sales(_moves(spark, sf_dir))
    return comparable(pricing.price_modes(e))


def city_level_agg(spark, sf_dir):
    snap, city, _ = _inputs(spark, sf_dir)
    daily = build_daily(snap, city)
    agg = insights.city_level_agg(daily, pricing.price_modes(daily, weight="rows"))
    return comparable(agg)


def total_stores_per_city(spark, sf_dir):
    snap, city, _ = _inputs(spark, sf_dir)
    mapped = movement.attach_city(snap, city).withColumn("event_date", F.to_date("created_at"))
    return comparable(insights.total_stores_per_city(mapped))


def city_insights(spark, sf_dir):
    return comparable(_insights(spark, sf_dir))


def city_insights_split(spark, sf_dir):
    """``city_insights`` with long sequences split at about SPLIT_ROWS snapshots."""
    return comparable(_insights(spark, sf_dir, max_rows_per_segment=SPLIT_ROWS))


def ordered_insights(spark, sf_dir):
    """``city_insights`` in its presentation order."""
    return comparable(ordered(_insights(spark, sf_dir)))


def _stored_in_order(df: DataFrame, name: str, by: list[str]) -> DataFrame:
    spark = df.sparkSession
    path = f"{staging_dir(spark)}/{name}/{uuid.uuid4().hex}"
    stored.write_ordered(df, path, by)
    return stored.with_position(stored.read_ordered(spark, path, df.schema))


def ordered_table(spark, sf_dir):
    """``city_insights`` stored in its presentation order and read without a sort, with each row's place."""
    return comparable(_stored_in_order(_insights(spark, sf_dir), "ordered_table", ["date", "city_name", "sku_id"]))


def ordered_log(spark, sf_dir):
    """Swipes stored by employee and time (then action) and read without a sort, with each row's place."""
    return comparable(_stored_in_order(feeds.attendance_feed(spark, sf_dir), "ordered_log",
                                       ["employee_id", "created_at", "action"]))


def create_if_absent(spark, sf_dir):
    """``city_insights`` as a table that is created twice: the second time builds nothing."""
    path = f"{staging_dir(spark)}/create_if_absent/{uuid.uuid4().hex}"
    first = materialize(spark, lambda: _inputs(spark, sf_dir), path=path)
    again = materialize(spark, _never, path=path)
    if not first or again:
        raise AssertionError("the table must be created by the first call only")
    return comparable(spark.read.parquet(path).select(*schemas.INSIGHTS_COLUMNS))


def _never():
    raise AssertionError("the table is there, its inputs must not be asked for")


def _report(fn) -> Query:
    def run(spark, sf_dir):
        return comparable(fn(_insights(spark, sf_dir)))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def hours_worked(spark, sf_dir):
    return comparable(attendance.hours_worked(feeds.attendance_feed(spark, sf_dir)))


def hours_worked_split(spark, sf_dir):
    """``hours_worked`` with long sequences split at about SPLIT_ROWS swipes."""
    return comparable(attendance.hours_worked(feeds.attendance_feed(spark, sf_dir),
                                              max_rows_per_segment=SPLIT_ROWS))


def hours_in_window(spark, sf_dir):
    log = feeds.attendance_feed(spark, sf_dir)
    return comparable(attendance.hours_in_window(log, WINDOW_START, WINDOW_END))


def hours_in_window_split(spark, sf_dir):
    """``hours_in_window`` with long sequences split at about SPLIT_ROWS swipes."""
    log = feeds.attendance_feed(spark, sf_dir)
    return comparable(attendance.hours_in_window(log, WINDOW_START, WINDOW_END, max_rows_per_segment=SPLIT_ROWS))


def pair_swipes(spark, sf_dir):
    return comparable(attendance.pair_swipes(feeds.attendance_feed(spark, sf_dir)))


def attendance_log(spark, sf_dir):
    return comparable(attendance.attendance_log(feeds.attendance_feed(spark, sf_dir)))


def key_violations(spark, sf_dir):
    snap, city, cat = _inputs(spark, sf_dir)
    parts = [
        quality.key_violations(snap, "inventory_snapshots", schemas.SNAPSHOT_KEY,
                               schemas.SNAPSHOT_NOT_NULL),
        quality.key_violations(city, "store_city", schemas.STORE_CITY_KEY, []),
        quality.key_violations(cat, "category_dim", schemas.CATEGORY_KEY, []),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _round_trip(df: DataFrame, schema) -> DataFrame:
    """Written as CSV under the staging folder and loaded back."""
    path = f"{staging_dir(df.sparkSession)}/csv_round_trip/{uuid.uuid4().hex}"
    return comparable(csv_io.csv_round_trip(df, path, schema, multiline=True))


def csv_round_trip(spark, sf_dir):
    """Snapshots written as CSV and loaded back."""
    return _round_trip(feeds.snapshot_feed(spark, sf_dir), schemas.SNAPSHOT_SCHEMA)


def csv_categories(spark, sf_dir):
    """Categories written as CSV and loaded back."""
    return _round_trip(feeds.category_feed(spark, sf_dir), schemas.CATEGORY_SCHEMA)


def csv_store_city(spark, sf_dir):
    """The store map written as CSV and loaded back."""
    return _round_trip(feeds.store_city_feed(spark, sf_dir), schemas.STORE_CITY_SCHEMA)


def keyed_ingest(spark, sf_dir):
    """Snapshot CSV drops loaded in two batches by the incremental ingest: the rows it accepted and rejected.

    Besides the snapshots themselves, the first drop has those of SKU 1 again with
    more stock and those of SKU 2 without a time; the second has those of each third store
    again, and those of SKU 3 at a later time twice.
    """
    snap = feeds.snapshot_feed(spark, sf_dir)
    base = f"{staging_dir(spark)}/keyed_ingest/{uuid.uuid4().hex}"
    more = snap.filter("sku_id = 1").withColumn("inventory", (F.col("inventory") + 1000).cast("int"))
    timeless = snap.filter("sku_id = 2").withColumn("created_at", F.lit(None).cast("timestamp"))
    later = snap.filter("sku_id = 3").withColumn("created_at", F.col("created_at") + F.expr("interval 400 days"))
    drops = [snap.unionByName(more).unionByName(timeless),
             snap.filter("store_id % 3 = 0").unionByName(later).unionByName(later)]
    for i, drop in enumerate(drops):
        csv_io.write_csv(drop, f"{base}/drops/{i}")
        start_snapshot_ingest(spark, f"{base}/drops/*", f"{base}/table").awaitTermination()
    cols = ["created_at", "store_id", "sku_id", "inventory"]
    table = keyed.read_table(spark, f"{base}/table", keyed.SNAPSHOTS)
    rejects = keyed.read_rejects(spark, f"{base}/table", keyed.SNAPSHOTS)
    out = table.select(*cols, F.col("batch").cast("int").alias("drop_no"), F.lit("accepted").alias("outcome"),
                       F.lit(1).alias("copies")).unionByName(
        rejects.select(*cols, F.col("batch").cast("int").alias("drop_no"), F.col("reason").alias("outcome"), "copies"))
    return nullable_counts(comparable(out), "inventory")


def queries() -> dict[str, Query]:
    plain = [inventory_movement, inventory_movement_split, direct_sales, avg_historical_sales, estimated_qty,
             stock_status, price_modes, city_level_agg, total_stores_per_city, city_insights, city_insights_split,
             ordered_insights, ordered_table, ordered_log, create_if_absent, hours_worked, hours_worked_split,
             hours_in_window, hours_in_window_split, pair_swipes, attendance_log, key_violations, keyed_ingest,
             csv_round_trip, csv_categories, csv_store_city]
    reports = [analyses.top_skus, analyses.skus_by_city, analyses.stockout_skus, analyses.brand_revenue,
               analyses.city_revenue, analyses.category_revenue, analyses.discount_bands]
    return {f.__name__: f for f in [*plain, *map(_report, reports)]}
