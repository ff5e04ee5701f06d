"""The insights build: snapshots + store map + categories -> city_insights.

Shuffle plan, the same at every size (see README):
  1. snapshots join the store map (size-checked broadcast), one hash shuffle on
     (store, sku) for LEAD -- on (store, sku, segment) if there are hot keys,
     which are split (``operators.sequence``); drops and flags per row;
  2. aggregate to the daily grain with its means, fan-out, units and stock
     flags in the same partitions, and write it as Parquet to the cluster's
     shared folder.  This cuts the lineage right after the only shuffle of the
     snapshots: a lost executor never sends the build back to them, and each
     later branch reads only the columns it needs;
  3. daily grain -> modal prices, store totals and the city roll-up: shuffles
     of aggregated rows only;
  4. categories and store totals join by a measured broadcast.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.joins import DEFAULT_BROADCAST_ROWS
from ..functions.ordering import pg_asc
from ..operators.insights import city_insights, city_roll_up, daily_grain, total_stores_per_city
from ..operators.movement import direct_sales, split_movement
from ..operators.pricing import price_modes
from ..operators.sequence import DEFAULT_SEGMENT_ROWS
from ..session import release, staging_dir
from ..sources.tables import create_table_if_absent


def write_daily(snap: DataFrame, store_city: DataFrame, *,
                max_rows_per_segment: int | None = DEFAULT_SEGMENT_ROWS,
                broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> str:
    """Write the daily grain to the shared folder; returns its path.

    The row count of the snapshots (footers only on Parquet) bounds the
    hot-key check.
    """
    moves, seg_cols = split_movement(snap, store_city, max_rows_per_segment=max_rows_per_segment,
                                     broadcast_rows=broadcast_rows)
    path = f"{staging_dir(snap.sparkSession)}/daily_grain/{uuid.uuid4().hex}"
    daily_grain(direct_sales(moves), seg_cols).write.parquet(path)
    return path


def build_daily(snap: DataFrame, store_city: DataFrame, **options) -> DataFrame:
    """Daily grain of the snapshots, read back from where ``write_daily`` put it."""
    return snap.sparkSession.read.parquet(write_daily(snap, store_city, **options))


def insights_of(daily: DataFrame, categories: DataFrame, *, dedupe: bool = False,
                broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """city_insights of a written daily grain (unsorted)."""
    agg = city_roll_up(daily, price_modes(daily, weight="rows"), dedupe=dedupe)
    return city_insights(agg, total_stores_per_city(daily), categories, broadcast_rows=broadcast_rows)


def build_city_insights(snap: DataFrame, store_city: DataFrame, categories: DataFrame, *,
                        dedupe: bool = False,
                        max_rows_per_segment: int | None = DEFAULT_SEGMENT_ROWS,
                        broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """city_insights from the three input tables (unsorted).

    The result reads the written daily grain, which stays in the application's
    staging folder until ``session.release_staging``; ``materialize`` removes
    it by itself.
    """
    daily = build_daily(snap, store_city, max_rows_per_segment=max_rows_per_segment, broadcast_rows=broadcast_rows)
    return insights_of(daily, categories, dedupe=dedupe, broadcast_rows=broadcast_rows)


def ordered(insights: DataFrame) -> DataFrame:
    """The reference's presentation order: date, city, sku."""
    return insights.orderBy(pg_asc("date"), pg_asc("city_name"), pg_asc("sku_id"))


def materialize(spark: SparkSession, inputs: Callable[[], tuple[DataFrame, DataFrame, DataFrame]], *,
                table: str | None = None, path: str | None = None, dedupe: bool = False, **options) -> bool:
    """CREATE TABLE IF NOT EXISTS ... AS: built and written once, partitioned by date.

    ``inputs`` gives snapshots, store map and categories; it is called only if
    the table is absent.  A REBALANCE on the partition column groups each
    date's rows into evenly sized tasks (AQE splits a large date and merges
    small ones), instead of every task writing a small file for every date it
    holds.  The daily grain is deleted once the table is written.
    """
    made: list[str] = []

    def build() -> DataFrame:
        snap, store_city, categories = inputs()
        made.append(write_daily(snap, store_city, **options))
        return insights_of(spark.read.parquet(made[0]), categories, dedupe=dedupe).hint("rebalance", "date")

    try:
        return create_table_if_absent(spark, build, table=table, path=path, partition_by=["date"])
    finally:
        for grain in made:
            release(spark, grain)
