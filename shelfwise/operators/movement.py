"""Stock movement: next snapshot, units sold from drops, restock estimate, shelf flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.joins import DEFAULT_BROADCAST_ROWS, sized_broadcast
from ..functions.numeric import MEAN_TYPE, pg_mean
from .sequence import DEFAULT_SEGMENT_ROWS, SEGMENT, lead_in_sequence, split_sequences

PAIR = ["store_id", "sku_id"]
MOVEMENT_COLUMNS = [
    "created_at", "event_time", "event_date", "store_id", "sku_id", "category_id", "sub_category_id", "sku_name",
    "brand_id", "brand", "image_url", "mrp", "selling_price", "city_name", "inventory", "next_inventory",
    "next_event_time"]


def attach_city(snap: DataFrame, store_city: DataFrame,
                broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Snapshots of stores present in the store map, with their city (inner join, 1:1 on the map key)."""
    city = sized_broadcast(store_city.select("store_id", "city_name"), broadcast_rows)
    return snap.join(city, "store_id", "inner")


def split_movement(snap: DataFrame, store_city: DataFrame, *,
                   max_rows_per_segment: int | None = DEFAULT_SEGMENT_ROWS,
                   broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                   snapshot_rows: int | None = None) -> tuple[DataFrame, list[str]]:
    """``inventory_movement`` with the columns long sequences were split on, which are returned too.

    Later stages group on them, so the LEAD partitioning is reused without
    another shuffle.  ``snapshot_rows`` (the row count of ``snap``, counted
    here if not given) bounds the sequence lengths.
    """
    m = attach_city(snap, store_city, broadcast_rows).select(
        F.col("created_at"),
        F.col("created_at").cast("timestamp_ntz").alias("event_time"),
        F.to_date("created_at").alias("event_date"),
        "store_id", "sku_id",
        F.col("l1_category_id").alias("category_id"),
        F.col("l2_category_id").alias("sub_category_id"),
        "sku_name", "brand_id", "brand", "image_url", "mrp", "selling_price",
        "city_name", "inventory")
    segments = None
    if max_rows_per_segment:
        segments = split_sequences(m, PAIR, "created_at", ["inventory"], max_rows_per_segment, broadcast_rows,
                                   row_bound=snap.count() if snapshot_rows is None else snapshot_rows, source=snap)
    moved = lead_in_sequence(m, PAIR, "created_at", ["inventory"], segments)
    return moved.withColumn("next_event_time", F.col("next_created_at").cast("timestamp_ntz")) \
                .drop("next_created_at"), [SEGMENT] if segments else []


def inventory_movement(snap: DataFrame, store_city: DataFrame, **options) -> DataFrame:
    """Each snapshot of a mapped store with the inventory and time of the next
    snapshot of the same (store, sku), in time order, across day ends.

    The columns are ``MOVEMENT_COLUMNS``, whether hot pairs were split or not;
    options as in ``split_movement``.
    """
    moves, _ = split_movement(snap, store_city, **options)
    return moves.select(*MOVEMENT_COLUMNS)


def direct_sales(moves: DataFrame) -> DataFrame:
    """Units sold seen directly: the drop to the next snapshot; NULL for the last
    snapshot, no change, a rise or unknown stock."""
    inv, nxt = F.col("inventory"), F.col("next_inventory")
    return moves.withColumn("direct_qty_sold", F.when(nxt < inv, inv - nxt))


def avg_historical_sales(sales: DataFrame) -> DataFrame:
    """Mean direct drop per (store, sku) over its whole history; pairs with no drop are absent."""
    return (sales.filter(F.col("direct_qty_sold").isNotNull())
                 .groupBy(*PAIR)
                 .agg(F.sum("direct_qty_sold").alias("_s"), F.count("direct_qty_sold").alias("_n"))
                 .select(*PAIR, pg_mean(F.col("_s"), F.col("_n")).alias("avg_sold")))


def _estimate(mean: Column) -> Column:
    zero = F.lit(0).cast(MEAN_TYPE)
    return (F.when(F.col("direct_qty_sold").isNotNull(), F.col("direct_qty_sold").cast(MEAN_TYPE))
             .when(F.col("next_inventory") > F.col("inventory"), F.coalesce(mean, zero))
             .otherwise(zero))


def estimated_qty(sales: DataFrame, split: bool = False) -> DataFrame:
    """Per snapshot: the direct drop, else on a rise the (store, sku) mean drop (0 if none), else 0.

    The mean is a window over the LEAD's own partitioning, so it adds no
    shuffle and no scan.  ``split``: hot pairs were split, whose rows must not
    meet in one task again; their mean is then aggregated (partially per task)
    and joined, broadcast or skew-split by AQE.
    """
    if split:
        return sales.join(avg_historical_sales(sales), PAIR, "left") \
                    .withColumn("est_qty_sold_per_record", _estimate(F.col("avg_sold")))
    w = Window.partitionBy(*PAIR)
    mean = pg_mean(F.sum("direct_qty_sold").over(w), F.count("direct_qty_sold").over(w))
    return sales.withColumn("avg_sold", mean) \
                .withColumn("est_qty_sold_per_record", _estimate(F.col("avg_sold")))


def estimated_sales(snap: DataFrame, store_city: DataFrame, **options) -> DataFrame:
    """``estimated_qty`` of ``direct_sales`` of the snapshots' movement; options as in ``split_movement``."""
    moves, seg_cols = split_movement(snap, store_city, **options)
    return estimated_qty(direct_sales(moves), split=bool(seg_cols)).drop(*seg_cols)


def stock_status(snap: DataFrame, store_city: DataFrame, *,
                 broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Per snapshot of a mapped store: 1 if inventory > 0, else 0 (NULL stock counts as 0)."""
    m = attach_city(snap, store_city, broadcast_rows)
    return m.select(F.to_date("created_at").alias("event_date"), "sku_id", "store_id", "city_name",
                    F.when(F.col("inventory") > 0, 1).otherwise(0).alias("is_in_stock"))
