"""The insights build without its two main rewrites, for the bench and as a second check.

Uses the library's own steps, but takes the mean drop by a join instead of
from the daily grain, and materialises the fan-out (every snapshot times
every stock row of its store-day) instead of multiplying by its size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.numeric import FRACTION_TYPE, WHOLE_TYPE, carried
from shelfwise.operators import insights, movement, pricing


def fanned_out_insights(snap: DataFrame, city: DataFrame, cats: DataFrame) -> DataFrame:
    rows = movement.estimated_qty(movement.direct_sales(movement.inventory_movement(snap, city)), split=True)
    stock = movement.stock_status(snap, city).withColumn("stocked", F.when(F.col("is_in_stock") == 1, F.col("store_id")))
    fanned = rows.join(stock, ["event_date", "sku_id", "store_id", "city_name"], "left")
    agg = fanned.groupBy(*insights.GROUP_KEYS).agg(
        F.sum("est_qty_sold_per_record").alias("_units"),
        F.count_distinct("store_id").alias("listed_ds_count"),
        F.count_distinct("stocked").alias("in_stock_store_count"))
    whole, frac = carried(F.lit(0).cast(WHOLE_TYPE), F.col("_units").cast(FRACTION_TYPE))
    agg = agg.withColumns({"est_whole": whole, "est_frac": frac}).drop("_units")
    modes = pricing.price_modes(rows).select(*pricing.MODE_KEYS, "mrp_mode", "sp_mode")
    return insights.city_insights(agg.join(modes, pricing.MODE_KEYS, "left"),
                                  insights.total_stores_per_city(rows), cats)
