"""City-level daily roll-up and the insights table.

The reference joins every snapshot to every stock row of the same
(day, sku, store, city) before summing, so each estimate is counted ``n``
times, ``n`` being that store-day's number of snapshots (1 when the city is
NULL, which never matches).  That fan-out is reproduced exactly, but without
materialising it: ``n`` is constant over a (store, sku, day), so

    sum over rows of n * est  ==  n * (sum of drops + rises * mean drop)

is computed from one pre-aggregated row per (store, sku, day, attributes,
prices).  These rows get their pair's mean, ``n``, units and stock flag in the
LEAD's own partitioning: they are the *daily grain*.  The full snapshot table
is shuffled once (for LEAD); everything after works on the daily grain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.joins import DEFAULT_BROADCAST_ROWS, sized_broadcast
from ..functions.numeric import (FRACTION_TYPE, WHOLE_TYPE, carried, money, pg_mean, ratio2,
                                 units_contribution)
from .movement import PAIR
from .pricing import MODE_KEYS

GROUP_KEYS = ["event_date", "sku_id", "city_name", "category_id", "sub_category_id",
              "sku_name", "brand_id", "brand", "image_url"]
STORE_DAY = [*PAIR, "event_date"]
ATTRIBUTES = ["city_name", "category_id", "sub_category_id", "sku_name", "brand_id", "brand", "image_url",
              "mrp", "selling_price"]


def daily_grain(sales: DataFrame, seg_cols: list[str] | None = None) -> DataFrame:
    """``direct_sales`` output by (store, sku, day, attributes, prices).

    rows: snapshots; in_stock: 1 if the store had stock that day; units:
    estimated units counted once; fanned_units: counted ``n`` times; both as
    a whole part and the rest (``functions.numeric``).

    The sums per pair and store-day are windows over the aggregated rows, in
    the LEAD's partitioning: no shuffle of its own.  Where long sequences were
    split (``seg_cols``, the columns they were split on) the rows are
    aggregated per segment first, and what that leaves, no longer one row per
    snapshot, is shuffled to its pair and aggregated again.
    """
    inv, nxt = F.col("inventory"), F.col("next_inventory")
    rows = sales.groupBy(*STORE_DAY, *(seg_cols or []), *ATTRIBUTES).agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum("direct_qty_sold"), F.lit(0)).cast("long").alias("_drops"),
        F.count("direct_qty_sold").alias("_drop_rows"),
        F.sum(F.when(nxt > inv, 1).otherwise(0)).cast("long").alias("_rises"),
        F.max(F.when(inv > 0, 1).otherwise(0)).alias("_stock"))
    if seg_cols:
        rows = rows.repartition(*PAIR).groupBy(*STORE_DAY, *ATTRIBUTES).agg(
            *[F.sum(c).alias(c) for c in ("rows", "_drops", "_drop_rows", "_rises")], F.max("_stock").alias("_stock"))
    w, d = Window.partitionBy(*PAIR), Window.partitionBy(*STORE_DAY)
    rows = (rows.withColumn("_pair_drops", F.sum("_drops").over(w))
                .withColumn("_pair_rows", F.sum("_drop_rows").over(w))
                .withColumn("_n", F.sum("rows").over(d))
                .withColumn("in_stock", F.max("_stock").over(d)))
    mean = pg_mean(F.col("_pair_drops"), F.col("_pair_rows"))
    n = F.when(F.col("city_name").isNull(), F.lit(1)).otherwise(F.col("_n"))

    def units(name, times):
        whole, rest = units_contribution(times, F.col("_drops"), F.col("_rises"), mean)
        return [whole.alias(f"{name}_whole"), rest.alias(f"{name}_rest")]

    return rows.select(*STORE_DAY, *ATTRIBUTES, "rows",
                       F.when(F.col("city_name").isNull(), F.lit(0)).otherwise(F.col("in_stock")).alias("in_stock"),
                       *units("units", F.lit(1).cast("long")), *units("fanned_units", n))


def total_stores_per_city(mapped: DataFrame) -> DataFrame:
    """Distinct stores seen per (day, city) -- from snapshots or from the daily grain."""
    return (mapped.select("event_date", "city_name", "store_id").distinct()
                  .groupBy("event_date", "city_name")
                  .agg(F.count(F.lit(1)).alias("total_ds_count")))


def city_roll_up(daily: DataFrame, modes: DataFrame, *, dedupe: bool = False) -> DataFrame:
    """Per (day, sku, city, category, sub-category, name, brand id, brand, image): est_whole and est_frac
    (estimated units, unrounded, in two parts; with the reference's fan-out unless ``dedupe``), modal prices,
    listed_ds_count and in_stock_store_count.

    One shuffle of the daily grain on (day, sku, city) serves the roll-up to
    stores, the one to the city and the join to the modes.
    """
    units = "units" if dedupe else "fanned_units"
    per_store = (daily.repartition(*MODE_KEYS).groupBy(*GROUP_KEYS, "store_id")
                      .agg(F.sum(f"{units}_whole").alias("_whole"), F.sum(f"{units}_rest").alias("_rest"),
                           F.max("in_stock").alias("_stock")))
    agg = (per_store.groupBy(*GROUP_KEYS)
                    .agg(F.sum("_whole").cast(WHOLE_TYPE).alias("_whole"),
                         F.sum("_rest").cast(FRACTION_TYPE).alias("_rest"),
                         F.count(F.lit(1)).alias("listed_ds_count"),
                         F.sum("_stock").cast("long").alias("in_stock_store_count")))
    whole, frac = carried(F.col("_whole"), F.col("_rest"))
    agg = agg.withColumns({"est_whole": whole, "est_frac": frac}).drop("_whole", "_rest")
    return agg.join(modes.select(*MODE_KEYS, "mrp_mode", "sp_mode"), MODE_KEYS, "left")


def city_level_agg(daily: DataFrame, modes: DataFrame, *, dedupe: bool = False) -> DataFrame:
    """``city_roll_up`` with est_qty_sold as one number, which has room below 10^17."""
    est = (F.col("est_whole").cast(FRACTION_TYPE) + F.col("est_frac")).cast(FRACTION_TYPE)
    return city_roll_up(daily, modes, dedupe=dedupe).withColumn("est_qty_sold", est).drop("est_whole", "est_frac")


def city_insights(agg: DataFrame, totals: DataFrame, categories: DataFrame, *,
                  broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """The 22-column insights table; rows with zero estimated units are skipped.

    ``agg`` is a ``city_roll_up``.  Sales use the unrounded units times the modal price; availability and
    discount are guarded ratios rounded to 2 places.  Unsorted: sort at read
    (``plans.city_insights.ordered``).  ``totals`` (from the written daily
    grain) and the category table are measured before they are broadcast.
    """
    t = sized_broadcast(totals, broadcast_rows)
    c = sized_broadcast(categories.select(
        F.col("l2_category_id").alias("_l2"),
        F.col("l1_category").alias("category_name"),
        F.col("l2_category").alias("sub_category_name")), broadcast_rows)
    j = (agg.join(t, ["event_date", "city_name"], "left")
            .join(c, F.col("sub_category_id") == F.col("_l2"), "left")
            .filter((F.col("est_whole") > 0) | (F.col("est_frac") > 0)))
    whole, frac = F.col("est_whole"), F.col("est_frac")
    total, listed = F.col("total_ds_count"), F.col("listed_ds_count")
    instock, mrp, sp = F.col("in_stock_store_count"), F.col("mrp_mode"), F.col("sp_mode")
    zero = F.lit(0).cast("decimal(10,2)")
    return j.select(
        F.col("event_date").alias("date"), "brand_id", "brand", "image_url", "city_name",
        "sku_id", "sku_name", "category_id", "category_name", "sub_category_id", "sub_category_name",
        (whole + F.round(frac, 0)).cast("decimal(38,0)").alias("est_qty_sold"),
        money(whole, frac, sp).alias("est_sales_sp"),
        money(whole, frac, mrp).alias("est_sales_mrp"),
        listed.alias("listed_ds_count"),
        total.alias("ds_count"),
        instock.alias("in_stock_store_count"),
        F.when(total > 0, ratio2(instock, total)).otherwise(zero).alias("wt_osa"),
        F.when(listed > 0, ratio2(instock, listed)).otherwise(zero).alias("wt_osa_ls"),
        mrp.alias("mrp"),
        sp.alias("sp"),
        F.when(mrp > 0, ratio2(mrp - sp, mrp)).otherwise(zero).alias("discount"))
