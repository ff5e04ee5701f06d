"""Modal prices per (day, sku, city)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODE_KEYS = ["event_date", "sku_id", "city_name"]


def price_counts(df: DataFrame, weight: str | None = None) -> DataFrame:
    """How often each (mrp, selling_price) pair occurs per (day, sku, city).

    ``weight`` names a column of row counts when ``df`` is already pre-aggregated.
    """
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.groupBy(*MODE_KEYS, "mrp", "selling_price").agg(n.cast("long").alias("pair_rows"))


def _argmax(price: str):
    # ORDER BY pair_rows DESC, price DESC with PostgreSQL's NULL-highest rule,
    # as an aggregate: the largest (freq, price IS NULL, price) wins.
    return F.max(F.struct(F.col("pair_rows").alias("f"), F.col(price).isNull().alias("n"),
                          F.col(price).alias("v")))


def price_modes(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Most frequent (mrp, selling_price) pair per (day, sku, city).

    ``mrp_mode``: mrp of the most frequent pair, ties to the higher mrp (NULL
    counts as highest).  ``sp_mode`` likewise with ties to the higher selling
    price; the two may come from different pairs.  Two aggregations with
    map-side partial aggregation and no window (the arg-max over a struct runs
    as a sort-based aggregate over the already-counted pairs).
    """
    c = price_counts(df, weight)
    return (c.groupBy(*MODE_KEYS)
             .agg(_argmax("mrp").alias("_m"), _argmax("selling_price").alias("_s"))
             .select(*MODE_KEYS,
                     F.col("_m.v").alias("mrp_mode"), F.col("_m.f").alias("mrp_mode_freq"),
                     F.col("_s.v").alias("sp_mode"), F.col("_s.f").alias("sp_mode_freq")))
