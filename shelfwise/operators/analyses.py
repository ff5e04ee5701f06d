"""Reports on the insights table.

Every ORDER BY follows PostgreSQL's NULL order and ends with the group keys as
tie-breaks, so the rows a LIMIT keeps are deterministic.  ``orderBy().limit(n)``
plans as a top-k (TakeOrderedAndProject), not a full sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import avg_round, div_round
from ..functions.ordering import pg_asc, pg_desc


def top_skus(ins: DataFrame, n: int = 50) -> DataFrame:
    """Units sold by (SKU name, brand), the n largest."""
    g = ins.groupBy("sku_name", "brand").agg(F.sum("est_qty_sold").alias("total_sold"))
    return g.orderBy(pg_desc("total_sold"), pg_asc("sku_name"), pg_asc("brand")).limit(n)


def skus_by_city(ins: DataFrame, n: int = 50) -> DataFrame:
    """Units sold by (city, SKU name); the first n rows in (city, units desc) order.

    As in the reference this is a global LIMIT, not n per city.
    """
    g = ins.groupBy("city_name", "sku_name").agg(F.sum("est_qty_sold").alias("total_sold"))
    return g.orderBy(pg_asc("city_name"), pg_desc("total_sold"), pg_asc("sku_name")).limit(n)


def stockout_skus(ins: DataFrame, n: int = 50) -> DataFrame:
    """Mean share of listing stores out of stock, by (SKU name, city), where units > 0."""
    g = (ins.groupBy("sku_name", "city_name")
            .agg(avg_round(F.lit(1) - F.col("wt_osa_ls")).alias("avg_out_of_stock_ratio"),
                 F.sum("est_qty_sold").alias("total_sold"))
            .filter(F.col("total_sold") > 0))
    return g.orderBy(pg_desc("avg_out_of_stock_ratio"), pg_asc("sku_name"),
                     pg_asc("city_name")).limit(n)


def brand_revenue(ins: DataFrame, n: int = 10) -> DataFrame:
    """Sales at selling price by brand, the n largest."""
    g = ins.groupBy("brand").agg(F.sum("est_sales_sp").alias("total_revenue"))
    return g.orderBy(pg_desc("total_revenue"), pg_asc("brand")).limit(n)


def city_revenue(ins: DataFrame, n: int = 10) -> DataFrame:
    """Sales, units and sales per unit by city, the n largest by sales."""
    g = ins.groupBy("city_name").agg(F.sum("est_sales_sp").alias("total_sales"),
                                     F.sum("est_qty_sold").alias("total_units"))
    g = g.withColumn("avg_unit_price", div_round(F.col("total_sales"), F.col("total_units"), 2))
    return g.orderBy(pg_desc("total_sales"), pg_asc("city_name")).limit(n)


def category_revenue(ins: DataFrame) -> DataFrame:
    """Sales by (category, sub-category), largest first."""
    g = ins.groupBy("category_name", "sub_category_name").agg(
        F.sum("est_sales_sp").alias("total_sales"))
    return g.orderBy(pg_desc("total_sales"), pg_asc("category_name"), pg_asc("sub_category_name"))


def discount_bands(ins: DataFrame) -> DataFrame:
    """Mean units sold per discount rounded to 2 places."""
    g = ins.groupBy(F.round("discount", 2).alias("discount_band")).agg(
        avg_round(F.col("est_qty_sold")).alias("avg_qty_sold"))
    return g.orderBy(pg_asc("discount_band"))
