"""Declared schemas of the input tables and of the derived insights table."""

from __future__ import annotations

from pyspark.sql import types as T

# inventory_snapshots: time-stamped stock snapshots.
# Key (created_at, sku_id, store_id); created_at, store_id, sku_id NOT NULL.
SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("created_at", T.TimestampType(), False),
    T.StructField("l1_category_id", T.LongType(), True),
    T.StructField("l2_category_id", T.LongType(), True),
    T.StructField("store_id", T.LongType(), False),
    T.StructField("sku_id", T.LongType(), False),
    T.StructField("sku_name", T.StringType(), True),
    T.StructField("selling_price", T.DecimalType(10, 2), True),
    T.StructField("mrp", T.DecimalType(10, 2), True),
    T.StructField("inventory", T.IntegerType(), True),
    T.StructField("image_url", T.StringType(), True),
    T.StructField("brand_id", T.LongType(), True),
    T.StructField("brand", T.StringType(), True),
    T.StructField("unit", T.StringType(), True),
])
SNAPSHOT_KEY = ["created_at", "sku_id", "store_id"]
SNAPSHOT_NOT_NULL = ["created_at", "store_id", "sku_id"]

# category_dim: L2 category -> L1 and names.  Key l2_category_id.
CATEGORY_SCHEMA = T.StructType([
    T.StructField("l1_category", T.StringType(), True),
    T.StructField("l1_category_id", T.LongType(), True),
    T.StructField("l2_category", T.StringType(), True),
    T.StructField("l2_category_id", T.LongType(), False),
])
CATEGORY_KEY = ["l2_category_id"]

# store_city: store -> city.  Key store_id; city_name may be NULL.
STORE_CITY_SCHEMA = T.StructType([
    T.StructField("store_id", T.LongType(), False),
    T.StructField("city_name", T.StringType(), True),
])
STORE_CITY_KEY = ["store_id"]

# attendance_log: In/Out swipes, no key.
ATTENDANCE_SCHEMA = T.StructType([
    T.StructField("employee_id", T.StringType(), True),
    T.StructField("action", T.StringType(), True),
    T.StructField("created_at", T.TimestampNTZType(), True),
])

# Column order of the derived city_insights table.
INSIGHTS_COLUMNS = [
    "date", "brand_id", "brand", "image_url", "city_name", "sku_id", "sku_name",
    "category_id", "category_name", "sub_category_id", "sub_category_name",
    "est_qty_sold", "est_sales_sp", "est_sales_mrp", "listed_ds_count", "ds_count",
    "in_stock_store_count", "wt_osa", "wt_osa_ls", "mrp", "sp", "discount",
]
