"""Skew check: one (store, sku) holding a third of all snapshots, all on one day.

usage: python scripts/skew_check.py [sf_dir] [max_rows_per_segment] [shuffle_partitions]

Builds a skewed snapshot table from ``lineitem`` (rows of every third order
go to store -1 / sku -1 on 1995-06-01, 90% of them inside one minute, at
distinct microseconds), then runs the
LEAD step with and without hot-key splitting and reports the rows held by
the largest task after the LEAD exchange, the wall time, and whether the two
results are identical.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from shelfwise.operators import movement  # noqa: E402
from shelfwise.session import build_session, checkpoint_dir  # noqa: E402
from shelfwise.sources import feeds  # noqa: E402
from shelfwise.sources.schemas import SNAPSHOT_SCHEMA  # noqa: E402


def skewed_snapshots(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    hot = F.col("l_orderkey") % 3 == 0
    # 90% of the hot rows burst into one minute, the rest spread over the day
    micros = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 7919     # prime stride: spread out
    burst = F.when(F.col("l_orderkey") % 10 < 9, micros % 60_000_000).otherwise(micros % 86_000_000_000)
    at = F.when(hot, F.lit("1995-06-01 00:00:00").cast("timestamp")
                + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                     burst.cast("decimal(18,0)") / 1_000_000)) \
          .otherwise(F.col("l_shipdate").cast("timestamp")
                     + F.make_dt_interval(F.lit(0), F.col("l_orderkey") % 24, F.col("l_linenumber")))
    rows = li.select(at.alias("created_at"),
                     F.when(hot, -1).otherwise(F.col("l_suppkey")).cast("long").alias("store_id"),
                     F.when(hot, -1).otherwise(F.col("l_partkey") % 50).cast("long").alias("sku_id"),
                     F.col("l_quantity").cast("int").alias("inventory"))
    rows = rows.groupBy("created_at", "store_id", "sku_id").agg(F.max("inventory").alias("inventory"))
    sku = F.col("sku_id")
    df = rows.select("created_at", (sku % 5).alias("l1_category_id"), sku.alias("l2_category_id"),
                     "store_id", "sku_id", F.concat(F.lit("sku_"), sku.cast("string")).alias("sku_name"),
                     F.lit(95).alias("selling_price"), F.lit(100).alias("mrp"), "inventory",
                     F.lit("img").alias("image_url"), (sku % 7).alias("brand_id"),
                     F.lit("b").alias("brand"), F.lit("u").alias("unit"))
    return df.select([F.col(f.name).cast(f.dataType) for f in SNAPSHOT_SCHEMA.fields])


def measure(spark, snap, city, limit: int) -> dict:
    """Largest LEAD task and wall time, unsplit vs split, and whether results agree."""
    out = {"rows": snap.count(),
           "hot_key_rows": snap.filter("store_id = -1 AND sku_id = -1").count(),
           "max_rows_per_segment": limit,
           "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions"))}
    results = {}
    for label, kw in (("plain", {"max_rows_per_segment": None}),
                      ("split", {"max_rows_per_segment": limit})):
        t0 = time.perf_counter()                             # sampling the boundaries counts too
        moves = movement.inventory_movement(snap, city, **kw)
        # use a LEAD output column, so the window (and its exchange) is not pruned away
        per_task = (moves.groupBy(F.spark_partition_id().alias("p"))
                         .agg(F.count(F.lit(1)).alias("n"), F.max("next_event_time").alias("_m"))
                         .agg(F.max("n"), F.max("_m")).first()[0])
        out[f"{label}_largest_task_rows"] = per_task
        out[f"{label}_sec"] = round(time.perf_counter() - t0, 2)
        results[label] = moves.select("store_id", "sku_id", "created_at", "next_inventory",
                                      "next_event_time")
    out["identical"] = results["plain"].exceptAll(results["split"]).count() == 0 and \
        results["split"].exceptAll(results["plain"]).count() == 0
    return out


def skewed_inputs(spark, sf_dir: str, folder: str):
    """Skewed snapshots written as Parquet under ``folder``, and their store map."""
    skewed_snapshots(spark, sf_dir).write.parquet(f"{folder}/skewed_snap")
    city = spark.createDataFrame([(-1, "HOT")], "store_id long, city_name string").unionByName(
        feeds.bulk_store_city_feed(spark, sf_dir))
    return spark.read.parquet(f"{folder}/skewed_snap"), city


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    limit = int(sys.argv[2]) if len(sys.argv) > 2 else 20_000
    parts = int(sys.argv[3]) if len(sys.argv) > 3 else 64
    spark = build_session("local[8]", shuffle_partitions=parts,
                          extra={"spark.ui.showConsoleProgress": "false",
                                 "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    d = tempfile.mkdtemp(prefix="skew-", dir="/tmp")
    checkpoint_dir(spark, d)
    snap, city = skewed_inputs(spark, sf, d)
    out = measure(spark, snap, city, limit)
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
