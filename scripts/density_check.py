"""Dense snapshots: the build vs the fanned-out one as snapshots per store-day grow.

usage: python scripts/density_check.py [sf_dir] [repeats]

Derives a denser snapshot table from the lineitem-based bulk feed: each
snapshot is repeated ``repeats`` times at 5-minute steps with changing stock
(so every store-day has ``repeats`` times more snapshots, as real scrapes
do).  Times both builds (Parquet output, median of 2 after a warm-up) and
checks they produce the same table.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from scripts.fanned_out_build import fanned_out_insights  # noqa: E402
from shelfwise.plans.city_insights import build_city_insights  # noqa: E402
from shelfwise.session import build_session, checkpoint_dir  # noqa: E402
from shelfwise.sources import feeds  # noqa: E402


def dense(spark, sf_dir: str, repeats: int):
    base = feeds.bulk_snapshot_feed(spark, sf_dir)
    k = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("k")
    rows = base.select("*", k)
    return rows.select(
        *[(F.col("created_at") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("k") * 5)).alias("created_at")
          if c == "created_at" else
          ((F.col("inventory") + F.col("k") * 7) % 50).cast("int").alias("inventory")
          if c == "inventory" else F.col(c)
          for c in base.columns])


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    repeats = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    spark = build_session("local[8]", shuffle_partitions=16,
                          extra={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    d = tempfile.mkdtemp(prefix="density-", dir="/tmp")
    checkpoint_dir(spark, d)
    dense(spark, sf, repeats).write.parquet(f"{d}/snap")
    snap = spark.read.parquet(f"{d}/snap")
    city, cats = feeds.bulk_store_city_feed(spark, sf), feeds.bulk_category_feed(spark, sf)
    out = {"snapshots": snap.count(), "repeats": repeats}

    def timed(label, build):
        times = []
        for i in range(3):
            t0 = time.perf_counter()
            build().write.mode("overwrite").parquet(f"{d}/{label}")
            if i:
                times.append(time.perf_counter() - t0)
        out[f"{label}_sec"] = round(statistics.median(times), 2)

    timed("rewritten", lambda: build_city_insights(snap, city, cats))
    timed("fanned_out", lambda: fanned_out_insights(snap, city, cats))
    a, b = spark.read.parquet(f"{d}/rewritten"), spark.read.parquet(f"{d}/fanned_out")
    a, b = a.select(sorted(a.columns)), b.select(sorted(b.columns))
    out["rows"] = a.count()
    out["identical"] = a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
