"""Stand-in feeds and the movement/pairing steps against the FIXTURES.md profile."""

import os

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import attendance, movement
from shelfwise.sources import feeds

# Profile of the stand-in feeds (FIXTURES.md section 3).
PROFILE = {
    "0.001": {"rows": 1000, "pairs": 75, "drops": 458, "rises": 455, "equal": 12, "zero": 14,
              "att_pairs": 171, "out_first": 81, "day_plus": 76},
    "0.01": {"rows": 10000, "pairs": 750, "drops": 4621, "rises": 4543, "equal": 86, "zero": 93,
             "att_pairs": 1692, "out_first": 802, "day_plus": 765},
}


@pytest.mark.parametrize("sf", sorted(PROFILE))
def test_feed_profile(spark, sf):
    d = f"/root/testdata/sf{sf}"
    if not os.path.isdir(d):
        pytest.skip("test tables not present")
    want = PROFILE[sf]
    snap, city = feeds.snapshot_feed(spark, d), feeds.store_city_feed(spark, d)
    assert snap.count() == want["rows"]
    assert snap.select("created_at", "sku_id", "store_id").distinct().count() == want["rows"]
    assert snap.select("store_id", "sku_id").distinct().count() == want["pairs"]
    assert snap.filter(F.col("inventory") == 0).count() == want["zero"]
    m = movement.inventory_movement(snap, city)
    inv, nxt = F.col("inventory"), F.col("next_inventory")
    got = m.agg(F.sum(F.when(nxt < inv, 1).otherwise(0)).alias("drops"),
                F.sum(F.when(nxt > inv, 1).otherwise(0)).alias("rises"),
                F.sum(F.when(nxt == inv, 1).otherwise(0)).alias("equal"),
                F.sum(F.when(nxt.isNull(), 1).otherwise(0)).alias("last")).first()
    assert (got.drops, got.rises, got.equal, got.last) == (want["drops"], want["rises"],
                                                           want["equal"], want["pairs"])
    p = attendance.pair_swipes(feeds.attendance_feed(spark, d))
    secs = F.unix_timestamp(F.col("swipe_out").cast("timestamp")) - \
        F.unix_timestamp(F.col("swipe_in").cast("timestamp"))
    a = p.agg(F.count(F.lit(1)).alias("n"),
              F.sum(F.when(F.col("swipe_out") < F.col("swipe_in"), 1).otherwise(0)).alias("out_first"),
              F.sum(F.when(secs >= 86400, 1).otherwise(0)).alias("day_plus")).first()
    assert (a.n, a.out_first, a.day_plus) == (want["att_pairs"], want["out_first"], want["day_plus"])
