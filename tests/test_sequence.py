"""Segmented LEAD / ROW_NUMBER equal the plain single-window forms."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfwise.functions.ordering import pg_asc
from shelfwise.operators.sequence import (CUTS, SEGMENT, boundaries, lead_in_sequence, number_in_sequence,
                                          split_sequences)


def skewed(spark):
    # key 0 holds most rows and bursts into one hour; keys 1-3 are small.
    n = 3000
    df = spark.range(n).select(
        F.when(F.col("id") % 10 < 7, 0).otherwise(F.col("id") % 4).cast("long").alias("k"),
        (F.lit("2024-05-01 00:00:00").cast("timestamp")
         + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                              (F.col("id") * 7 % 3600).cast("decimal(10,0)") + F.col("id") / 10000)
         + F.make_dt_interval(F.col("id") % 3)).alias("ts"),
        (F.col("id") * 37 % 101).cast("int").alias("v"))
    return df.withColumn("day", F.to_date("ts"))


@pytest.mark.parametrize("broadcast_rows", [0, 1_000_000])
@pytest.mark.parametrize("max_rows", [None, 300])
def test_lead_matches_plain_window(spark, max_rows, broadcast_rows):
    df = skewed(spark)
    seg = split_sequences(df, ["k"], "ts", ["v"], max_rows, broadcast_rows)
    if max_rows:
        # only the hot key 0 is split
        assert {r.k for r in seg.rows.filter(F.col(CUTS).isNotNull()).select("k").distinct().collect()} == {0}
        assert seg.rows.filter("k = 0").select(SEGMENT).distinct().count() >= 6
    else:
        assert seg is None
    got = lead_in_sequence(df, ["k"], "ts", ["v"], seg).select("k", "ts", "next_ts", "next_v")
    w = Window.partitionBy("k").orderBy("ts")
    want = df.select("k", "ts", F.lead("ts").over(w).alias("next_ts"), F.lead("v").over(w).alias("next_v"))
    assert sorted(got.collect()) == sorted(want.collect())


@pytest.mark.parametrize("max_rows", [1, 2, 3, 7, 64, 65, 1000])
def test_any_threshold_gives_the_same(spark, max_rows):
    """Every row a segment of its own, segments of odd sizes, sampled and unsampled boundaries; NULL values."""
    df = skewed(spark).filter("v % 5 = 0").withColumn("v", F.when(F.col("v") % 4 != 0, F.col("v")))
    seg = split_sequences(df, ["k"], "ts", ["v"], max_rows)
    got = lead_in_sequence(df, ["k"], "ts", ["v"], seg).select("k", "ts", "next_ts", "next_v")
    w = Window.partitionBy("k").orderBy("ts")
    want = df.select("k", "ts", F.lead("ts").over(w).alias("next_ts"), F.lead("v").over(w).alias("next_v"))
    assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr)
    numbered = number_in_sequence(df, ["k"], "ts", seg).select("k", "ts", "rn")
    assert sorted(numbered.collect()) == sorted(
        df.select("k", "ts", F.row_number().over(w).alias("rn")).collect())


@pytest.mark.parametrize("max_rows", [None, 300])
def test_row_number_matches_plain_window(spark, max_rows):
    df = skewed(spark)
    seg = split_sequences(df, ["k"], "ts", (), max_rows)
    got = number_in_sequence(df, ["k"], "ts", seg).select("k", "ts", "rn")
    want = df.select("k", "ts", F.row_number().over(Window.partitionBy("k").orderBy(pg_asc("ts"))).alias("rn"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_equal_times_stay_together(spark):
    """A sequence of few times, most rows at one of them: numbers are gapless and agree with the times."""
    df = spark.range(2000).select(F.lit(1).alias("k"), F.timestamp_seconds(
        F.when(F.col("id") % 10 < 7, 500).otherwise(F.col("id"))).alias("ts"))
    seg = split_sequences(df, ["k"], "ts", (), 50)
    rows = number_in_sequence(df, ["k"], "ts", seg).select("ts", "rn").collect()
    rows.sort(key=lambda r: r.rn)
    assert [r.rn for r in rows] == list(range(1, 2001)) and [r.ts for r in rows] == sorted(r.ts for r in rows)


@pytest.mark.parametrize("zone", ["America/New_York", "UTC", "Australia/Lord_Howe"])
@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
@pytest.mark.parametrize("day", ["2024-03-10", "2024-11-03", "2024-04-07", "2024-10-06"])
def test_split_numbers_across_daylight_saving(spark, zone, kind, day):
    """The order of segments is the order of rows, also where local times jump."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.range(900).select(
            F.lit(1).alias("k"),
            (F.lit(f"{day} 00:00:00").cast(kind) + F.make_dt_interval(
                F.lit(0), F.lit(0), F.lit(0), (F.col("id") * 7919 % 30_000 + F.col("id") / 1000)
                .cast("decimal(18,6)"))).alias("ts"))
        seg = split_sequences(df, ["k"], "ts", (), 50)
        assert seg.rows.agg(F.max(SEGMENT)).first()[0] > 10
        got = number_in_sequence(df, ["k"], "ts", seg).select("ts", "rn").collect()
        assert [r.rn for r in sorted(got, key=lambda r: r.rn)] == list(range(1, 901))
        want = df.select("ts", F.row_number().over(Window.partitionBy("k").orderBy("ts")).alias("rn")).collect()
        assert sorted(map(tuple, got), key=lambda r: r[1]) == sorted(map(tuple, want), key=lambda r: r[1])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_bursty_hot_key_is_packed_evenly(spark):
    """90% of a key's rows inside one minute: segments stay near the threshold."""
    n, limit = 4000, 400
    df = spark.range(n).select(
        F.lit(7).cast("long").alias("k"),
        (F.lit("2024-05-01 00:00:00").cast("timestamp") + F.make_dt_interval(
            F.lit(0), F.lit(0), F.lit(0),
            F.when(F.col("id") % 10 < 9, (F.col("id") * 7919 % 60_000_000))
             .otherwise(F.col("id") * 7919 % 86_000_000_000).cast("decimal(18,0)") / 1_000_000)).alias("ts"),
        F.lit(1).alias("v"))
    seg = split_sequences(df, ["k"], "ts", ["v"], limit)
    sizes = [r["count"] for r in seg.rows.groupBy(SEGMENT).count().collect()]
    # boundaries are sampled: about the limit, whatever happens inside a second
    assert len(sizes) >= n // limit - 2
    assert max(sizes) <= 1.6 * limit
    got = lead_in_sequence(df, ["k"], "ts", ["v"], seg).select("k", "ts", "next_ts")
    want = df.select("k", "ts", F.lead("ts").over(Window.partitionBy("k").orderBy("ts")).alias("next_ts"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_short_sequences_are_left_alone(spark):
    df = skewed(spark)
    for kw in ({"max_rows": 100_000}, {"max_rows": None}, {"max_rows": 10, "row_bound": 10}):
        assert split_sequences(df, ["k"], "ts", ["v"], **kw) is None
    assert boundaries(df, ["k"], "ts", ["v"], 5000).isEmpty()
