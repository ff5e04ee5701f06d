"""The insights build on hand-made rows against the reference-form SQL (naive fan-out join)."""

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import analyses, insights, movement, pricing
from shelfwise.plans.city_insights import build_city_insights, build_daily
from shelfwise.plans.oracle import build_selects
from shelfwise.plans.registry import comparable
from shelfwise.sources.schemas import INSIGHTS_COLUMNS

from .handmade import as_rows, duck_build, frames

SELECTS = build_selects()
BUILD_QUERIES = ["inventory_movement", "direct_sales", "avg_historical_sales", "estimated_qty",
                 "stock_status", "price_modes", "city_level_agg", "total_stores_per_city",
                 "city_insights", "top_skus", "skus_by_city", "stockout_skus", "brand_revenue",
                 "city_revenue", "category_revenue", "discount_bands"]


def spark_query(name, snap, city, cat, **kw):
    if name in ("inventory_movement", "direct_sales", "avg_historical_sales", "estimated_qty",
                "price_modes"):
        moves = movement.inventory_movement(snap, city, **kw)
        sales = movement.direct_sales(moves)
        if name == "inventory_movement":
            return moves.select("event_time", "event_date", "store_id", "sku_id", "category_id",
                                "sub_category_id", "sku_name", "brand_id", "brand", "image_url",
                                "mrp", "selling_price", "city_name", "inventory", "next_inventory",
                                "next_event_time")
        if name == "direct_sales":
            return sales.select("store_id", "sku_id", "event_time", "inventory", "next_inventory",
                                "direct_qty_sold")
        if name == "avg_historical_sales":
            return movement.avg_historical_sales(sales)
        if name == "estimated_qty":
            return movement.estimated_sales(snap, city, **kw).select("store_id", "sku_id", "event_time",
                                                                     "est_qty_sold_per_record")
        return pricing.price_modes(sales)
    if name == "stock_status":
        return movement.stock_status(snap, city)
    if name == "city_level_agg":
        daily = build_daily(snap, city, **kw)
        return insights.city_level_agg(daily, pricing.price_modes(daily, weight="rows"))
    if name == "total_stores_per_city":
        mapped = movement.attach_city(snap, city).withColumn("event_date", F.to_date("created_at"))
        return insights.total_stores_per_city(mapped)
    ins = build_city_insights(snap, city, cat, **kw)
    if name == "city_insights":
        return ins
    return getattr(analyses, name)(ins)


@pytest.mark.parametrize("name", BUILD_QUERIES)
def test_handmade_matches_reference_form(spark, name):
    snap, city, cat = frames(spark)
    got = comparable(spark_query(name, snap, city, cat)).toPandas()
    want = duck_build(SELECTS[name])
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    assert as_rows(got, cols) == as_rows(want, cols)


@pytest.mark.parametrize("name", ["inventory_movement", "estimated_qty", "city_level_agg", "city_insights"])
def test_hot_groups_split_give_same_result(spark, name):
    """Cutting every (store, sku, day) above 2 rows into time slices changes nothing."""
    snap, city, cat = frames(spark)
    base = comparable(spark_query(name, snap, city, cat)).toPandas()
    split = comparable(spark_query(name, snap, city, cat, max_rows_per_segment=2)).toPandas()
    cols = sorted(base.columns)
    assert as_rows(base, cols) == as_rows(split, cols)


def test_insights_columns_and_invariants(spark):
    snap, city, cat = frames(spark)
    ins = build_city_insights(snap, city, cat)
    assert ins.columns == INSIGHTS_COLUMNS
    rows = ins.collect()
    assert rows
    for r in rows:
        assert r.est_qty_sold >= 1
        assert r.in_stock_store_count <= r.listed_ds_count
        if r.city_name is not None:
            assert r.listed_ds_count <= r.ds_count
        assert 0 <= r.wt_osa <= r.wt_osa_ls <= 1


def test_null_city_rows(spark):
    """NULL city: counted once (no fan-out), no modal prices, no store total."""
    snap, city, cat = frames(spark)
    r = [x for x in build_city_insights(snap, city, cat).collect() if x.city_name is None]
    assert len(r) == 1
    r = r[0]
    # drops 3 and 1 on day 1; no fan-out although the store has 3 snapshots that day
    assert int(r.est_qty_sold) == 4
    assert r.mrp is None and r.sp is None and r.est_sales_sp is None
    assert r.ds_count is None and float(r.wt_osa) == 0 and float(r.discount) == 0
    assert r.in_stock_store_count == 0


def test_fan_out_and_dedupe(spark):
    """Store 1, day 1: 4 snapshots, so each estimate counts 4 times unless dedupe."""
    snap, city, cat = frames(spark)
    daily = build_daily(snap, city)
    modes = pricing.price_modes(daily, weight="rows")

    def units(dedupe):
        agg = insights.city_level_agg(daily, modes, dedupe=dedupe)
        row = agg.filter((F.col("city_name") == "A") & (F.col("sku_name") == "milk")
                         & (F.col("event_date") == "2024-03-01")).collect()[0]
        return row.est_qty_sold
    # store 1 day 1: drop 3, equal, rise (mean of drops 3, 3, 9 = 5), drop 3
    # across midnight = 11, counted 4 times; store 2: rises with no history = 0
    assert units(False) == 4 * 11
    assert units(True) == 11


def test_mode_ties_prefer_higher_price(spark):
    snap, city, cat = frames(spark)
    m = pricing.price_modes(movement.direct_sales(movement.inventory_movement(snap, city)))
    r = m.filter((F.col("sku_id") == 200) & (F.col("city_name") == "B")).collect()
    # store 4: (20,20) (20,18) (22,18) (22,18) ; store 6: (10,12) x2
    assert len(r) == 1
    assert float(r[0].mrp_mode) == 22.0 and r[0].mrp_mode_freq == 2
    assert float(r[0].sp_mode) == 18.0 and r[0].sp_mode_freq == 2


def test_null_price_ranks_highest(spark):
    """A NULL mrp wins a frequency tie, as PostgreSQL sorts NULL first under DESC."""
    rows = [("2024-03-01", 1, "A", None, 5), ("2024-03-01", 1, "A", 9, 5)]
    df = spark.createDataFrame(rows, "event_date string, sku_id long, city_name string, "
                                     "mrp int, selling_price int")
    r = pricing.price_modes(df).collect()[0]
    assert r.mrp_mode is None and r.sp_mode == 5


def test_movement_columns_do_not_depend_on_splitting(spark):
    snap, city, _ = frames(spark)
    plain = movement.inventory_movement(snap, city)
    split = movement.inventory_movement(snap, city, max_rows_per_segment=2)
    assert plain.columns == split.columns == movement.MOVEMENT_COLUMNS
    assert plain.schema == split.schema


@pytest.mark.parametrize("split", [None, 2])
def test_large_drop_and_large_means(spark, split):
    """Stock of a 32-bit integer's size: exact, no overflow, as in DuckDB."""
    snap, city, cat = frames(spark)
    top = 2_000_000_003
    big = snap.withColumn("inventory", F.when(F.col("store_id") == 1, F.lit(top) - F.col("inventory") * 5_000_000)
                          .otherwise(F.col("inventory") * 7_654_321).cast("int"))
    rows = [tuple(r) for r in big.collect()]
    for name in ("estimated_qty", "city_level_agg", "city_insights"):
        got = comparable(spark_query(name, big, city, cat, max_rows_per_segment=split)).toPandas()
        want = duck_build(SELECTS[name], rows)
        cols = sorted(want.columns)
        assert as_rows(got, cols) == as_rows(want, cols), name


def pg_mean_of(total, count):
    """avg of integers as PostgreSQL rounds it: the quotient of two numerics of base-10000 digits."""
    from decimal import Decimal, localcontext

    def first(x):
        digits = []
        while x:
            x, d = divmod(x, 10_000)
            digits.append(d)
        return len(digits) - 1, digits[-1]

    (w1, d1), (w2, d2) = first(total), first(count)
    places = max(16 - 4 * (w1 - w2 - (d1 <= d2)), 0)
    with localcontext() as ctx:
        ctx.prec = 80
        return (Decimal(total) / count).quantize(Decimal(1).scaleb(-places), rounding="ROUND_HALF_UP"), places


def test_units_contribution_is_exact(spark):
    from decimal import Decimal, localcontext

    from shelfwise.functions.numeric import carried, pg_mean, units_contribution
    cases = [(7, 10**15, 3, 15_000, 10_001), (10**5, 3, 10**6, 2**31 - 1, 1), (1, 0, 5, 0, 0), (3, 2, 0, 7, 6),
             (999_999, 10**9 + 7, 123_457, 2**31 - 2, 3), (10**6, 0, 10**10, 10**9 + 7, 10**9)]
    df = spark.createDataFrame(cases, "n long, d long, r long, s long, c long")
    both = units_contribution(F.col("n"), F.col("d"), F.col("r"), pg_mean(F.col("s"), F.col("c")))
    got = df.select("n", "d", "r", "s", "c", *[x.alias(n) for n, x in zip(("w", "f"), both)],
                    *[x.alias(n) for n, x in zip(("cw", "cf"), carried(*both))]).collect()
    with localcontext() as ctx:
        ctx.prec = 60
        for r in got:
            want = r.n * (r.d + r.r * (pg_mean_of(r.s, r.c)[0] if r.c else Decimal(0)))
            assert r.w + r.f == want == r.cw + r.cf and 0 <= r.cf < 1


def test_means_have_the_places_of_postgres(spark):
    """20, 16, 12, 8 places; ties at the last one go up; the whole range of 32-bit means."""
    import random

    from shelfwise.functions.numeric import mean_places, pg_mean
    rng = random.Random(4)
    cases = [(1, 1), (5, 5), (3, 2), (7, 3), (10_000, 1), (10_000, 3), (20_000, 3), (9999, 10_000 - 1), (2**31 - 1, 1),
             (2**31 - 1, 7), (10**8 + 1, 3), (19_999, 10_000), (20_001, 10_000), (10_001, 10_000), (2**62, 2**61 + 1),
             (2**32 + 1, 2**32), (3 * 10**12 + 1, 2**21)]
    cases += [(c * rng.randint(1, 10**rng.randint(0, 8)) + rng.randint(0, c), c)
              for c in (rng.randint(1, 10**rng.randint(1, 9)) for _ in range(400))]
    cases += [(c + 2 * i + 1, c) for c in (2**17, 2**21, 2**25) for i in range(40)]      # finite: ties at 16 places
    df = spark.createDataFrame(cases + [(0, 0), (None, None)], "s long, c long")
    rows = df.select("s", "c", pg_mean(F.col("s"), F.col("c")).alias("m"),
                     F.when(F.col("c") > 0, mean_places(F.col("s"), F.col("c"))).alias("p")).collect()
    seen = set()
    for r in rows:
        if not r.c:
            assert r.m is None
            continue
        want, places = pg_mean_of(r.s, r.c)
        assert (r.m, r.p) == (want, places), r
        seen.add(places)
    assert seen >= {20, 16, 12, 8}


def test_a_tie_rounds_at_the_mean_s_places(spark):
    """Means whose 12th, 16th or 20th place decides the cents of the sales."""
    from decimal import Decimal

    from shelfwise.functions.numeric import carried, money, pg_mean, units_contribution
    # mean * rises * price lands on half a cent only with the right number of places
    cases = [(s, c, r, p) for s, c in ((10**4 + 1, 3 * 10**3), (10_001, 3), (200_000, 3), (5, 3), (2, 3000), (30_001, 30_000))
             for r in (3, 6, 3000, 15_000) for p in ("0.50", "0.05", "1.50", "99999999.99") if s >= c]
    df = spark.createDataFrame([(*x[:3], Decimal(x[3])) for x in cases], "s long, c long, r long, p decimal(10,2)")
    whole, frac = carried(*units_contribution(F.lit(1).cast("long"), F.lit(0).cast("long"), F.col("r"),
                                              pg_mean(F.col("s"), F.col("c"))))
    other = 0
    for r in df.select("*", money(whole, frac, F.col("p")).alias("m")).collect():
        units = r.r * pg_mean_of(r.s, r.c)[0]
        assert r.m == (units * r.p).quantize(Decimal("0.01"), rounding="ROUND_HALF_UP"), r
        at16 = r.r * (Decimal(r.s) / r.c).quantize(Decimal(1).scaleb(-16), rounding="ROUND_HALF_UP")
        other += r.m != (at16 * r.p).quantize(Decimal("0.01"), rounding="ROUND_HALF_UP")
    assert other                                              # 16 places everywhere would differ


def test_dimensions_too_big_to_broadcast_give_same_result(spark):
    """broadcast_rows=1: the store map and categories fail the size check and
    are joined by shuffle; the table is unchanged."""
    snap, city, cat = frames(spark)
    df = build_city_insights(snap, city, cat, broadcast_rows=1)
    want = duck_build(SELECTS["city_insights"])
    cols = sorted(want.columns)
    assert as_rows(comparable(df).toPandas(), cols) == as_rows(want, cols)
