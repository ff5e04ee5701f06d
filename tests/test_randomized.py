"""Seeded random snapshot tables: the Spark build against the oracle SQL."""

import datetime as dt
import random
from decimal import Decimal

import duckdb
import pandas as pd
import pytest

from shelfwise.plans.city_insights import build_city_insights
from shelfwise.plans.oracle import BUILD, build_selects
from shelfwise.plans.registry import comparable
from shelfwise.sources.schemas import CATEGORY_SCHEMA, SNAPSHOT_SCHEMA, STORE_CITY_SCHEMA

from .handmade import as_rows

UTC = dt.timezone.utc


def random_tables(seed):
    rnd = random.Random(seed)
    stores = [(s, rnd.choice(["Pune", "Agra", "Goa", None])) for s in range(1, 9)]
    cats = [(f"l1_{k % 2}", k % 2, f"l2_{k}", k) for k in (1, 2, 3)]
    rows, seen = [], set()
    for _ in range(400):
        store = rnd.randint(1, 10)            # 9 and 10 are unmapped
        sku = rnd.randint(1, 4)
        at = dt.datetime(2024, 6, 1, tzinfo=UTC) + dt.timedelta(minutes=rnd.randint(0, 4 * 24 * 60))
        if (at, sku, store) in seen:
            continue
        seen.add((at, sku, store))
        inv = None if rnd.random() < 0.05 else rnd.randint(0, 12)
        mrp = None if rnd.random() < 0.05 else Decimal(rnd.choice([50, 55, 60]))
        sp = None if rnd.random() < 0.05 else Decimal(rnd.choice([45, 50, 55, 58]))
        name = f"sku{sku}" + ("_new" if rnd.random() < 0.1 else "")
        l2 = rnd.choice([1, 2, 3, 4])         # 4 has no category row
        rows.append((at, l2 % 2, l2, store, sku, name, sp, mrp, inv, "img", sku % 2, f"b{sku % 2}", "u"))
    return rows, stores, cats


def duck(rows, stores, cats, select):
    con = duckdb.connect()
    names = [f.name for f in SNAPSHOT_SCHEMA.fields]
    snap = pd.DataFrame(rows, columns=names)
    snap["created_at"] = snap["created_at"].map(lambda t: t.replace(tzinfo=None))
    snap["inventory"] = snap["inventory"].astype("Int32")
    con.register("snap_pd", snap)
    con.execute("""CREATE TABLE snap AS SELECT CAST(created_at AS TIMESTAMP) AS created_at,
        l1_category_id, l2_category_id, store_id, sku_id, sku_name,
        CAST(selling_price AS DECIMAL(10,2)) AS selling_price, CAST(mrp AS DECIMAL(10,2)) AS mrp,
        inventory, image_url, brand_id, brand, unit FROM snap_pd""")
    con.register("city_pd", pd.DataFrame(stores, columns=["store_id", "city_name"]))
    con.execute("CREATE TABLE city AS SELECT * FROM city_pd")
    con.register("cat_pd", pd.DataFrame(cats, columns=[f.name for f in CATEGORY_SCHEMA.fields]))
    con.execute("CREATE TABLE cat AS SELECT * FROM cat_pd")
    return con.sql("WITH " + BUILD + "\n" + select).df()


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_tables_match_oracle(spark, seed):
    rows, stores, cats = random_tables(seed)
    snap = spark.createDataFrame(rows, SNAPSHOT_SCHEMA)
    city = spark.createDataFrame(stores, STORE_CITY_SCHEMA)
    cat = spark.createDataFrame(cats, CATEGORY_SCHEMA)
    want = duck(rows, stores, cats, build_selects()["city_insights"])
    cols = sorted(want.columns)
    for kw in ({}, {"max_rows_per_segment": 3}):
        got = comparable(build_city_insights(snap, city, cat, **kw)).toPandas()
        assert as_rows(got, cols) == as_rows(want, cols), kw


def random_swipes(seed):
    rnd = random.Random(seed)
    out = []
    base = dt.datetime(2025, 3, 1, 6, 0)
    for _ in range(300):
        emp = rnd.choice(["E1", "E2", "E3", "E4", None])
        action = rnd.choice(["In", "Out", "In", "Out", "Break"])
        if rnd.random() < 0.03:
            at = None
        else:
            at = base + dt.timedelta(seconds=rnd.randint(0, 3 * 86400), microseconds=rnd.choice([0, 7, 36, 99, 250000, 999999]))
        out.append((emp, action, at))
    return out


@pytest.mark.parametrize("seed", [11, 12])
def test_random_swipes_match_oracle(spark, seed):
    from shelfwise.operators import attendance
    from shelfwise.plans.oracle import ATTENDANCE, attendance_selects
    from shelfwise.sources.schemas import ATTENDANCE_SCHEMA

    rows = random_swipes(seed)
    log = spark.createDataFrame(rows, ATTENDANCE_SCHEMA)
    con = duckdb.connect()
    con.register("sw_pd", pd.DataFrame(rows, columns=["employee_id", "action", "created_at"]))
    con.execute("CREATE TABLE swipes AS SELECT employee_id, action, CAST(created_at AS TIMESTAMP) AS created_at FROM sw_pd")
    start, end = "2025-03-01 09:00:00", "2025-03-03 17:00:00"
    sel = attendance_selects(start, end)
    for kw in ({}, {"max_rows_per_segment": 4}):
        for name, got in (("hours_worked", attendance.hours_worked(log, **kw)),
                          ("hours_in_window", attendance.hours_in_window(log, start, end, **kw))):
            want = con.sql("WITH " + ATTENDANCE + sel[name]).df()
            cols = sorted(want.columns)
            assert as_rows(comparable(got).toPandas(), cols) == as_rows(want, cols), (name, kw)


@pytest.mark.parametrize("seed", [4])
def test_fanned_out_build_agrees(spark, seed):
    from scripts.fanned_out_build import fanned_out_insights
    rows, stores, cats = random_tables(seed)
    snap = spark.createDataFrame(rows, SNAPSHOT_SCHEMA)
    city = spark.createDataFrame(stores, STORE_CITY_SCHEMA)
    cat = spark.createDataFrame(cats, CATEGORY_SCHEMA)
    a = comparable(fanned_out_insights(snap, city, cat)).toPandas()
    b = comparable(build_city_insights(snap, city, cat)).toPandas()
    cols = sorted(b.columns)
    assert as_rows(a, cols) == as_rows(b, cols)
