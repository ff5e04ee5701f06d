"""
runner for the reference-form SQL on them."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import duckdb
import pandas as pd

from shelfwise.plans.oracle import BUILD
from shelfwise.sources.schemas import CATEGORY_SCHEMA, SNAPSHOT_SCHEMA, STORE_CITY_SCHEMA

UTC = dt.timezone.utc


def ts(day, hh, mm=0):
    return dt.datetime(2024, 3, day, hh, mm, tzinfo=UTC)


def D(x):
    return None if x is None else Decimal(str(x)).quantize(Decimal("0.01"))


# (created_at, store, sku, name, l1, l2, brand_id, brand, mrp, sp, inventory)
_ROWS = [
    # store 1 / sku 100, city A: drop, equal, rise late in the day (LEAD crosses
    # midnight), drops next day, NULL stock, NULL mrp, last row.
    (ts(1, 8), 1, 100, "milk", 1, 10, 7, "b7", 50, 45, 10),
    (ts(1, 12), 1, 100, "milk", 1, 10, 7, "b7", None, 45, 7),
    (ts(1, 18), 1, 100, "milk", 1, 10, 7, "b7", 50, 45, 7),
    (ts(1, 23), 1, 100, "milk", 1, 10, 7, "b7", 50, 40, 12),
    (ts(2, 1), 1, 100, "milk", 1, 10, 7, "b7", 50, 40, 9),
    (ts(2, 10), 1, 100, "milk", 1, 10, 7, "b7", 50, 40, 0),
    (ts(2, 15), 1, 100, "milk", 1, 10, 7, "b7", 50, 40, None),
    (ts(2, 20), 1, 100, "milk", 1, 10, 7, "b7", 50, 40, 5),
    # store 2 / sku 100, city A: only rises and no change (restock with no
    # history: mean 0), and a mid-day rename.
    (ts(1, 9), 2, 100, "milk", 1, 10, 7, "b7", 50, 40, 4),
    (ts(1, 10), 2, 100, "milk", 1, 10, 7, "b7", 50, 40, 6),
    (ts(1, 11), 2, 100, "milk 1L", 1, 10, 7, "b7", 50, 40, 8),
    (ts(2, 11), 2, 100, "milk", 1, 10, 7, "b7", 55, 40, 8),
    (ts(2, 12), 2, 100, "milk", 1, 10, 7, "b7", 55, 40, 9),
    # store 3, NULL city: no fan-out, no modes, no totals.
    (ts(1, 8), 3, 100, "milk", 1, 10, 7, "b7", None, 30, 5),
    (ts(1, 9), 3, 100, "milk", 1, 10, 7, "b7", 60, 30, 2),
    (ts(1, 10), 3, 100, "milk", 1, 10, 7, "b7", 60, 30, 1),
    # store 4 / sku 200, city B: three price pairs once each (mode ties).
    (ts(1, 7), 4, 200, "chips", 2, 20, 9, "b9", 20, 20, 3),
    (ts(1, 8), 4, 200, "chips", 2, 20, 9, "b9", 20, 18, 1),
    (ts(1, 9), 4, 200, "chips", 2, 20, 9, "b9", 22, 18, 1),
    (ts(1, 10), 4, 200, "chips", 2, 20, 9, "b9", 22, 18, 0),
    # store 6 / sku 200, city B, unknown sub-category 99; a discount above mrp.
    (ts(1, 7), 6, 200, "chips", 2, 99, 9, "b9", 10, 12, 9),
    (ts(1, 9), 6, 200, "chips", 2, 99, 9, "b9", 10, 12, 4),
    # store 5 is not in the store map: dropped by the inner join.
    (ts(1, 8), 5, 100, "milk", 1, 10, 7, "b7", 50, 45, 9),
    (ts(1, 9), 5, 100, "milk", 1, 10, 7, "b7", 50, 45, 1),
]

STORES = [(1, "A"), (2, "A"), (3, None), (4, "B"), (6, "B")]
CATEGORIES = [("Dairy", 1, "Milk", 10), ("Snacks", 2, "Chips", 20)]


def snapshot_rows():
    out = []
    for (at, store, sku, name, l1, l2, bid, brand, mrp, sp, inv) in _ROWS:
        out.append((at, l1, l2, store, sku, name, D(sp), D(mrp), inv, "img", bid, brand, "each"))
    return out


def frames(spark):
    snap = spark.createDataFrame(snapshot_rows(), SNAPSHOT_SCHEMA)
    city = spark.createDataFrame(STORES, STORE_CITY_SCHEMA)
    cat = spark.createDataFrame(CATEGORIES, CATEGORY_SCHEMA)
    return snap, city, cat


def duck_build(select_sql: str, rows=None) -> pd.DataFrame:
    """Run the oracle's build and ``select_sql`` on the hand-made tables (or other snapshot rows)."""
    con = duckdb.connect()
    names = [f.name for f in SNAPSHOT_SCHEMA.fields]
    snap = pd.DataFrame([tuple(r) for r in rows or snapshot_rows()], columns=names)
    snap["created_at"] = snap["created_at"].map(lambda t: t.replace(tzinfo=None))
    snap["inventory"] = snap["inventory"].astype("Int32")
    con.register("snap_pd", snap)
    con.execute("""CREATE TABLE snap AS SELECT CAST(created_at AS TIMESTAMP) AS created_at,
        l1_category_id, l2_category_id, store_id, sku_id, sku_name,
        CAST(selling_price AS DECIMAL(10,2)) AS selling_price, CAST(mrp AS DECIMAL(10,2)) AS mrp,
        inventory, image_url, brand_id, brand, unit FROM snap_pd""")
    con.register("city_pd", pd.DataFrame(STORES, columns=["store_id", "city_name"]))
    con.execute("CREATE TABLE city AS SELECT * FROM city_pd")
    con.register("cat_pd", pd.DataFrame(CATEGORIES, columns=[f.name for f in CATEGORY_SCHEMA.fields]))
    con.execute("CREATE TABLE cat AS SELECT * FROM cat_pd")
    return con.sql("WITH " + BUILD + "\n" + select_sql).df()


def as_rows(pdf: pd.DataFrame, cols: list[str]):
    def norm(v):
        if v is None or v is pd.NA or (isinstance(v, float) and v != v):
            return None
        if isinstance(v, float) and v.is_integer():
            return str(int(v))
        if hasattr(v, "item"):
            return norm(v.item())
        return str(v)
    return sorted((tuple(norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)),
                  key=lambda t: tuple("" if x is None else x for x in t))
