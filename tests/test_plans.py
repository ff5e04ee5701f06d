"""Physical-plan properties the scale design relies on."""

import contextlib
import io
import re

import pytest

from shelfwise.operators import analyses, attendance, movement, pricing, quality
from shelfwise.operators.insights import daily_grain
from shelfwise.plans.city_insights import build_city_insights, build_daily, insights_of
from shelfwise.sources import schemas

from .handmade import frames
from .test_attendance import _log, sample_rows


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def exchanges(text: str) -> list[str]:
    return re.findall(r"Arguments: (hashpartitioning\([^)]*\)|SinglePartition|rangepartitioning\([^)]*\))", text)


def _strip(parts):
    return sorted(re.sub(r"#\d+L?", "", x) for x in parts)


PAIR = "hashpartitioning(store_id, sku_id, 4)"


def test_lead_path_is_one_exchange_and_daily_adds_none(spark):
    """No hot key: one shuffle of the rows on (store, sku), as a plain window; means, fan-out sizes and
    stock flags of the daily grain reuse it."""
    snap, city, _ = frames(spark)
    moves = movement.inventory_movement(snap, city)
    m, p = exchanges(plan(moves)), plan(daily_grain(movement.direct_sales(moves)))
    assert _strip(m) == _strip(exchanges(p)) == [PAIR], (m, p)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_estimated_qty_is_one_exchange_and_one_scan(spark, scratch):
    snap, city, _ = frames(spark)
    snap.write.parquet(f"{scratch}/snap")
    p = plan(movement.estimated_sales(spark.read.parquet(f"{scratch}/snap"), city))
    assert _strip(exchanges(p)) == [PAIR]
    assert len(re.findall(r"^\(\d+\) Scan parquet", p, re.M)) == 1


def test_split_lead_path_is_one_exchange_of_the_rows(spark):
    """Long sequences: rows shuffle once on (store, sku, segment); their boundaries are broadcast, with the
    values the segment before needs.  The daily grain shuffles what it has aggregated once more."""
    snap, city, _ = frames(spark)
    moves, seg = movement.split_movement(snap, city, max_rows_per_segment=2)
    p = plan(moves)
    split = "hashpartitioning(store_id, sku_id, __segment, 4)"
    assert _strip(exchanges(p)) == [split], p
    # the store map and the boundaries
    assert "InMemoryTableScan" not in p and re.findall(r"^\(\d+\) (\w*Join)", p, re.M) == ["BroadcastHashJoin"] * 2, p
    p = plan(daily_grain(movement.direct_sales(moves), seg))
    assert _strip(exchanges(p)) == sorted([split, PAIR]) and "SortMergeJoin" not in p, p


def test_written_grain_is_not_shuffled_by_pair_again(spark):
    """After the written daily grain no exchange is on (store, sku); the roll-up takes one."""
    snap, city, cat = frames(spark)
    for split in (None, 2):
        p = plan(insights_of(build_daily(snap, city, max_rows_per_segment=split), cat))
        parts = _strip(exchanges(p))
        assert not [x for x in parts if x.startswith("hashpartitioning(store_id, sku_id")], parts
        assert parts.count("hashpartitioning(event_date, sku_id, city_name, 4)") >= 1
        assert "Window" not in p and "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


@pytest.mark.parametrize("query", ["hours_worked", "hours_in_window"])
def test_attendance_is_one_scan_and_one_exchange(spark, scratch, query):
    _log(spark, sample_rows()).write.parquet(f"{scratch}/log")
    log = spark.read.parquet(f"{scratch}/log")
    window = () if query == "hours_worked" else ("2025-11-11 09:00:00", "2025-11-11 17:00:00")
    p = plan(getattr(attendance, query)(log, *window))
    parts = _strip(exchanges(p))
    assert [x for x in parts if not x.startswith("rangepartitioning")] == ["hashpartitioning(employee_id, 4)"], parts
    assert len(re.findall(r"^\(\d+\) Scan parquet", p, re.M)) == 1
    assert "Join" not in p


def test_key_violations_is_one_scan(spark, scratch):
    snap, _, _ = frames(spark)
    snap.write.parquet(f"{scratch}/snap")
    p = plan(quality.key_violations(spark.read.parquet(f"{scratch}/snap"), "s", schemas.SNAPSHOT_KEY,
                                    schemas.SNAPSHOT_NOT_NULL))
    assert len(re.findall(r"^\(\d+\) Scan parquet", p, re.M)) == 1


def test_no_nested_loop_or_cartesian_anywhere(spark):
    snap, city, cat = frames(spark)
    ins = build_city_insights(snap, city, cat)
    for df in (ins, analyses.top_skus(ins), attendance.hours_in_window(
            _log(spark, sample_rows()), "2025-11-11 09:00:00", "2025-11-11 17:00:00")):
        p = plan(df)
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_price_modes_need_no_window(spark):
    snap, _, _ = frames(spark)
    rows = snap.selectExpr("to_date(created_at) AS event_date", "sku_id", "brand AS city_name",
                           "mrp", "selling_price")
    p = plan(pricing.price_modes(rows))
    assert "Window" not in p
    assert p.count("HashAggregate") >= 2      # partial + final counts of price pairs


def test_reports_are_top_k(spark):
    snap, city, cat = frames(spark)
    ins = build_city_insights(snap, city, cat)
    for fn in (analyses.top_skus, analyses.skus_by_city, analyses.stockout_skus,
               analyses.brand_revenue, analyses.city_revenue):
        assert "TakeOrderedAndProject" in plan(fn(ins))


def test_scans_are_pruned(spark, scratch):
    snap, city, cat = frames(spark)
    path = f"{scratch}/snap"
    snap.write.parquet(path)
    s = spark.read.parquet(path)
    p = plan(pricing.price_modes(movement.attach_city(s, city)
                                 .selectExpr("to_date(created_at) AS event_date", "sku_id",
                                             "city_name", "mrp", "selling_price")))
    schema = re.findall(r"ReadSchema: (struct<[^>]*>)", p)[0]
    assert "image_url" not in schema and "inventory" not in schema and "brand" not in schema
