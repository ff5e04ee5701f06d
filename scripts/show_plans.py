"""Write PLANS.md: exchanges, joins, windows and scans of the headline queries.

usage: python scripts/show_plans.py [sf_dir]   (default /root/testdata/sf0.01)
Plans are the initial physical plans (before AQE's runtime changes) of the
lazy queries; the insights build is shown as the two plans that run: snapshots
to the written daily grain, and daily grain to the insights table.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfwise.operators import analyses, attendance, insights, movement  # noqa: E402
from shelfwise.plans.city_insights import build_daily, insights_of  # noqa: E402
from shelfwise.session import build_session, checkpoint_dir  # noqa: E402
from shelfwise.sources import feeds  # noqa: E402


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def audit(name: str, df) -> list[str]:
    p = formatted(df)
    out = [f"## {name}", ""]
    ex = re.findall(r"\((\d+)\) Exchange\s*\nInput \[(\d+)\]: \[[^\]]*\]\nArguments: ([^\n]*)", p)
    out.append(f"Exchanges ({len(ex)}):")
    out.append("")
    for node, width, args in ex:
        args = re.sub(r"#\d+L?", "", args).split(", ENSURE_REQUIREMENTS")[0].split(", REPARTITION")[0]
        out.append(f"* ({node}) {width} columns, {args}")
    joins = re.findall(r"\(\d+\) (\w*Join\w*(?: \w+)*)\n", p)
    out += ["", "Joins: " + (", ".join(joins) if joins else "none"),
            f"Windows: {len(re.findall(r'^\(\d+\) Window', p, re.M))}; "
            f"TakeOrderedAndProject: {'yes' if 'TakeOrderedAndProject' in p else 'no'}; "
            f"CartesianProduct/BroadcastNestedLoopJoin: "
            f"{'present' if ('CartesianProduct' in p or 'BroadcastNestedLoopJoin' in p) else 'none'}", "",
            "Scans:", ""]
    scans = re.findall(r"\(\d+\) Scan parquet[^\n]*\n(?:[^\n]*\n)*?Location: [^\n]*?([\w.]+\.parquet)\]?\n"
                       r"(?:PushedFilters: ([^\n]*)\n)?ReadSchema: ([^\n]*)", p)
    for table, pushed, schema in scans:
        out.append(f"* {table}: {schema}" + (f", pushed {pushed}" if pushed else ""))
    return out + [""]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8,
                          extra={"spark.ui.showConsoleProgress": "false"})
    checkpoint_dir(spark, tempfile.mkdtemp(prefix="plans-", dir="/tmp"))
    snap, city, cats = (feeds.snapshot_feed(spark, sf), feeds.store_city_feed(spark, sf),
                        feeds.category_feed(spark, sf))
    log = feeds.attendance_feed(spark, sf)
    moves, seg_cols = movement.split_movement(snap, city)
    grain = insights.daily_grain(movement.direct_sales(moves), seg_cols)
    ins = insights_of(build_daily(snap, city), cats)
    lines = ["# Physical plans of the headline queries", "",
             f"Generated by `scripts/show_plans.py` on `{os.path.basename(sf)}`, local[8], "
             "8 shuffle partitions, no hot keys. These are the initial plans; at run time AQE may turn a "
             "sort-merge join into a broadcast from measured sizes and coalesces partitions. "
             "Small scans of `customer`/`nation` feed the size-checked store-map broadcast.", "",
             "Reading guide: the snapshots are shuffled once, on `(store_id, sku_id)` for LEAD; the daily grain's "
             "aggregation, means, fan-out sizes and stock flags reuse that partitioning, and the grain is written. "
             "The insights plan reads the grain only: no exchange on `(store_id, sku_id)`, one of the grain on "
             "`(event_date, sku_id, city_name)` for the whole roll-up, the others above partial aggregates "
             "(price-pair counts, arg-max modes, store totals).", ""]
    lines += audit("inventory_movement (LEAD per store and SKU)", movement.inventory_movement(snap, city))
    lines += audit("inventory_movement with hot keys split (threshold forced down to 10 rows, so "
                   "every key above it is split; the other exchanges are the small "
                   "persisted segment table)",
                   movement.inventory_movement(snap, city, max_rows_per_segment=10))
    lines += audit("estimated_qty", movement.estimated_sales(snap, city))
    lines += audit("daily grain (snapshots to the written table)", grain)
    lines += audit("city_insights (from the written daily grain)", ins)
    lines += audit("top_skus (report on the built table)", analyses.top_skus(ins))
    lines += audit("hours_worked", attendance.hours_worked(log))
    lines += audit("hours_in_window", attendance.hours_in_window(log, "2024-01-08 09:00:00",
                                                                  "2024-01-22 17:00:00"))
    spark.stop()
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    with open(os.path.join(root, "PLANS.md"), "w") as f:
        f.write("\n".join(lines))


if __name__ == "__main__":
    main()
