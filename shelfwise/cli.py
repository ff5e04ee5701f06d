"""Command line: the reference's flow on Spark.

  python -m shelfwise.cli insights --snapshots S --categories C --store-city M --out DIR
        [--format csv|parquet] [--export-csv DIR] [--reports DIR] [--dedupe]
  python -m shelfwise.cli attendance --log L --out DIR [--format csv|parquet]
        [--window-start TS --window-end TS]
  python -m shelfwise.cli check --snapshots S --categories C --store-city M --out DIR
  python -m shelfwise.cli load --snapshots S --categories C --store-city M --out DIR [--batch ID] [--strict]
  python -m shelfwise.cli ingest --source FOLDER --table DIR [--name NAME] [--strict]

All take ``--multiline`` (CSV fields hold newlines) and ``--time-zone ZONE``
(of dates and of times without zone; the session's zone, UTC by default).

``insights`` loads the three tables, builds city_insights once into
``DIR/city_insights`` (nothing is loaded or built if it is there), optionally
exports it as CSV and writes the seven reports.  ``attendance`` writes hours
worked and, with a window, hours inside it.  ``check`` reports NOT NULL and
key violations of the three inputs (one row per rule, a small report written
from one task).  ``load`` commits the three CSV files to keyed tables under
``DIR``; rows that break a key go to side tables, or with ``--strict`` fail
the load of their table.  ``ingest`` does so for new snapshot CSV files,
exactly once.  CSV input is parsed once, into Parquet in the staging folder,
which is deleted at the end.  Paths may be local or any filesystem Spark
reads; on a cluster they must be shared.
"""

from __future__ import annotations

import argparse
import sys
import uuid

from pyspark.sql import DataFrame, SparkSession

from .operators import analyses, attendance
from .operators.quality import key_violations
from .plans.city_insights import materialize, ordered
from .session import build_session, release, staging_dir
from .sources import csv_io, keyed, schemas
from .streaming.ingest import start_snapshot_ingest

REPORTS = ["top_skus", "skus_by_city", "stockout_skus", "brand_revenue", "city_revenue",
           "category_revenue", "discount_bands"]


def _load(spark: SparkSession, path: str, a, reader) -> DataFrame:
    if a.format == "parquet":
        return spark.read.parquet(path)
    return csv_io.once(reader(spark, path, multiline=a.multiline), f"{a.staging}/{reader.__name__}")


def _tables(spark: SparkSession, a) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Snapshots, store map and categories."""
    return (_load(spark, a.snapshots, a, csv_io.read_snapshots), _load(spark, a.store_city, a, csv_io.read_store_city),
            _load(spark, a.categories, a, csv_io.read_categories))


def run_insights(spark: SparkSession, a) -> None:
    table = f"{a.out.rstrip('/')}/city_insights"
    materialize(spark, lambda: _tables(spark, a), path=table, dedupe=a.dedupe)
    ins = spark.read.parquet(table)
    if a.export_csv:
        csv_io.write_csv(ordered(ins), a.export_csv)
    if a.reports:
        for name in REPORTS:
            csv_io.write_csv(getattr(analyses, name)(ins), f"{a.reports.rstrip('/')}/{name}")


def run_attendance(spark: SparkSession, a) -> None:
    log = _load(spark, a.log, a, csv_io.read_attendance)
    out = a.out.rstrip("/")
    csv_io.write_csv(attendance.hours_worked(log), f"{out}/hours_worked")
    if a.window_start and a.window_end:
        csv_io.write_csv(attendance.hours_in_window(log, a.window_start, a.window_end),
                         f"{out}/hours_in_window")


def run_check(spark: SparkSession, a) -> None:
    """Key and NOT NULL rules of the three input tables -> one CSV report."""
    snap, city, cats = _tables(spark, a)
    report = key_violations(snap, "inventory_snapshots", schemas.SNAPSHOT_KEY, schemas.SNAPSHOT_NOT_NULL)
    for df, name, key in ((city, "store_city", schemas.STORE_CITY_KEY), (cats, "category_dim", schemas.CATEGORY_KEY)):
        report = report.unionByName(key_violations(df, name, key, []))
    csv_io.write_csv(report.coalesce(1), a.out)


def run_load(spark: SparkSession, a) -> None:
    """The three CSV files -> keyed tables; a load that is there already is left alone."""
    for path, name, reader, rules in (
            (a.snapshots, "inventory_snapshots", csv_io.read_snapshots, keyed.SNAPSHOTS),
            (a.categories, "category_dim", csv_io.read_categories, keyed.CATEGORIES),
            (a.store_city, "store_city", csv_io.read_store_city, keyed.STORE_CITY)):
        rows = keyed.with_partition(reader(spark, path, multiline=a.multiline), rules)
        found = keyed.load(rows, f"{a.out.rstrip('/')}/{name}", rules, a.batch, strict=a.strict)
        print(f"{name}: " + ("loaded before" if found is None else
                             f"{found['accepted']} rows loaded, {found['rejected']} rejected"))


def run_ingest(spark: SparkSession, a) -> None:
    """Snapshot CSV drops -> keyed table, exactly once (processes what is there)."""
    start_snapshot_ingest(spark, a.source, a.table, name=a.name, multiline=a.multiline,
                          strict=a.strict).awaitTermination()


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="shelfwise")
    sub = p.add_subparsers(dest="cmd", required=True)
    i = sub.add_parser("insights")
    i.add_argument("--snapshots", required=True)
    i.add_argument("--categories", required=True)
    i.add_argument("--store-city", required=True)
    i.add_argument("--out", required=True)
    i.add_argument("--format", choices=["csv", "parquet"], default="csv")
    i.add_argument("--export-csv")
    i.add_argument("--reports")
    i.add_argument("--dedupe", action="store_true")
    t = sub.add_parser("attendance")
    t.add_argument("--log", required=True)
    t.add_argument("--out", required=True)
    t.add_argument("--format", choices=["csv", "parquet"], default="csv")
    t.add_argument("--window-start")
    t.add_argument("--window-end")
    c = sub.add_parser("check")
    c.add_argument("--snapshots", required=True)
    c.add_argument("--categories", required=True)
    c.add_argument("--store-city", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--format", choices=["csv", "parquet"], default="csv")
    k = sub.add_parser("load")
    k.add_argument("--snapshots", required=True)
    k.add_argument("--categories", required=True)
    k.add_argument("--store-city", required=True)
    k.add_argument("--out", required=True)
    k.add_argument("--batch", default="initial", help="name of this load; one that is there is not repeated")
    g = sub.add_parser("ingest")
    g.add_argument("--source", required=True, help="folder (or glob) receiving snapshot CSV files")
    g.add_argument("--table", required=True, help="Parquet table path")
    g.add_argument("--name", default="snapshot_ingest", help="stream name (checkpoint sub-folder)")
    for command in (k, g):
        command.add_argument("--strict", action="store_true", help="fail on the first rule that is broken")
    for command in sub.choices.values():
        command.add_argument("--multiline", action="store_true", help="CSV fields may hold newlines")
        command.add_argument("--time-zone", help="zone of dates and of times without zone")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    if spark is None:
        spark = build_session(app=f"shelfwise-{a.cmd}")
    if a.time_zone:
        spark.conf.set("spark.sql.session.timeZone", a.time_zone)
    a.staging = f"{staging_dir(spark)}/cli/{uuid.uuid4().hex}"
    try:
        {"insights": run_insights, "attendance": run_attendance, "check": run_check,
         "load": run_load, "ingest": run_ingest}[a.cmd](spark, a)
    finally:
        release(spark, a.staging)


if __name__ == "__main__":
    main(sys.argv[1:])
