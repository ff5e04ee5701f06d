"""The command-line flow: CSV in, table once, CSV export and reports out."""

import os

from shelfwise import cli
from shelfwise.sources import csv_io, keyed, schemas

from .handmade import frames
from .test_attendance import sample_rows


def test_insights_flow(spark, scratch):
    snap, city, cat = frames(spark)
    paths = {n: os.path.join(scratch, n) for n in ("snap", "city", "cat", "out", "csv", "rep")}
    csv_io.write_csv(snap, paths["snap"])
    csv_io.write_csv(city, paths["city"])
    csv_io.write_csv(cat, paths["cat"])
    argv = ["insights", "--snapshots", paths["snap"], "--categories", paths["cat"],
            "--store-city", paths["city"], "--out", paths["out"], "--export-csv", paths["csv"],
            "--reports", paths["rep"]]
    cli.main(argv, spark=spark)
    ins = spark.read.parquet(os.path.join(paths["out"], "city_insights"))
    exported = spark.read.option("header", True).csv(paths["csv"])
    assert exported.count() == ins.count() > 0
    assert sorted(exported.columns) == sorted(schemas.INSIGHTS_COLUMNS)
    for name in cli.REPORTS:
        assert spark.read.option("header", True).csv(os.path.join(paths["rep"], name)).count() > 0
    os.rename(paths["snap"], paths["snap"] + "_gone")
    cli.main(argv, spark=spark)   # second run: the table is kept, its inputs are not even read
    assert spark.read.parquet(os.path.join(paths["out"], "city_insights")).count() == ins.count()


def test_attendance_flow(spark, scratch):
    log = spark.createDataFrame(sample_rows(), schemas.ATTENDANCE_SCHEMA)
    src, out = os.path.join(scratch, "log"), os.path.join(scratch, "out")
    csv_io.write_csv(log, src)
    cli.main(["attendance", "--log", src, "--out", out, "--window-start", "2025-11-11 09:00:00",
              "--window-end", "2025-11-11 17:00:00"], spark=spark)
    hw = {r.employee_id: float(r.total_hours)
          for r in spark.read.option("header", True).csv(os.path.join(out, "hours_worked")).collect()}
    assert hw["E005"] == 7.45 and len(hw) == 7
    assert spark.read.option("header", True).csv(os.path.join(out, "hours_in_window")).count() == 7


def test_check_and_ingest(spark, scratch):
    snap, city, cat = frames(spark)
    paths = {n: os.path.join(scratch, n) for n in ("snap", "city", "cat", "report", "table")}
    csv_io.write_csv(snap.unionByName(snap.limit(1)), paths["snap"])     # one duplicate key
    csv_io.write_csv(city, paths["city"])
    csv_io.write_csv(cat, paths["cat"])
    cli.main(["check", "--snapshots", paths["snap"], "--categories", paths["cat"],
              "--store-city", paths["city"], "--out", paths["report"]], spark=spark)
    rep = {(r.table_name, r.rule): int(r.violating_rows)
           for r in spark.read.option("header", True).csv(paths["report"]).collect()}
    assert rep[("inventory_snapshots", "unique:created_at,sku_id,store_id")] == 2
    assert rep[("store_city", "unique:store_id")] == 0
    cli.main(["ingest", "--source", paths["snap"], "--table", paths["table"], "--multiline"], spark=spark)
    assert spark.read.parquet(paths["table"]).count() == snap.count()
    rejects = keyed.read_rejects(spark, paths["table"], keyed.SNAPSHOTS)
    assert [(r.reason, r.copies) for r in rejects.collect()] == [(keyed.IN_BATCH, 1)]


def test_time_zone_decides_the_day(spark, scratch):
    snap, city, cat = frames(spark)
    paths = {n: os.path.join(scratch, n) for n in ("snap", "city", "cat")}
    for df, n in ((snap, "snap"), (city, "city"), (cat, "cat")):
        csv_io.write_csv(df, paths[n])
    days = {}
    for zone in ("UTC", "Pacific/Kiritimati"):
        out = os.path.join(scratch, zone.replace("/", "_"))
        try:
            cli.main(["insights", "--snapshots", paths["snap"], "--categories", paths["cat"], "--store-city",
                      paths["city"], "--out", out, "--time-zone", zone], spark=spark)
            rows = spark.read.parquet(os.path.join(out, "city_insights")).collect()
            days[zone] = sorted((str(r.date), r.sku_id, str(r.city_name), int(r.est_qty_sold)) for r in rows)
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert days["Pacific/Kiritimati"] != days["UTC"]
