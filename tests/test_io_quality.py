"""CSV load/export, create-if-absent, key checks."""

import os

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import quality
from shelfwise.plans.city_insights import build_city_insights, materialize, ordered
from shelfwise.session import list_names, staging_dir
from shelfwise.sources import csv_io, schemas
from shelfwise.sources.tables import create_table_if_absent

from .handmade import frames


def test_csv_round_trip_keeps_values(spark, scratch):
    snap, _, _ = frames(spark)
    snap = snap.withColumn("sku_name", F.when(F.col("store_id") == 1, F.lit('say "hi", twice'))
                           .when(F.col("store_id") == 2, F.lit(""))
                           .when(F.col("store_id") == 3, F.lit(None))
                           .otherwise(F.col("sku_name")))
    back = csv_io.csv_round_trip(snap, os.path.join(scratch, "snap_csv"), schemas.SNAPSHOT_SCHEMA)
    # file sources report every field nullable; NOT NULL is checked by key_violations
    assert [(f.name, f.dataType) for f in back.schema] == \
        [(f.name, f.dataType) for f in schemas.SNAPSHOT_SCHEMA]
    assert sorted(back.collect()) == sorted(snap.collect())


def test_csv_reads_postgres_export(spark, scratch):
    p = os.path.join(scratch, "city.csv")
    with open(p, "w") as f:
        f.write('store_id,city_name\n1,"Delhi, NCR"\n2,"A ""quoted"" town"\n3,\n4,""\n')
    rows = csv_io.read_store_city(spark, p).orderBy("store_id").collect()
    # unquoted empty is NULL, quoted empty is the empty string (PostgreSQL CSV)
    assert [r.city_name for r in rows] == ["Delhi, NCR", 'A "quoted" town', None, ""]


@pytest.mark.parametrize("text, utc", [
    ("2024-03-01 10:00:00", "10:00:00"), ("2024-03-01 10:00:00+00", "10:00:00"),
    ("2024-03-01 10:00:00.123456+05", "05:00:00.123456"), ("2024-03-01T10:00:00Z", "10:00:00"),
    ("2024-03-01 10:00:00+05:30", "04:30:00"), ("2024-03-01 10:00:00.5", "10:00:00.500000"),
])
def test_csv_timestamp_layouts(spark, scratch, text, utc):
    p = os.path.join(scratch, "snap.csv")
    with open(p, "w") as f:
        f.write(",".join(x.name for x in schemas.SNAPSHOT_SCHEMA) + "\n")
        f.write(f'{text},1,2,3,4," blanks kept ",45.00,50,7,,9,b,\n')
    r = csv_io.read_snapshots(spark, p).select("*", F.col("created_at").cast("string").alias("at")).first()
    assert r.at.rstrip("0").rstrip(".") == f"2024-03-01 {utc}".rstrip("0").rstrip(".") or r.at == f"2024-03-01 {utc}"
    assert r.sku_name == " blanks kept " and r.image_url is None and r.inventory == 7


@pytest.mark.parametrize("row", ["yesterday,1,2,3,4,n,45,50,7,i,9,b,u", "2024-03-01 10:00:00,1,2,3,4,n,x,50,7,i,9,b,u",
                                 "2024-03-01 10:00:00,1,2,three,4,n,45,50,7,i,9,b,u"])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_csv_bad_field_is_an_error(spark, scratch, row, ansi):
    p = os.path.join(scratch, "snap.csv")
    with open(p, "w") as f:
        f.write(",".join(x.name for x in schemas.SNAPSHOT_SCHEMA) + "\n" + row + "\n")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="not a"):
            csv_io.read_snapshots(spark, p).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_csv_newlines_and_blanks_round_trip(spark, scratch):
    rows = [(1, " x "), (2, "two\nlines"), (3, 'quote " and, comma'), (4, ""), (5, None), (6, "\ttab")]
    df = spark.createDataFrame(rows, schemas.STORE_CITY_SCHEMA)
    back = csv_io.csv_round_trip(df, os.path.join(scratch, "c"), schemas.STORE_CITY_SCHEMA, multiline=True)
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_materialize_keeps_first_rows_and_builds_once(spark, scratch):
    path = os.path.join(scratch, "city_insights")
    calls = []

    def inputs():
        calls.append(1)
        snap, city, cat = frames(spark)
        return snap, city, cat

    assert materialize(spark, inputs, path=path)
    first = spark.read.parquet(path).count()
    assert not materialize(spark, inputs, path=path) and calls == [1]
    assert spark.read.parquet(path).count() == first > 0
    o = ordered(spark.read.parquet(path)).collect()
    keys = [(r.date, r.city_name is None, r.city_name or "", r.sku_id) for r in o]
    assert keys == sorted(keys)


def test_key_violations_finds_planted_rows(spark):
    snap, _, _ = frames(spark)
    dup = snap.limit(2)
    nulls = snap.limit(1).withColumn("sku_id", F.lit(None).cast("long"))
    bad = snap.unionByName(dup).unionByName(nulls)
    got = {r.rule: r.violating_rows for r in quality.key_violations(
        bad, "inventory_snapshots", schemas.SNAPSHOT_KEY, schemas.SNAPSHOT_NOT_NULL).collect()}
    assert got["not_null:sku_id"] == 1
    assert got["not_null:created_at"] == 0
    assert got["unique:created_at,sku_id,store_id"] == 4
    clean = {r.rule: r.violating_rows for r in quality.key_violations(
        snap, "s", schemas.SNAPSHOT_KEY, schemas.SNAPSHOT_NOT_NULL).collect()}
    assert set(clean.values()) == {0}


def test_create_if_absent_and_what_is_there_already(spark, scratch):
    snap, _, _ = frames(spark)
    path = os.path.join(scratch, "t")
    os.makedirs(os.path.join(path, "_temporary"))          # what a killed write leaves
    assert create_table_if_absent(spark, lambda: snap, path=path)
    assert spark.read.parquet(path).count() == snap.count()
    assert not create_table_if_absent(spark, lambda: 1 / 0, path=path)
    assert spark.read.parquet(path).count() == snap.count()
    other = os.path.join(scratch, "someones")
    snap.write.parquet(other)
    os.remove(os.path.join(other, "_SUCCESS"))             # a complete table whose marker is switched off
    with pytest.raises(FileExistsError):
        create_table_if_absent(spark, lambda: snap.limit(1), path=other)
    assert spark.read.parquet(other).count() == snap.count()


def test_create_if_absent_metastore_table(spark):
    snap, city, cat = frames(spark)
    spark.sql("DROP TABLE IF EXISTS insights_once")
    assert create_table_if_absent(spark, lambda: build_city_insights(snap, city, cat), table="insights_once",
                                  partition_by=["date"])
    n = spark.table("insights_once").count()
    assert not create_table_if_absent(spark, lambda: 1 / 0, table="insights_once")
    assert spark.table("insights_once").count() == n > 0


def test_daily_grain_is_released(spark, scratch):
    folder = f"{staging_dir(spark)}/daily_grain"
    before = set(list_names(spark, folder))
    materialize(spark, lambda: frames(spark), path=os.path.join(scratch, "x"))
    assert set(list_names(spark, folder)) == before


def test_staging_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master, applicationId = "spark://host:7077", "app"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(RuntimeError):
        staging_dir(Session())


def test_broadcast_is_by_rows_and_bytes(spark):
    from shelfwise.functions.joins import sized_broadcast

    def hinted(df, **kw):
        return "broadcast" in sized_broadcast(df, **kw)._jdf.queryExecution().logical().toString().lower()

    wide = spark.range(10).select("id", F.repeat(F.lit("é"), 1000).alias("t"))
    assert hinted(wide) and not hinted(wide, max_rows=9) and not hinted(wide, max_bytes=19_000)
    assert hinted(wide, max_bytes=21_000)
