"""CSV load (with a declared schema) and CSV export.

The reference loads three CSV files with a header row.  Fields are read as
text and cast to the declared types, so every layout that the casts know is
accepted: for timestamps ``2024-03-01 10:00:00``, with a fraction, with a zone
as ``+05``, ``+05:30`` or ``Z``, with a blank or a ``T`` between date and time
(a time without zone is in the session's zone).  A field that no cast accepts
is an error, whatever the session's ANSI setting; so is a malformed row.
Quotes inside fields are doubled in PostgreSQL's CSV dialect, so the escape
character is the quote itself; an unquoted empty field is NULL and a quoted
one ("") the empty string, on read and on write.  Blanks at the ends of a
field belong to it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import ATTENDANCE_SCHEMA, CATEGORY_SCHEMA, SNAPSHOT_SCHEMA, STORE_CITY_SCHEMA

# Microsecond timestamps with zone offset, so that a write/read round trip is lossless.
TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSSXXX"
TS_NTZ_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


# A quoted empty field ("") reads as this marker, then as the empty string,
# while an unquoted empty field stays NULL -- PostgreSQL's CSV rule.  NUL
# cannot occur in PostgreSQL text, so the marker never collides with data.
_EMPTY = "\u0000"


def reader_options(multiline: bool = False) -> dict[str, str]:
    """CSV options shared by the batch and streaming loaders."""
    return {"header": "true", "quote": '"', "escape": '"', "emptyValue": _EMPTY,
            "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
            "multiLine": str(multiline).lower(), "mode": "FAILFAST"}


def as_text(schema: T.StructType) -> T.StructType:
    """The columns of a schema, all text."""
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])


def _parsed(field: T.StructField) -> Column:
    text = F.col(field.name)
    if isinstance(field.dataType, T.StringType):
        return F.when(text == _EMPTY, F.lit("")).otherwise(text).alias(field.name)
    value = text.try_cast(field.dataType)
    bad = F.raise_error(F.concat(F.lit(f"column {field.name}: not a {field.dataType.simpleString()}: "), text))
    return F.when(text.isNotNull() & value.isNull(), bad.cast(field.dataType)).otherwise(value).alias(field.name)


def typed(df: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Text columns cast to the declared types, and the columns ``keep`` as they are; a field that cannot be cast
    is an error."""
    return df.select([_parsed(f) for f in schema.fields] + list(keep))


def read_csv(spark: SparkSession, path: str, schema: T.StructType, *,
             multiline: bool = False) -> DataFrame:
    """Load CSV with a header row.  ``multiline`` only if fields contain newlines:
    multi-line files cannot be split across tasks."""
    return typed(spark.read.schema(as_text(schema)).options(**reader_options(multiline)).csv(path), schema)


def read_snapshots(spark: SparkSession, path: str, **kw) -> DataFrame:
    return read_csv(spark, path, SNAPSHOT_SCHEMA, **kw)


def read_categories(spark: SparkSession, path: str, **kw) -> DataFrame:
    return read_csv(spark, path, CATEGORY_SCHEMA, **kw)


def read_store_city(spark: SparkSession, path: str, **kw) -> DataFrame:
    return read_csv(spark, path, STORE_CITY_SCHEMA, **kw)


def read_attendance(spark: SparkSession, path: str, **kw) -> DataFrame:
    return read_csv(spark, path, ATTENDANCE_SCHEMA, **kw)


def once(df: DataFrame, path: str) -> DataFrame:
    """``df`` written as Parquet and read back: CSV is parsed once, however often the rows are read, and
    counts come from footers."""
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Export with a header row; one file per task (no coalesce to a single writer)."""
    (df.write.mode(mode)
       .option("header", True)
       .option("quote", '"').option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .option("timestampFormat", TS_FORMAT)
       .option("timestampNTZFormat", TS_NTZ_FORMAT)
       .csv(path))


def csv_round_trip(df: DataFrame, path: str, schema: T.StructType, *, multiline: bool = False) -> DataFrame:
    """Write ``df`` as CSV at ``path`` and load it back with ``schema``."""
    write_csv(df, path)
    return read_csv(df.sparkSession, path, schema, multiline=multiline)
