"""Every registered query against its DuckDB oracle on the sf0.001 test tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from shelfwise.plans import oracle, registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ["customer", "nation", "events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _rows(pdf):
    def norm(v):
        if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
            return None
        if isinstance(v, float):
            return str(int(v)) if v.is_integer() else repr(v)
        if hasattr(v, "item"):
            return norm(v.item())
        return str(v)
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)),
                        key=lambda t: tuple("" if x is None else x for x in t))


def test_every_query_has_an_oracle():
    assert set(registry.queries()) <= set(oracle.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_oracle(spark, duck, name):
    sp = registry.queries()[name](spark, SF).toPandas()
    dk = duck.sql(oracle.oracle_sql()[name]).df()
    got, want = _rows(sp), _rows(dk)
    assert got[0] == want[0]
    assert got[1] == want[1]
    # strict form: same pandas dtype per column and same text of every value
    cols = got[0]
    assert [str(sp[c].dtype) for c in cols] == [str(dk[c].dtype) for c in cols]
    assert sorted(sp[cols].astype(str).itertuples(index=False, name=None)) == \
        sorted(dk[cols].astype(str).itertuples(index=False, name=None))


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 22
