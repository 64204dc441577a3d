"""Every registered query against its DuckDB oracle on the smallest test set
(the driver's check runs the same comparison at sf0.01)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from kilowatt.plans.oracle import ORACLE
from kilowatt.plans.queries import QUERIES
from tests.conftest import SF_TINY

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def norm(v):
    if v is None:
        return "<NULL>"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_TINY}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_TINY)
    srows, scols = df.collect(), df.columns
    rel = con.sql(ORACLE[name])
    dcols, drows = rel.columns, rel.fetchall()
    assert sorted(scols) == sorted(dcols)
    dtypes = dict(zip(rel.columns, map(str, rel.types)))
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes} == dtypes
    assert len(srows) == len(drows)
    order = sorted(scols)
    a = sorted(tuple(norm(r[scols.index(c)]) for c in order) for r in srows)
    b = sorted(tuple(norm(r[dcols.index(c)]) for c in order) for r in drows)
    assert a == b


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "daily_capacity_factor_pct" in df.columns


def test_ordered_report_is_whole(spark):
    sf = SF_TINY.replace("sf0.001", "sf0.01")
    report = QUERIES["site_efficiency_report"](spark, sf)
    got = QUERIES["report_ordered_whole"](spark, sf)
    assert got.columns == report.columns
    found = got.collect()
    assert len(found) == report.count() > 50
    order = [(r["month_label"], -r["performance_score"] if r["performance_score"] is not None else math.inf) for r in found]
    assert order == sorted(order)
