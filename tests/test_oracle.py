"""Every registered query against its DuckDB oracle on the smallest scale
factor (the driver repeats this at sf0.01)."""

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from stratum.plans import registry
from stratum.sources.tables import DRIVER_TABLES

from conftest import SF_SMALL

SQL = entry.oracle_sql()
NAMES = sorted(registry.queries())     # tests/llm has the others


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    if isinstance(v, list):
        return tuple(_norm(x) for x in v)
    return v


def _bag(cols, rows):
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in idx) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle_or_is_declared_non_sql():
    assert set(NAMES) - set(SQL) == {"fraud_scores", "fraud_auc", "severity_pred", "severity_error",
                                      "similar_vectors_lsh", "similar_claims_lsh", "mart_claim_percentiles"}


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert len(rows) > 0
        return
    cur = con.execute(SQL[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _bag(df.columns, rows) == _bag(ocols, cur.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.schema == entry.entry(spark).schema
