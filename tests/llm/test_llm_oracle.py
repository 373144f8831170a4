"""The operators with SQL, against DuckDB."""

import duckdb
import pytest

from stratum.llm import queries

from conftest import SF_SMALL
from test_oracle import _bag


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF_SMALL)
    cur = con.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert _bag(df.columns, [tuple(r) for r in df.collect()]) == _bag(columns, cur.fetchall())
