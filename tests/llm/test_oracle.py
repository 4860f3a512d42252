"""Queries that SQL can express, against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from campaignlake.llm import queries
from tools.check_oracle import TABLES, _rows

from .util import SF


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    rel = con.execute(queries.ORACLE_SQL[name])
    cols = [d[0] for d in rel.description]
    assert sorted(cols) == sorted(df.columns)
    assert _rows([r.asDict() for r in df.collect()], sorted(cols)) == _rows(
        [dict(zip(cols, r)) for r in rel.fetchall()], sorted(cols))
