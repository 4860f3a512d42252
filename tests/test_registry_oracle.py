"""Every registered query against its DuckDB SQL oracle on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from campaignlake import registry
from tools.check_oracle import TABLES, _rows

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLE_SQL)
    assert set(registry.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    srows = [r.asDict() for r in sdf.collect()]
    rel = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in rel.description]
    drows = [dict(zip(cols, r)) for r in rel.fetchall()]
    assert sorted(cols) == sorted(sdf.columns)
    assert len(srows) == len(drows)
    key = sorted(cols)
    assert _rows(srows, key) == _rows(drows, key)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and df.columns[:2] == ["report_month", "campaign_name"]


def test_the_fixture_can_make_checks_and_histories_fail(spark):
    """Unchanged reloads collapse, and every check shows sound and faulty rows."""
    q = registry.QUERIES
    assert q["history_from_log"](spark, SF_SMALL).count() < q["history_include_load_ts"](spark, SF_SMALL).count()
    for name in ("check_not_null", "check_expression", "check_unique", "check_relationships"):
        failures = [r["failures"] for r in q[name](spark, SF_SMALL).collect()]
        assert 0 in failures and max(failures) > 0, name
