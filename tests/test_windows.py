"""Load planning: windows, selection, high-water mark, gaps."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from campaignlake.operators import windows
from campaignlake.sources.fixtures import campaign_log

from .conftest import SF_SMALL


def rows(df):
    return [(r["chunk"], r["window_start"], r["window_end"]) for r in df.orderBy("chunk").collect()]


def _covers(ws, lo, hi):
    days = set()
    for _, s, e in ws:
        n = (e - s).days + 1
        got = {s + dt.timedelta(days=i) for i in range(n)}
        assert not (days & got), "windows overlap"
        assert s.month == e.month and s.year == e.year
        days |= got
    assert days == {lo + dt.timedelta(days=i) for i in range((hi - lo).days + 1)}


def test_backfill_newest_first_clipped_and_covering(spark):
    target = dt.date(2024, 10, 15)
    ws = rows(windows.backfill_windows(spark, target))
    assert ws[0] == (1, dt.date(2024, 10, 1), target)
    oldest = target - dt.timedelta(days=1826)
    assert ws[-1][1] == oldest
    assert [w[1] for w in ws] == sorted((w[1] for w in ws), reverse=True)
    _covers(ws, oldest, target)


def test_incremental_oldest_first(spark):
    ws = rows(windows.incremental_windows(spark, "2024-08-20", "2024-10-03"))
    assert ws == [(1, dt.date(2024, 8, 21), dt.date(2024, 8, 31)),
                  (2, dt.date(2024, 9, 1), dt.date(2024, 9, 30)),
                  (3, dt.date(2024, 10, 1), dt.date(2024, 10, 3))]


def test_incremental_up_to_date_is_empty(spark):
    assert windows.incremental_windows(spark, "2024-10-03", "2024-10-03").count() == 0


def test_plan_load_switch(spark):
    assert windows.plan_load(spark, None, "2024-10-03").count() == 61
    assert windows.plan_load(spark, dt.date(2024, 10, 1), "2024-10-03").count() == 1


def test_target_validation():
    with pytest.raises(ValueError):
        windows.parse_target("2024/10/01")


def test_select_windows_matches_brute_force(spark):
    log = campaign_log(spark, SF_SMALL)
    plan = windows.incremental_windows(spark, "1998-02-10", "1998-06-05")
    got = windows.select_windows(log, plan).groupBy("chunk").count()
    got = {r["chunk"]: r["count"] for r in got.collect()}
    want = {}
    for w in plan.collect():
        n = log.where(F.col("campaigns_execution_date").between(w["window_start"], w["window_end"])).count()
        if n:
            want[w["chunk"]] = n
    assert got == want


def test_high_water_mark_value(spark, tmp):
    assert windows.high_water_mark_value(spark, f"{tmp}/missing") is None
    log = campaign_log(spark, SF_SMALL)
    assert windows.high_water_mark_value(spark, log) == log.agg(F.max("campaigns_execution_date")).first()[0]


def test_plan_from_log(spark):
    log = campaign_log(spark, SF_SMALL)
    inc = windows.plan_from_log(log.where(F.col("campaigns_execution_date") < "1998-01-01"),
                                target=F.lit("1998-03-10").cast("date"))
    assert rows(inc)[0][1] > dt.date(1997, 12, 1)
    empty = log.limit(0)
    assert windows.plan_from_log(empty, target=F.lit("2024-10-01").cast("date")).count() == 61


def test_missing_dates(spark):
    log = campaign_log(spark, SF_SMALL)
    have = {r[0] for r in log.select("campaigns_execution_date").distinct().collect()}
    lo, hi = dt.date(1996, 1, 1), dt.date(1996, 12, 31)
    want = sorted(lo + dt.timedelta(days=i) for i in range((hi - lo).days + 1)
                  if lo + dt.timedelta(days=i) not in have)
    got = sorted(r[0] for r in windows.missing_dates(log, lo, hi).collect())
    assert got == want and got


def test_period_scan_prunes_month_directories(spark, tmp):
    from campaignlake.sources.sinks import append, create_log_table
    assert create_log_table(spark, f"{tmp}/log") is True
    assert create_log_table(spark, f"{tmp}/log") is False
    log = campaign_log(spark, SF_SMALL)
    append(log, f"{tmp}/log")
    stored = spark.read.parquet(f"{tmp}/log")
    got = windows.period_scan(stored, "1997-03-15", "1997-05-31")
    want = log.where(F.col("campaigns_execution_date").between("1997-03-15", "1997-05-31")).count()
    assert got.count() == want
    import contextlib, io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        got.explain("formatted")
    p = buf.getvalue()
    assert "PartitionFilters: [isnotnull(execution_month" in p and "PushedFilters" in p
