"""Physical-plan shape: what each operator may and may not plan."""

import contextlib
import io
import re

import pytest

from campaignlake import registry
from campaignlake.operators import completeness, history, kpi, star, windows
from campaignlake.schema import KEY_COLS, LOADED_AT
from campaignlake.sources.fixtures import campaign_log, campaign_log_by_month

from .conftest import SF_MID, SF_SMALL


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def hash_exchanges(p):
    return len(re.findall(r"Exchange hashpartitioning", p))


@pytest.fixture(scope="module")
def log(spark):
    return campaign_log(spark, SF_SMALL)


# Queries that run their jobs when called and return a scan of stored files: their plan tells nothing.
STORED = {"append_roundtrip", "fill_incomplete", "high_water_mark_stored", "incremental_fact", "incremental_history",
          "incremental_late", "incremental_monthly", "load_job", "load_quality", "load_rejects", "stream_ingest",
          "stream_outcomes"}


@pytest.mark.parametrize("name", sorted(registry.QUERIES.keys() - STORED))
def test_no_python_in_any_query(spark, name):
    p = plan(registry.QUERIES[name](spark, SF_SMALL), "extended")
    assert not re.search(r"PythonUDF|BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas", p)


def test_history_moves_rows_once(log):
    p = plan(history.history_from_log(log), "simple")
    assert hash_exchanges(p) == 1
    # the three windows share one sort
    assert len(re.findall(r"\bSort \[", p)) == 1


def test_history_keeps_first_rows_straight_after_the_sort(log):
    p = plan(history.history_from_log(log), "simple")
    # Copies and the other rows of a load reach neither an aggregate nor a window.
    assert "Aggregate" not in p
    assert re.search(r"WindowGroupLimit \[[^\n]*\n[^\n]*Sort \[", p)


def test_precombined_history_has_a_second_exchange_after_map_side_collapse(log):
    p = plan(history.history_from_log(log, precombine=True), "simple")
    assert hash_exchanges(p) == 2
    # exact copies are removed by a hash aggregate whose partial step precedes the exchange
    assert "HashAggregate" in p and "SortAggregate" not in p
    # the three windows share one sort
    assert len(re.findall(r"\bSort \[", p)) == 1


def test_precombined_history_moves_one_row_a_load_by_key(log):
    p = plan(history.history_from_log(log, precombine=True), "simple")
    # From the top: sightings by key; before that whatever the partial step left, by key and load time.
    second, first = [re.sub(r"#\d+L?", "", x) for x in re.findall(r"Exchange hashpartitioning\(([^)]*)", p)]
    assert second.startswith(", ".join(KEY_COLS)) and LOADED_AT not in second
    assert first.startswith(", ".join([*KEY_COLS, LOADED_AT])) and "clicks" not in first
    assert p.count("partial_max") == 1


def test_as_of_join_works_the_history_out_once(spark):
    # sf0.01: see test_month_report_pushes_the_month_into_the_scan
    p = plan(registry.QUERIES["history_as_of_join"](spark, SF_MID), "simple")
    # Only the history reads prices; the probes are read for their bins and for the join.
    assert len(re.findall(r"FileScan parquet \[[^]]*l_extendedprice", p)) == 1
    assert len(re.findall(r"FileScan parquet \[[^]]*l_orderkey", p)) == 3


def test_latest_per_key_is_one_exchange_with_partial_agg(log):
    p = plan(history.latest_per_key(log), "simple")
    assert hash_exchanges(p) == 1 and "partial_max" in p


def test_fact_derives_keys_without_joins(log):
    stg = star.staging(history.history_from_log(log))
    joins = lambda df: len(re.findall(r"Join ", plan(df, "simple")))
    # the fact adds no join to whatever its staging input plans
    assert joins(star.fact_daily(stg)) == joins(stg)


def test_fact_broadcasts_the_bounded_date_dimension(spark, log):
    stg = star.staging(history.history_from_log(log))
    p = plan(star.fact_daily(stg, dates=star.dim_dates(spark)), "simple")
    assert "BroadcastHashJoin" in p and "BroadcastExchange" in p


def test_relationship_checks_build_one_history(spark):
    p = plan(registry.QUERIES["check_relationships"](spark, SF_SMALL), "simple")
    # one for the sound fact, one for the faulty one; three windows each
    assert len(re.findall(r"\bWindow \[", p)) <= 6
    p = plan(registry.QUERIES["check_unique"](spark, SF_SMALL), "simple")
    assert len(re.findall(r"\bWindow \[", p)) <= 3


def test_select_windows_is_broadcast_hash_not_nested_loop(spark, log):
    plan_df = windows.incremental_windows(spark, "1998-02-10", "1998-06-05")
    p = plan(windows.select_windows(log, plan_df), "simple")
    assert "BroadcastHashJoin" in p and "NestedLoop" not in p


def test_month_report_pushes_the_month_into_the_scan(spark):
    # sf0.01: a plan no other test caches (a cached relation would replace the scan)
    stg = star.staging(history.history_from_log(campaign_log(spark, SF_MID)))
    p = plan(kpi.month_report(stg, "1998-10-01"), "formatted")
    # the month becomes a date range below the history's aggregate and window,
    # all the way into the lineitem scan as Parquet pushed filters
    pushed = re.findall(r"PushedFilters: \[(.*)\]", p)
    assert any("GreaterThanOrEqual(l_shipdate,1998-10-01" in f and "LessThan(l_shipdate,1998-11-01" in f
               for f in pushed)


def test_monthly_uses_partial_aggregation(log):
    stg = star.staging(history.history_from_log(log))
    p = plan(kpi.monthly_campaign_summary(stg), "simple")
    assert "partial_sum" in p


def test_lacking_moves_rows_of_the_given_dates_only(spark):
    rows = spark.createDataFrame([(f"2024-01-0{1 + i % 3}", i % 5) for i in range(30)], "d string, n long")
    landed = rows.withColumn("d", rows.d.cast("date"))
    key, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, "-1")  # as with tables of which no plan is small
    try:
        dates = completeness.incomplete_dates(landed, landed.where("n > 0"), "2024-01-01", "2024-01-31", ["d", "n"], "d")
        p = plan(completeness.lacking(landed, landed.where("n > 0"), dates, ["d", "n"], "d"), "simple")
    finally:
        spark.conf.set(key, before)
    assert re.findall(r"(\w+) [^\n]*LeftSemi", p) == ["BroadcastHashJoin"] * 2


def test_log_by_month_moves_the_columns_of_the_tables(spark):
    log = campaign_log_by_month(spark, SF_MID)
    above, below = log._jdf.queryExecution().optimizedPlan().toString().split("RebalancePartitions")
    assert "AS clicks" in above and "AS clicks" not in below
    assert re.search(r"Sort \[execution_month", above)
    # In the order of the folders they are written to, so a write sorts neither wide rows nor documents.
    documents = log.selectExpr("to_json(struct(clicks)) AS value", "execution_month")._jdf.queryExecution().optimizedPlan()
    assert "execution_month" in documents.outputOrdering().mkString()
