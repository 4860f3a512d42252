"""Named queries over the driver's tables, each with an equivalent DuckDB SQL oracle.

Every query reads the whole ``lineitem`` and ``part`` tables through the log
projection of :func:`campaignlake.sources.fixtures.campaign_log` and runs an
operator of the library on it.  ``oracle_sql()`` states the same result in
plain SQL over the same tables (views ``lineitem``, ``part`` ...), written
independently of the Spark code path, with identical column names.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import checks, completeness, history, ingest, kpi, quality, star, windows
from .plans import history_store, incremental
from .plans.layers import build_layers
from .plans.load import fill_incomplete, load, read_log, read_quality
from .plans.reports import export_reports, run_sql_reports
from .schema import (KEY_COLS, LIFEDAY_COLS, LIFEDAYS, LOADED_AT, LOG_COLS, METRIC_COLS,
                     SORTED_METRIC_COLS, lifeday_cols, staging_lifeday_cols)
from .session import ensure_checkpoint_dir, scratch_path
from .sources import fixtures
from .sources.fixtures import campaign_log, campaign_log_by_month
from .sources.records import parse_records, read_records, to_records
from .sources.sinks import append, create_log_table, rejects_beside
from .streaming.ingest_stream import start_ingest_stream

# --- query parameters (fixed) ----------------------------------------------------
REPORT_MONTH = "1998-10-01"
AS_OF = "1998-06-01 00:00:00"
# snapshot_merge: history of everything loaded before the cutoff, then the rest merged in.
MERGE_CUTOFF = "1998-01-01 00:00:00"
# incremental planning: the log as it stood before this load time.
LOAD_STATE = "1999-06-30 00:00:00"
MISSING_FROM, MISSING_TO = "1994-12-01", "2001-12-31"
PERIOD_FROM, PERIOD_TO = "1997-03-15", "1997-05-31"
# snapshot_merge_fold: load times at which further batches are merged.
FOLD_CUTOFFS = ("1997-01-01 00:00:00", "1998-01-01 00:00:00", "1999-06-01 00:00:00")
# snapshot_merge_late: a batch that begins a month before what is merged already.
LATE_FROM = "1997-12-01 00:00:00"
PLAN_TARGET = "2002-03-15"
LOAD_TARGETS = ("1998-06-30", "1999-06-30")
SPINE_FROM, SPINE_TO = "1996-01-01", "1999-01-01"
FRESHNESS_NOW = "2001-11-10 12:00:00"
TOP_K = 10
# ---------------------------------------------------------------------------------


# ================================ Spark side =====================================

def _log(spark, d):
    return campaign_log(spark, d)


def _history(spark, d):
    return history.history_from_log(_log(spark, d))


def _stg(spark, d):
    return star.staging(_history(spark, d))


def _monthly(spark, d):
    return kpi.monthly_campaign_summary(_stg(spark, d))


def q_high_water_mark(spark, d):
    return windows.high_water_mark(_log(spark, d))


def q_backfill_windows(spark, d):
    # First-load plan up to the log's newest date: month chunks, newest first.
    return _backfill(spark, d)


def _backfill(spark, d):
    log = _log(spark, d)
    b = log.agg(F.max("campaigns_execution_date").alias("hi"))
    b = b.select(F.date_sub("hi", 5 * 365 + 1).alias("lo"), "hi")
    return windows.windows_between(b, newest_first=True)


def _incremental_plan(spark, d):
    """hwm = the log as loaded before LOAD_STATE; target = the newest date now in the log.

    Both bounds come out of one aggregate over the log (no join of two one-row results).
    """
    both = _log(spark, d).agg(
        F.max(F.when(F.col("_etl_loaded_at") < F.lit(LOAD_STATE).cast("timestamp_ntz"),
                     F.col("campaigns_execution_date"))).alias("hwm"),
        F.max("campaigns_execution_date").alias("hi"))
    return windows.windows_between(both.select(F.date_add("hwm", 1).alias("lo"), "hi"),
                                   newest_first=False)


def q_incremental_windows(spark, d):
    return _incremental_plan(spark, d)


def q_plan_from_log(spark, d):
    # Both modes: a log with rows (incremental, oldest month first) and one without (backfill).
    log, target = _log(spark, d), F.lit(PLAN_TARGET)
    loaded = windows.plan_from_log(log, target).withColumn("mode", F.lit("incremental"))
    return loaded.unionByName(windows.plan_from_log(log.where("spend_cents < 0"), target)
                              .withColumn("mode", F.lit("backfill")))


def q_gap_windows(spark, d):
    return windows.gap_windows(_log(spark, d), MISSING_FROM, MISSING_TO)


def q_select_windows(spark, d):
    sel = windows.select_windows(_log(spark, d), _incremental_plan(spark, d))
    return sel.select("chunk", "window_start", "window_end", *KEY_COLS, "spend_cents", "_etl_loaded_at")


def q_period_scan(spark, d):
    return windows.period_scan(_log(spark, d), PERIOD_FROM, PERIOD_TO)


def q_missing_dates(spark, d):
    return windows.missing_dates(_log(spark, d), MISSING_FROM, MISSING_TO)


def q_latest_per_key(spark, d):
    return history.latest_per_key(_log(spark, d))


def q_history_from_log(spark, d):
    return _history(spark, d)


def q_history_split_by_day(spark, d):
    # The opt-in form for hot keys: windows per (key, load day), same result.
    return history.history_from_log_split(_log(spark, d))


def q_history_include_load_ts(spark, d):
    # The literal snapshot configuration: the load time is a checked column too,
    # so every distinct (key, load time) sighting is a version.
    return history.history_from_log(_log(spark, d), include_load_ts=True)


def _at(text):
    return F.lit(text).cast("timestamp_ntz")


def _through(cutoff):
    """Everything loaded before the cutoff is merged."""
    return datetime.fromisoformat(cutoff) - timedelta(microseconds=1)


def _stored(df):
    """A history as a run would find it: in storage, read as often as needed."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def q_snapshot_merge(spark, d):
    log = _log(spark, d)
    before = _stored(history.history_from_log(log.where(F.col(LOADED_AT) < _at(MERGE_CUTOFF))))
    batch = log.where(F.col(LOADED_AT) >= _at(MERGE_CUTOFF))
    return history.snapshot_merge(before, batch, _through(MERGE_CUTOFF)).history


def q_snapshot_merge_fold(spark, d):
    log = _log(spark, d)
    first, *_ = FOLD_CUTOFFS
    merged = history.history_from_log(log.where(F.col(LOADED_AT) < _at(first)))
    for lo, hi in zip(FOLD_CUTOFFS, (*FOLD_CUTOFFS[1:], None)):
        batch = log.where((F.col(LOADED_AT) >= _at(lo)) & (F.lit(True) if hi is None else F.col(LOADED_AT) < _at(hi)))
        merged = history.snapshot_merge(_stored(merged), batch, _through(lo)).history
    return merged


def q_snapshot_merge_late(spark, d):
    log = _log(spark, d)
    before = _stored(history.history_from_log(log.where(F.col(LOADED_AT) < _at(MERGE_CUTOFF))))
    batch = fixtures.without_some_load_times(log.where(F.col(LOADED_AT) >= _at(LATE_FROM)))
    late = history.snapshot_merge(before, batch, _through(MERGE_CUTOFF)).late
    return late.select(*KEY_COLS, "spend_cents", LOADED_AT)


def q_incremental_history(spark, d):
    # Daily runs: the stored history is brought up to the log as it stood at three times.
    log, path = _log(spark, d), scratch_path(spark, "incremental-history")
    for until in (FOLD_CUTOFFS[0], FOLD_CUTOFFS[2]):
        history_store.update(spark, log.where(F.col(LOADED_AT) < _at(until)), path)
    last = history_store.update(spark, log, path)
    return history_store.read_history(spark, path, last.state)


def _runs(spark, d, path, then=lambda: None):
    """The stored history brought up to the log as it stood at three times; ``then`` follows each run."""
    log = _log(spark, d)
    for until in (FOLD_CUTOFFS[0], FOLD_CUTOFFS[2], None):
        history_store.update(spark, log if until is None else log.where(F.col(LOADED_AT) < _at(until)), path)
        done = then()
    return done


def q_incremental_monthly(spark, d):
    # The monthly report from totals that each run patches by the merge's changes.
    path = scratch_path(spark, "incremental-monthly")
    done = _runs(spark, d, f"{path}/history", lambda: incremental.update_totals(spark, f"{path}/history", f"{path}/t"))
    return kpi.report_of_totals(incremental.monthly_totals(incremental.read_totals(spark, f"{path}/t", done)))


def q_incremental_fact(spark, d):
    path, span = scratch_path(spark, "incremental-fact"), ("1990-01-01", "2010-01-01")
    done = _runs(spark, d, f"{path}/history", lambda: incremental.update_fact(spark, f"{path}/history", f"{path}/f", span))
    return incremental.read_fact(spark, f"{path}/f", done)


def q_incremental_late(spark, d):
    # Rows withheld until the last run are older than what is merged: their months are built again.
    log, path = _log(spark, d), scratch_path(spark, "incremental-late")
    withheld = (F.col("cpc_cents") == 7) & (F.month("campaigns_execution_date") == 5)
    history_store.update(spark, log.where((F.col(LOADED_AT) < _at(FOLD_CUTOFFS[1])) & ~withheld), path)
    last = history_store.update(spark, log, path)
    return history_store.read_history(spark, path, last.state)


def q_snapshot_merge_late_rows(spark, d):
    # The same late batch, merged: keys with late rows are built again, the others merged.
    log = _log(spark, d)
    old = log.where(F.col(LOADED_AT) < _at(MERGE_CUTOFF))
    batch = fixtures.without_some_load_times(log.where(F.col(LOADED_AT) >= _at(LATE_FROM)))
    before = _stored(history.history_from_log(old))
    return history.merge_or_rebuild(before, batch, old.unionByName(batch), _through(MERGE_CUTOFF))


def q_history_as_of_join(spark, d):
    # Every log row asks for its key's state at an instant near its load.
    log = _log(spark, d)
    probes = log.select(*KEY_COLS, F.col("clicks").alias("asked_by"),
                        (F.col(LOADED_AT) + F.make_dt_interval(F.col("registrations") % 13 - 4, F.lit(1))).alias("at"))
    return history.as_of_join(probes, history.history_from_log(log), "at", columns=["spend_cents", "valid_from"])


def q_report_reconciliation(spark, d):
    log = _log(spark, d)
    return kpi.reconciliation(log, history.history_from_log(log))


def q_load_quality(spark, d):
    # What each of two loads of dirty records observed of itself.
    path, log = scratch_path(spark, "dirty-landing"), scratch_path(spark, "dirty-log")
    fixtures.land_dirty(_log(spark, d), path)
    for i, target in enumerate(LOAD_TARGETS):
        load(spark, read_records(spark, path), log, target, loaded_at=BATCH_TS + timedelta(days=i))
    return read_quality(spark, log).drop("load")


def _drifting(spark, d):
    """Counters of a load a month, by the dirt of its records; every seventh load has three times the dirt."""
    log = _log(spark, d)
    sel, month = fixtures.dirt_selector(), F.trunc("campaigns_execution_date", "MM")
    per = log.groupBy(month.alias("m")).agg(F.count("*").alias("rows"), F.count_if(sel == 2).alias("n"))
    worse = F.when(F.month("m") % 7 == 0, 3 * F.col("n")).otherwise(F.col("n"))
    return per.select(F.col("m").cast("string").alias("load"), F.col("m").cast("timestamp_ntz").alias("loaded_at"),
                      F.lit("clicks").alias("column_name"), F.lit("non_numeric").alias("flag"),
                      worse.alias("failures"), "rows")


def q_quality_drift(spark, d):
    return quality.drift(_drifting(spark, d), window=12).select("load", "failures", "rows", "share", "baseline", "spread",
                                                               "drifted")


def _half_loaded(log):
    """The log without every third row of some dates and with other clicks on some others."""
    day = F.dayofmonth("campaigns_execution_date")
    log = log.where(~((day == 11) & (F.col("impressions") / 100 % 3 == 0)))
    return log.withColumn("clicks", F.when((day == 20) & (F.col("registrations") == 6), F.col("clicks") + 1)
                          .otherwise(F.col("clicks")))


def q_incomplete_dates(spark, d):
    log = _log(spark, d)
    return completeness.incomplete_dates(log, _half_loaded(log), MISSING_FROM, MISSING_TO)


def q_fill_incomplete(spark, d):
    # A log with half-loaded dates, completed from the landed records.
    path, log = scratch_path(spark, "half-loaded"), campaign_log_by_month(spark, d)
    append(log.where(~((F.dayofmonth("campaigns_execution_date") == 11) & (F.col("impressions") / 100 % 3 == 0))), path,
           moved=True)
    fill_incomplete(spark, read_records(spark, _landed(spark, d)), path, "1990-01-01", "2010-01-01", loaded_at=BATCH_TS)
    return read_log(spark, path).select(*NO_TS)


def q_high_water_mark_stored(spark, d):
    # Of a log in month folders, from the newest folder only.
    path = scratch_path(spark, "marked-log")
    append(_log(spark, d).select(*KEY_COLS, LOADED_AT), path)
    mark = windows.high_water_mark_value(spark, path)
    return spark.range(1).select(F.lit(mark).cast("date").alias("hwm"))


def q_history_null_load_time(spark, d):
    return history.history_from_log(fixtures.without_some_load_times(_log(spark, d)))


def q_history_split_null_load_time(spark, d):
    return history.history_from_log_split(fixtures.without_some_load_times(_log(spark, d)))


def q_history_precombined(spark, d):
    return history.history_from_log(_log(spark, d), precombine=True)


def q_history_check_cols(spark, d):
    # Another grain: one timeline per campaign and ad, a version per change of one column.
    return history.history_from_log(_log(spark, d), keys=("campaign_name", "ad_name"), check_cols=["payers_1d"])


def q_current_rows(spark, d):
    return history.current(_history(spark, d))


def q_history_as_of(spark, d):
    return history.as_of(_history(spark, d), AS_OF)


def q_staging(spark, d):
    return _stg(spark, d)


# Every key has one open version, so the names in staging are the names in the log:
# the dimensions need no history.
def q_dim_campaigns(spark, d):
    return star.dim_campaigns(_log(spark, d))


def q_dim_ads(spark, d):
    log = _log(spark, d)
    return star.dim_ads(log, star.dim_campaigns(log))


def _dates_span(spark, d):
    # Staging holds one current row per key of the log, so its dates are the
    # log's dates: take the calendar span from the log, not from a second
    # history build.
    return star.dim_dates_spanning(_log(spark, d), "campaigns_execution_date")


def q_dim_dates(spark, d):
    return _dates_span(spark, d)


def q_dim_dates_spine(spark, d):
    # The calendar of a date range, its end exclusive, against the dates of the log.
    spine = star.dim_dates(spark, SPINE_FROM, SPINE_TO)
    rows = _log(spark, d).groupBy(F.col("campaigns_execution_date").alias("date_key")).agg(F.count("*").alias("n"))
    return spine.join(rows, "date_key", "left").select(
        "date_key", "day_of_week", "month_name", "is_weekend", F.coalesce("n", F.lit(0)).alias("log_rows"))


def q_fact_daily(spark, d):
    return star.fact_daily(_stg(spark, d), dates=_dates_span(spark, d))


def q_fact_daily_joined(spark, d):
    # The same fact by its three joins.
    log = _log(spark, d)
    campaigns = star.dim_campaigns(log)
    return star.fact_daily(_stg(spark, d), _dates_span(spark, d), campaigns, star.dim_ads(log, campaigns))


def q_monthly_campaign_summary(spark, d):
    return _monthly(spark, d)


def q_rpt_monthly_campaign_summary(spark, d):
    return kpi.rpt_monthly_campaign_summary(_stg(spark, d))


def q_rpt_campaign_deep_dive(spark, d):
    return kpi.rpt_campaign_deep_dive(_stg(spark, d))


def q_monthly_from_log(spark, d):
    return kpi.monthly_from_log(_log(spark, d))


def q_month_report(spark, d):
    return kpi.month_report(_stg(spark, d), REPORT_MONTH)


def q_top_spend(spark, d):
    return kpi.top_spend(_monthly(spark, d), TOP_K)


# Each check runs on sound rows and on rows with faults, so that neither "always 0" nor
# "always some" would pass.
def q_check_not_null(spark, d):
    log, cols = _log(spark, d), ["campaigns_execution_date", "campaign_name"]
    return (checks.not_null(log, cols, "campaign_performance_raw_appends")
            .unionByName(checks.not_null(_monthly(spark, d), ["report_month", "campaign_name"],
                                         "monthly_campaign_summary"))
            .unionByName(checks.not_null(fixtures.without_some_campaigns(log), cols, "faulty_log")))


def q_check_expression(spark, d):
    m = _monthly(spark, d)
    return (checks.expression_is_true(m, "roas_3d", ">= 0", "monthly_campaign_summary")
            .unionByName(checks.expression_is_true(m, "cpi", ">= 0", "monthly_campaign_summary"))
            .unionByName(checks.expression_is_true(fixtures.with_negative_roas(m), "roas_3d", ">= 0",
                                                   "faulty_monthly")))


def q_check_unique(spark, d):
    log, stg = _log(spark, d), _stg(spark, d)
    return (checks.unique(log, list(KEY_COLS), "campaign_performance_raw_appends")
            .unionByName(checks.unique(stg, "campaign_performance_sk", "stg_campaign_performance"))
            .unionByName(checks.unique(star.dim_campaigns(log), "campaign_key", "dim_campaigns"))
            .unionByName(checks.unique(star.dim_ads(log), "ad_key", "dim_ads")))


def q_check_relationships(spark, d):
    log = _log(spark, d)
    dates = _dates_span(spark, d)
    fact = star.fact_daily(_stg(spark, d), dates=dates)
    parents = [("campaign_key", star.dim_campaigns(log), "campaign_key"), ("ad_key", star.dim_ads(log), "ad_key"),
               ("date_key", dates, "date_key")]
    return (checks.relationships_of(fact, parents, "fct_daily_performance")
            .unionByName(checks.relationships(fixtures.with_orphans(fact), *parents[0], "faulty_fact")))


def q_check_freshness(spark, d):
    return checks.freshness(_log(spark, d), "_etl_loaded_at", FRESHNESS_NOW, 24.0, 48.0,
                            "campaign_performance_raw_appends")


# --- ingest (nested records -> log) ----------------------------------------------
# A fixed batch load time, so results are reproducible; it is not part of the outputs.
BATCH_TS = datetime(2024, 1, 1)
NO_TS = [c for c in LOG_COLS if c != LOADED_AT]
MONEY_OUT = list(KEY_COLS) + ["cpc_cents"] + [lifeday_cols(ld)[3] for ld in LIFEDAYS]


def _clean(records, **kw):
    return ingest.clean(parse_records(records), loaded_at=BATCH_TS, **kw)


def q_ingest_roundtrip(spark, d):
    return _clean(to_records(_log(spark, d)))


def q_ingest_column_policy(spark, d):
    # One value with a fraction voids its column for the chunk, here a day of the log.
    records = parse_records(fixtures.dirty_records(_log(spark, d))).withColumn("day", F.col("date"))
    return ingest.clean(records, loaded_at=BATCH_TS, cast_failure="column", chunk_col="day").select(*NO_TS)


def q_append_roundtrip(spark, d):
    # The log table created, a batch and an empty one appended in month folders, and read back.
    path, log = scratch_path(spark, "append-roundtrip"), _log(spark, d)
    create_log_table(spark, path)
    append(log, path)
    append(log.where("spend_cents < 0"), path)
    return read_log(spark, path)


def _landed(spark, d, broken=None):
    path = scratch_path(spark, "landing")
    fixtures.land(campaign_log_by_month(spark, d), path, broken)
    return path


def q_load_job(spark, d):
    # Landed files, a first load (backfill) and a second one from the high-water mark on.
    landing, log = read_records(spark, _landed(spark, d)), scratch_path(spark, "loaded-log")
    for target in LOAD_TARGETS:
        load(spark, landing, log, target, loaded_at=BATCH_TS)
    return read_log(spark, log)


def q_stream_ingest(spark, d):
    # The same files through the file-source stream, every one once.
    log = scratch_path(spark, "streamed-log")
    start_ingest_stream(spark, _landed(spark, d), log).awaitTermination()
    return read_log(spark, log).select(*NO_TS)


def q_stream_outcomes(spark, d):
    # Files with cut-off lines through the stream: log and rejects together hold every record.
    log = scratch_path(spark, "streamed-outcomes")
    landing = _landed(spark, d, F.col("impressions") % 1700 == 0)
    start_ingest_stream(spark, landing, log, max_files_per_trigger=200).awaitTermination()
    return _outcomes(read_log(spark, log), spark.read.parquet(rejects_beside(log)))


def _outcomes(cleaned, rejected):
    both = cleaned.select(F.lit("cleaned").alias("outcome")).unionByName(
        rejected.select(F.col("reject_reason").alias("outcome")))
    return both.groupBy("outcome").agg(F.count("*").alias("n"))


def q_load_rejects(spark, d):
    # Three loads over the same files, the last two up to the same date: no record is rejected twice.
    landing = read_records(spark, _landed(spark, d, F.col("impressions") % 1700 == 0))
    log = scratch_path(spark, "load-rejects")
    for target in (*LOAD_TARGETS, LOAD_TARGETS[1]):
        load(spark, landing, log, target, loaded_at=BATCH_TS)
    return _outcomes(read_log(spark, log), spark.read.parquet(rejects_beside(log)))


def q_ingest_malformed(spark, d):
    # Files with lines that are cut off: each record is cleaned or rejected.
    records = read_records(spark, _landed(spark, d, F.col("impressions") % 1700 == 0))
    outcome = ingest.clean(records, loaded_at=BATCH_TS).select(F.lit("cleaned").alias("outcome")).unionByName(
        ingest.rejects(records).select(F.col("reject_reason").alias("outcome")))
    return outcome.groupBy("outcome").agg(F.count("*").alias("n"))


def q_layer_checks(spark, d):
    # Every layer built behind its gate; what the gates saw.
    layers = build_layers(_log(spark, d), date_range=("1995-01-01", "2003-01-01"))
    results = [r.withColumn("stage", F.lit(stage)) for stage, r in layers.check_results.items()]
    return functools.reduce(DataFrame.unionByName, results)


def q_report_export(spark, d):
    # A report file run against a registered view, exported as CSV and read back.
    out, folder = scratch_path(spark, "reports"), os.path.join(os.path.dirname(os.path.dirname(__file__)), "reports")
    reports = run_sql_reports(spark, folder, {"monthly_campaign_summary": _monthly(spark, d)})
    written = export_reports({"spend_change": reports["spend_change"]}, out, datetime(2024, 11, 1))
    return spark.read.option("header", True).schema(
        "campaign_name string, report_month date, total_spend double, spend_change double").csv(written["spend_change"])


def q_ingest_dirty_clean(spark, d):
    return _clean(fixtures.dirty_records(_log(spark, d))).select(*NO_TS)


def q_lifeday_unpivot_pivot(spark, d):
    return _clean(fixtures.scrambled_lifeday_records(_log(spark, d))).select(*KEY_COLS, *LIFEDAY_COLS)


def q_money_to_cents(spark, d):
    return _clean(fixtures.sub_cent_records(_log(spark, d))).select(*MONEY_OUT)


def q_money_half_up(spark, d):
    return _clean(fixtures.sub_cent_records(_log(spark, d)), rounding="half_up").select(*MONEY_OUT)


def q_money_cost_currency(spark, d):
    # A source whose cost is in currency units, beside one whose cost is in cents (the default).
    records = fixtures.cost_in_currency_records(_log(spark, d))
    return _clean(records, cost_unit="currency", rounding="half_up").select(*KEY_COLS, "spend_cents", "impressions")


def q_quality_counts(spark, d):
    return ingest.quality_counts(parse_records(fixtures.dirty_records(_log(spark, d))))


def q_ingest_rejects(spark, d):
    r = ingest.rejects(parse_records(fixtures.bad_date_records(_log(spark, d))))
    return r.select("campaign", "date", "reject_reason")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ingest_roundtrip": q_ingest_roundtrip,
    "ingest_dirty_clean": q_ingest_dirty_clean,
    "ingest_column_policy": q_ingest_column_policy,
    "append_roundtrip": q_append_roundtrip,
    "load_job": q_load_job,
    "stream_ingest": q_stream_ingest,
    "ingest_malformed": q_ingest_malformed,
    "layer_checks": q_layer_checks,
    "report_export": q_report_export,
    "lifeday_unpivot_pivot": q_lifeday_unpivot_pivot,
    "money_to_cents": q_money_to_cents,
    "money_half_up": q_money_half_up,
    "money_cost_currency": q_money_cost_currency,
    "quality_counts": q_quality_counts,
    "ingest_rejects": q_ingest_rejects,
    "high_water_mark": q_high_water_mark,
    "backfill_windows": q_backfill_windows,
    "incremental_windows": q_incremental_windows,
    "plan_from_log": q_plan_from_log,
    "gap_windows": q_gap_windows,
    "select_windows": q_select_windows,
    "period_scan": q_period_scan,
    "missing_dates": q_missing_dates,
    "latest_per_key": q_latest_per_key,
    "history_from_log": q_history_from_log,
    "history_split_by_day": q_history_split_by_day,
    "history_include_load_ts": q_history_include_load_ts,
    "history_precombined": q_history_precombined,
    "history_null_load_time": q_history_null_load_time,
    "history_split_null_load_time": q_history_split_null_load_time,
    "history_check_cols": q_history_check_cols,
    "snapshot_merge": q_snapshot_merge,
    "snapshot_merge_fold": q_snapshot_merge_fold,
    "snapshot_merge_late": q_snapshot_merge_late,
    "snapshot_merge_late_rows": q_snapshot_merge_late_rows,
    "incremental_history": q_incremental_history,
    "incremental_late": q_incremental_late,
    "incremental_monthly": q_incremental_monthly,
    "incremental_fact": q_incremental_fact,
    "history_as_of_join": q_history_as_of_join,
    "report_reconciliation": q_report_reconciliation,
    "incomplete_dates": q_incomplete_dates,
    "fill_incomplete": q_fill_incomplete,
    "high_water_mark_stored": q_high_water_mark_stored,
    "load_quality": q_load_quality,
    "quality_drift": q_quality_drift,
    "stream_outcomes": q_stream_outcomes,
    "load_rejects": q_load_rejects,
    "current_rows": q_current_rows,
    "history_as_of": q_history_as_of,
    "staging": q_staging,
    "dim_campaigns": q_dim_campaigns,
    "dim_ads": q_dim_ads,
    "dim_dates": q_dim_dates,
    "dim_dates_spine": q_dim_dates_spine,
    "fact_daily": q_fact_daily,
    "fact_daily_joined": q_fact_daily_joined,
    "monthly_campaign_summary": q_monthly_campaign_summary,
    "rpt_monthly_campaign_summary": q_rpt_monthly_campaign_summary,
    "rpt_campaign_deep_dive": q_rpt_campaign_deep_dive,
    "monthly_from_log": q_monthly_from_log,
    "month_report": q_month_report,
    "top_spend": q_top_spend,
    "check_not_null": q_check_not_null,
    "check_expression": q_check_expression,
    "check_unique": q_check_unique,
    "check_relationships": q_check_relationships,
    "check_freshness": q_check_freshness,
}


# ================================ SQL oracle =====================================

KEYS_SQL = ", ".join(KEY_COLS)

LOG_SQL = """log AS (
  SELECT
    CAST(l.l_shipdate AS DATE) AS campaigns_execution_date,
    p.p_brand AS campaign_name,
    CASE WHEN p.p_type = 'ECONOMY' THEN 'N/A' ELSE p.p_type END AS ad_name,
    CASE WHEN l.l_partkey % 13 = 0 THEN CAST(0 AS BIGINT)
         ELSE CAST(ROUND(l.l_extendedprice * 100) AS BIGINT) END AS spend_cents,
    CAST(l.l_quantity AS BIGINT) * 100 AS impressions,
    CAST(l.l_quantity AS BIGINT) * (l.l_partkey % 7) AS clicks,
    (l.l_orderkey % 11) * (l.l_suppkey % 4) AS registrations,
    l.l_discount AS ctr,
    l.l_tax AS cr,
    l.l_partkey % 500 AS cpc_cents,
    l.l_orderkey % 3 AS players_1d,  l.l_suppkey % 2 AS payers_1d,
    l.l_orderkey % 5 AS payments_1d, (l.l_orderkey % 97) * 13 AS revenue_1d_cents,
    l.l_orderkey % 5 AS players_3d,  l.l_suppkey % 3 AS payers_3d,
    l.l_orderkey % 7 AS payments_3d, (l.l_orderkey % 97) * 29 AS revenue_3d_cents,
    l.l_orderkey % 7 AS players_7d,  l.l_suppkey % 4 AS payers_7d,
    l.l_orderkey % 9 AS payments_7d, (l.l_orderkey % 97) * 61 AS revenue_7d_cents,
    l.l_orderkey % 9 AS players_14d, l.l_suppkey % 5 AS payers_14d,
    l.l_orderkey % 11 AS payments_14d, (l.l_orderkey % 97) * 101 AS revenue_14d_cents,
    CAST(CAST(l.l_shipdate AS DATE) + CAST(1 + l.l_suppkey % 5 + again.days AS INT) AS TIMESTAMP) AS _etl_loaded_at
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  JOIN (VALUES (0), (7)) AS again(days) ON again.days = 0 OR l.l_orderkey % 4 = 0
)"""

NULL_TIMES_SQL = f"""null_times AS (
  SELECT * REPLACE (CASE WHEN registrations % 5 <> 0 THEN _etl_loaded_at END AS _etl_loaded_at) FROM log
)"""


def _history_sql(src: str, name: str = "history", every_sighting: bool = False, keys=KEY_COLS,
                 checked=SORTED_METRIC_COLS) -> str:
    """CTEs turning log-shaped relation ``src`` into a type-2 history named ``name``."""
    rest = [c for c in KEY_COLS if c not in keys]
    tiebreak = ", ".join(f"{c} DESC" for c in [*SORTED_METRIC_COLS, *rest])
    changed = "TRUE" if every_sighting else " OR ".join(
        f"(lag({c}) OVER w IS DISTINCT FROM {c})" for c in checked)
    cols = ", ".join(LOG_COLS)
    KEYS_SQL = ", ".join(keys)
    texts = ", ".join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in keys)
    version = (f"concat_ws('-', {texts}) || '|' || coalesce(CAST(_etl_loaded_at AS VARCHAR), '')"
               if len(keys) == 3 else f"concat_ws('|', {texts}, CAST(_etl_loaded_at AS VARCHAR))")
    return f"""{name}_s AS (
  SELECT {cols} FROM (
    SELECT *, row_number() OVER (PARTITION BY {KEYS_SQL}, _etl_loaded_at ORDER BY {tiebreak}) AS rn
    FROM {src}) WHERE rn = 1
),
{name}_f AS (
  SELECT *, (row_number() OVER w = 1 OR {changed}) AS changed
  FROM {name}_s WINDOW w AS (PARTITION BY {KEYS_SQL} ORDER BY _etl_loaded_at NULLS FIRST)
),
{name} AS (
  SELECT {cols}, _etl_loaded_at AS valid_from,
    lead(_etl_loaded_at) OVER (PARTITION BY {KEYS_SQL} ORDER BY _etl_loaded_at NULLS FIRST) AS valid_to,
    md5({version}) AS scd_id
  FROM {name}_f WHERE changed
)"""


def _eur(c: str) -> str:
    return f"CAST({c} AS DOUBLE) / CAST(100 AS DOUBLE)"


def _staging_select() -> str:
    life = []
    for ld in LIFEDAYS:
        players, payers, payments, revenue = lifeday_cols(ld)
        life.append(f"{players}, {payers}, {payments}, {_eur(revenue)} AS {staging_lifeday_cols(ld)[3]}")
    return f"""stg AS (
  SELECT md5(CAST(campaigns_execution_date AS VARCHAR) || '-' || campaign_name || '-' || ad_name)
           AS campaign_performance_sk,
    campaigns_execution_date AS report_date, campaign_name, ad_name,
    {_eur('spend_cents')} AS spend_eur, impressions, clicks, registrations,
    {_eur('cpc_cents')} AS cpc_eur, ctr, cr,
    {', '.join(life)},
    valid_from AS valid_from_timestamp, _etl_loaded_at AS updated_at_timestamp
  FROM history WHERE valid_to IS NULL
)"""


def _sum_eur(c: str) -> str:
    return f"CAST(SUM(CAST(round({c} * 100.0) AS BIGINT)) AS DOUBLE) / CAST(100 AS DOUBLE)"


def _div_null(n: str, d: str) -> str:
    return f"CAST({n} AS DOUBLE) / NULLIF(CAST({d} AS DOUBLE), 0)"


def _div_zero(n: str, d: str) -> str:
    return f"CASE WHEN {d} > 0 THEN CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"


def _monthly_totals_sql(name: str = "mtot") -> str:
    life = []
    for ld in LIFEDAYS:
        life.append(f"{_sum_eur(f'revenue_{ld}d_eur')} AS total_revenue_{ld}d, "
                    f"CAST(SUM(payers_{ld}d) AS BIGINT) AS total_payers_{ld}d, "
                    f"CAST(SUM(players_{ld}d) AS BIGINT) AS total_players_{ld}d")
    return f"""{name} AS (
  SELECT CAST(date_trunc('month', report_date) AS DATE) AS report_month, campaign_name,
    {_sum_eur('spend_eur')} AS total_spend,
    CAST(SUM(impressions) AS BIGINT) AS total_impressions,
    CAST(SUM(clicks) AS BIGINT) AS total_clicks,
    CAST(SUM(registrations) AS BIGINT) AS total_registrations,
    {', '.join(life)}
  FROM stg GROUP BY 1, 2
)"""


BASE = ("report_month, campaign_name, total_spend, total_impressions, total_clicks, "
        "total_registrations, total_payers_14d, total_revenue_14d")

MONTHLY_SQL = f"""monthly AS (
  SELECT {BASE},
    {_div_null('total_revenue_3d', 'total_spend')} AS roas_3d,
    {_div_null('total_spend', 'total_registrations')} AS cpi,
    {_div_null('total_spend', 'total_payers_14d')} AS cpp_14d,
    {_div_null('total_players_14d', 'total_registrations')} AS retention_rate_14d
  FROM mtot
)"""

CHAIN = ",\n".join([LOG_SQL, _history_sql("log"), _staging_select(), _monthly_totals_sql(), MONTHLY_SQL])


def _with(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _dates_sql(name: str = "dates") -> str:
    return f"""{name}_span AS (
  SELECT CAST(date_trunc('month', min(report_date)) AS DATE) AS lo, max(report_date) AS hi FROM stg
),
{name} AS (
  SELECT CAST(d AS DATE) AS date_key,
    CAST(extract(year FROM d) AS INTEGER) AS year,
    CAST(extract(month FROM d) AS INTEGER) AS month,
    CAST(extract(day FROM d) AS INTEGER) AS day,
    CAST(extract(dow FROM d) AS INTEGER) AS day_of_week,
    CAST(extract(doy FROM d) AS INTEGER) AS day_of_year,
    CAST(extract(quarter FROM d) AS INTEGER) AS quarter_of_year,
    strftime(d, '%B') AS month_name, strftime(d, '%b') AS month_name_short,
    strftime(d, '%A') AS day_name, strftime(d, '%a') AS day_name_short,
    extract(dow FROM d) IN (0, 6) AS is_weekend
  FROM {name}_span, generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY) AS g(d)
)"""


DIMS_SQL = """dim_campaigns AS (
  SELECT md5(campaign_name) AS campaign_key, campaign_name
  FROM (SELECT DISTINCT campaign_name FROM stg WHERE campaign_name IS NOT NULL)
),
dim_ads AS (
  SELECT md5(a.campaign_name || '-' || a.ad_name) AS ad_key, c.campaign_key AS campaign_fk,
         a.ad_name, a.campaign_name
  FROM (SELECT DISTINCT campaign_name, ad_name FROM stg WHERE ad_name IS NOT NULL AND ad_name != 'N/A') a
  LEFT JOIN dim_campaigns c ON a.campaign_name = c.campaign_name
)"""


def _fact_sql() -> str:
    measures = ["spend_eur", "impressions", "clicks", "registrations", "cpc_eur", "ctr", "cr"]
    measures += [c for ld in LIFEDAYS for c in staging_lifeday_cols(ld)]
    m = ", ".join(f"s.{c}" for c in measures)
    return f"""fact AS (
  SELECT s.campaign_performance_sk AS daily_performance_sk, dd.date_key, dc.campaign_key, da.ad_key,
    s.campaign_name, s.ad_name, {m}, s.valid_from_timestamp, s.updated_at_timestamp
  FROM stg s
  LEFT JOIN dates dd ON s.report_date = dd.date_key
  LEFT JOIN dim_campaigns dc ON s.campaign_name = dc.campaign_name
  LEFT JOIN dim_ads da ON s.campaign_name = da.campaign_name AND s.ad_name = da.ad_name
)"""


def _windows_sql(bounds: str, newest_first: bool) -> str:
    """Month chunks of each (lo, hi) row of relation ``bounds``."""
    order = "m DESC" if newest_first else "m"
    return f"""SELECT CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS chunk,
    CAST(greatest(m, lo) AS DATE) AS window_start, CAST(least(last_day(m), hi) AS DATE) AS window_end
  FROM (SELECT lo, hi, CAST(g.m AS DATE) AS m FROM {bounds},
        generate_series(CAST(date_trunc('month', lo) AS TIMESTAMP), CAST(date_trunc('month', hi) AS TIMESTAMP),
                        INTERVAL 1 MONTH) AS g(m)
        WHERE lo <= hi)"""


INC_BOUNDS = f"""inc_bounds AS (
  SELECT CAST(max(CASE WHEN _etl_loaded_at < TIMESTAMP '{LOAD_STATE}' THEN campaigns_execution_date END)
              + INTERVAL 1 DAY AS DATE) AS lo,
         max(campaigns_execution_date) AS hi FROM log
),
inc AS ({_windows_sql('inc_bounds', False)})"""


def _not_null_sql(rel: str, model: str, cols) -> list[str]:
    return [f"SELECT 'not_null' AS check_name, '{model}' AS model_name, '{c}' AS column_name, "
            f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures FROM {rel}" for c in cols]


def _expr_sql(rel: str, model: str, col: str, expr: str) -> str:
    return (f"SELECT 'expression_is_true {expr}' AS check_name, '{model}' AS model_name, "
            f"'{col}' AS column_name, CAST(count(*) FILTER (WHERE NOT ({col} {expr})) AS BIGINT) AS failures "
            f"FROM {rel}")


def _unique_sql(rel: str, model: str, cols) -> str:
    cl = ", ".join(cols)
    where = f"WHERE {cols[0]} IS NOT NULL" if len(cols) == 1 else ""
    return (f"SELECT 'unique' AS check_name, '{model}' AS model_name, '{'|'.join(cols)}' AS column_name, "
            f"CAST(count(*) AS BIGINT) AS failures FROM "
            f"(SELECT {cl} FROM {rel} {where} GROUP BY {cl} HAVING count(*) > 1)")


def _rel_sql(child: str, fk: str, parent: str, pk: str, model: str) -> str:
    return (f"SELECT 'relationships' AS check_name, '{model}' AS model_name, '{fk}' AS column_name, "
            f"CAST(count(*) AS BIGINT) AS failures FROM {child} c "
            f"WHERE c.{fk} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pk} = c.{fk})")


def _oracles() -> dict[str, str]:
    o: dict[str, str] = {}
    o["high_water_mark"] = _with("SELECT max(campaigns_execution_date) AS hwm FROM log", LOG_SQL)
    o["backfill_windows"] = _with(
        _windows_sql("bf_bounds", True), LOG_SQL,
        "bf_bounds AS (SELECT CAST(max(campaigns_execution_date) - INTERVAL 1826 DAY AS DATE) AS lo, "
        "max(campaigns_execution_date) AS hi FROM log)")
    o["incremental_windows"] = _with("SELECT * FROM inc", LOG_SQL, INC_BOUNDS)
    plan_target = f"DATE '{PLAN_TARGET}'"
    o["plan_from_log"] = _with(
        f"SELECT *, 'incremental' AS mode FROM ({_windows_sql('after_log', False)}) UNION ALL "
        f"SELECT *, 'backfill' AS mode FROM ({_windows_sql('no_log', True)})", LOG_SQL,
        f"after_log AS (SELECT CAST(max(campaigns_execution_date) + INTERVAL 1 DAY AS DATE) AS lo, {plan_target} AS hi "
        "FROM log)", f"no_log AS (SELECT CAST({plan_target} - INTERVAL 1826 DAY AS DATE) AS lo, {plan_target} AS hi)")
    o["select_windows"] = _with(
        "SELECT w.chunk, w.window_start, w.window_end, l.campaigns_execution_date, l.campaign_name, "
        "l.ad_name, l.spend_cents, l._etl_loaded_at FROM log l JOIN inc w "
        "ON l.campaigns_execution_date BETWEEN w.window_start AND w.window_end", LOG_SQL, INC_BOUNDS)
    o["period_scan"] = _with(
        f"SELECT * FROM log WHERE campaigns_execution_date BETWEEN DATE '{PERIOD_FROM}' AND DATE '{PERIOD_TO}'",
        LOG_SQL)
    o["missing_dates"] = _with(
        f"SELECT CAST(g.d AS DATE) AS missing_date FROM generate_series(TIMESTAMP '{MISSING_FROM}', "
        f"TIMESTAMP '{MISSING_TO}', INTERVAL 1 DAY) AS g(d) WHERE CAST(g.d AS DATE) NOT IN "
        f"(SELECT campaigns_execution_date FROM log WHERE campaigns_execution_date IS NOT NULL)", LOG_SQL)
    o["gap_windows"] = (
        "SELECT CAST(row_number() OVER (ORDER BY min(d)) AS INTEGER) AS chunk, min(d) AS window_start, "
        "max(d) AS window_end FROM (SELECT missing_date AS d, date_trunc('month', missing_date) AS m, "
        "missing_date - CAST(row_number() OVER (PARTITION BY date_trunc('month', missing_date) ORDER BY missing_date) "
        f"AS INTEGER) AS run FROM ({o['missing_dates']})) GROUP BY m, run")
    tiebreak = ", ".join(f"{c} DESC" for c in SORTED_METRIC_COLS)
    o["latest_per_key"] = _with(
        f"SELECT {', '.join(LOG_COLS)} FROM (SELECT *, row_number() OVER (PARTITION BY {KEYS_SQL} "
        f"ORDER BY _etl_loaded_at DESC, {tiebreak}) AS rn FROM log) WHERE rn = 1", LOG_SQL)
    o["history_from_log"] = _with("SELECT * FROM history", LOG_SQL, _history_sql("log"))
    o["history_include_load_ts"] = _with("SELECT * FROM history", LOG_SQL,
                                         _history_sql("log", every_sighting=True))
    # Merges, stored runs and the other plans must equal the full rebuild over the whole log.
    for same in ("snapshot_merge", "snapshot_merge_fold", "incremental_history", "incremental_late", "history_split_by_day",
                 "history_precombined"):
        o[same] = o["history_from_log"]
    o["history_null_load_time"] = _with("SELECT * FROM history", LOG_SQL, NULL_TIMES_SQL, _history_sql("null_times"))
    o["history_split_null_load_time"] = o["history_null_load_time"]
    o["history_check_cols"] = _with("SELECT * FROM history", LOG_SQL, _history_sql(
        "log", keys=("campaign_name", "ad_name"), checked=("payers_1d",)))
    o["snapshot_merge_late"] = _with(
        f"SELECT {KEYS_SQL}, spend_cents, _etl_loaded_at FROM (SELECT n.* FROM null_times n) "
        f"WHERE _etl_loaded_at IS NULL OR _etl_loaded_at < TIMESTAMP '{MERGE_CUTOFF}'",
        LOG_SQL.replace("log AS (", "whole_log AS (", 1),
        f"log AS (SELECT * FROM whole_log WHERE _etl_loaded_at >= TIMESTAMP '{LATE_FROM}')", NULL_TIMES_SQL)
    o["snapshot_merge_late_rows"] = _with(
        "SELECT * FROM history", LOG_SQL.replace("log AS (", "whole_log AS (", 1),
        f"log AS (SELECT * FROM whole_log WHERE _etl_loaded_at >= TIMESTAMP '{LATE_FROM}')", NULL_TIMES_SQL,
        f"late_log AS (SELECT * FROM whole_log WHERE _etl_loaded_at < TIMESTAMP '{MERGE_CUTOFF}' "
        "UNION ALL SELECT * FROM null_times)", _history_sql("late_log"))
    on_key = " AND ".join(f"p.{k} IS NOT DISTINCT FROM h.{k}" for k in KEY_COLS)
    o["history_as_of_join"] = _with(
        f"SELECT p.*, h.spend_cents, h.valid_from FROM probes p LEFT JOIN history h ON {on_key} "
        "AND h.valid_from <= p.at AND (h.valid_to IS NULL OR h.valid_to > p.at)", LOG_SQL, _history_sql("log"),
        f"probes AS (SELECT {KEYS_SQL}, clicks AS asked_by, _etl_loaded_at + to_days(CAST(registrations % 13 - 4 AS "
        "INTEGER)) + INTERVAL 1 HOUR AS at FROM log)")
    month = "CAST(date_trunc('month', campaigns_execution_date) AS DATE) AS report_month"
    totals, shown = [], []
    for c in kpi.RECONCILED:
        totals += [f"(SELECT CAST(sum({c}) AS BIGINT) FROM {rel} x WHERE x.report_month = g.report_month "
                   f"AND x.campaign_name = g.campaign_name{cond}) AS {c}_{name}"
                   for name, rel, cond in (("l", "lm", ""), ("c", "hm", " AND valid_to IS NULL"),
                                           ("o", "hm", " AND valid_to IS NOT NULL"), ("r", "rm", ""))]
        differ = f"{c}_l - {c}_c"
        shown.append(f"{c}_l AS {c}_log, {c}_c AS {c}_current, {differ} AS {c}_difference, coalesce({c}_o, 0) AS "
                     f"{c}_closed, coalesce({c}_r, 0) AS {c}_repeated, {differ} - coalesce({c}_o, 0) - "
                     f"coalesce({c}_r, 0) AS {c}_unexplained")
    o["report_reconciliation"] = _with(
        f"SELECT report_month, campaign_name, {', '.join(shown)} FROM (SELECT g.*, {', '.join(totals)} FROM "
        "(SELECT DISTINCT report_month, campaign_name FROM lm) g)", LOG_SQL, _history_sql("log"),
        f"lm AS (SELECT *, {month} FROM log)",
        f"hm AS (SELECT *, {month} FROM history)",
        # Rows of the log beyond one for each version.
        f"rm AS (SELECT *, {month} FROM (SELECT {', '.join(LOG_COLS)} FROM log EXCEPT ALL "
        f"SELECT {', '.join(LOG_COLS)} FROM history))")
    half = ("half AS (SELECT * REPLACE (CASE WHEN extract(day FROM campaigns_execution_date) = 20 AND registrations = 6 "
            "THEN clicks + 1 ELSE clicks END AS clicks) FROM log WHERE NOT (extract(day FROM campaigns_execution_date) "
            "= 11 AND (impressions / 100) % 3 = 0))")
    rows = ", ".join(c for c in LOG_COLS if c != LOADED_AT)
    o["incomplete_dates"] = _with(
        "SELECT d AS date, (SELECT count(*) FROM log WHERE campaigns_execution_date = d) AS landed_rows, "
        "(SELECT count(*) FROM half WHERE campaigns_execution_date = d) AS log_rows FROM (SELECT DISTINCT "
        f"campaigns_execution_date AS d FROM ((SELECT {rows} FROM log EXCEPT ALL SELECT {rows} FROM half) UNION ALL "
        f"(SELECT {rows} FROM half EXCEPT ALL SELECT {rows} FROM log))) WHERE d BETWEEN DATE '{MISSING_FROM}' AND "
        f"DATE '{MISSING_TO}'", LOG_SQL, half)
    o["fill_incomplete"] = _with(f"SELECT {rows} FROM log", LOG_SQL)
    o["high_water_mark_stored"] = o["high_water_mark"]
    o["current_rows"] = _with("SELECT * FROM history WHERE valid_to IS NULL", LOG_SQL, _history_sql("log"))
    o["history_as_of"] = _with(
        f"SELECT * FROM history WHERE valid_from <= TIMESTAMP '{AS_OF}' "
        f"AND (valid_to IS NULL OR valid_to > TIMESTAMP '{AS_OF}')", LOG_SQL, _history_sql("log"))
    o["staging"] = _with("SELECT * FROM stg", CHAIN)
    o["dim_campaigns"] = _with("SELECT * FROM dim_campaigns", CHAIN, DIMS_SQL)
    o["dim_ads"] = _with("SELECT * FROM dim_ads", CHAIN, DIMS_SQL)
    o["dim_dates"] = _with("SELECT * FROM dates", CHAIN, _dates_sql())
    o["dim_dates_spine"] = _with(
        "SELECT CAST(d AS DATE) AS date_key, CAST(extract(dow FROM d) AS INTEGER) AS day_of_week, "
        "strftime(d, '%B') AS month_name, extract(dow FROM d) IN (0, 6) AS is_weekend, "
        "(SELECT count(*) FROM log WHERE campaigns_execution_date = CAST(d AS DATE)) AS log_rows "
        f"FROM range(TIMESTAMP '{SPINE_FROM}', TIMESTAMP '{SPINE_TO}', INTERVAL 1 DAY) AS g(d)", LOG_SQL)
    o["fact_daily"] = _with("SELECT * FROM fact", CHAIN, DIMS_SQL, _dates_sql(), _fact_sql())
    o["fact_daily_joined"] = o["incremental_fact"] = o["fact_daily"]
    o["monthly_campaign_summary"] = _with("SELECT * FROM monthly", CHAIN)
    cpp = ", ".join(f"{_div_null('total_spend', f'total_payers_{ld}d')} AS cpp_{ld}d" for ld in LIFEDAYS)
    ret = ", ".join(f"{_div_null(f'total_players_{ld}d', 'total_registrations')} AS retention_rate_{ld}d"
                    for ld in LIFEDAYS)
    o["rpt_monthly_campaign_summary"] = _with(
        f"SELECT {BASE}, {_div_null('total_revenue_3d', 'total_spend')} AS roas_3d, "
        f"{_div_null('total_spend', 'total_registrations')} AS cpi, {cpp}, {ret} FROM mtot "
        f"ORDER BY report_month, campaign_name", CHAIN)
    o["incremental_monthly"] = o["rpt_monthly_campaign_summary"]
    o["rpt_campaign_deep_dive"] = _with(
        "SELECT report_date, campaign_name, ad_name, spend_eur, impressions, clicks, registrations, "
        "revenue_7d_eur, payers_7d, players_7d, payments_7d, "
        f"{_div_null('revenue_7d_eur', 'spend_eur')} AS roas_7d, "
        f"{_div_null('spend_eur', 'payers_7d')} AS cpp_7d_eur, "
        f"{_div_null('spend_eur', 'players_7d')} AS cpl_7d_eur, "
        f"{_div_null('revenue_7d_eur', 'registrations')} AS ltv_7d_eur, "
        f"{_div_null('revenue_7d_eur', 'payers_7d')} AS arppu_7d_eur, "
        f"{_div_null('players_7d', 'registrations')} AS retention_rate_7d, "
        f"{_div_null('payers_7d', 'registrations')} AS payer_conversion_rate_7d FROM stg", CHAIN)
    sums = ", ".join(
        f"CAST(SUM(revenue_{ld}d_cents) AS BIGINT) AS total_revenue_{ld}d_cents, "
        f"CAST(SUM(payers_{ld}d) AS BIGINT) AS total_payers_{ld}d, "
        f"CAST(SUM(players_{ld}d) AS BIGINT) AS total_players_{ld}d" for ld in LIFEDAYS)
    cppc = ", ".join(f"{_div_zero('total_spend_cents', f'total_payers_{ld}d')} AS cpp_{ld}d_cents"
                     for ld in LIFEDAYS)
    retz = ", ".join(f"{_div_zero(f'total_players_{ld}d', 'total_registrations')} AS retention_rate_{ld}d"
                     for ld in LIFEDAYS)
    o["monthly_from_log"] = _with(
        "SELECT report_month, campaign_name, total_spend_cents, total_impressions, total_clicks, "
        "total_registrations, total_payers_14d, total_revenue_14d_cents, "
        f"{_div_zero('total_revenue_3d_cents', 'total_spend_cents')} AS roas_3d, "
        f"{_div_zero('total_spend_cents', 'total_registrations')} AS cpi_cents, {cppc}, {retz} "
        "FROM lm ORDER BY report_month, campaign_name", LOG_SQL,
        "lm AS (SELECT CAST(date_trunc('month', campaigns_execution_date) AS DATE) AS report_month, "
        "campaign_name, CAST(SUM(spend_cents) AS BIGINT) AS total_spend_cents, "
        "CAST(SUM(impressions) AS BIGINT) AS total_impressions, CAST(SUM(clicks) AS BIGINT) AS total_clicks, "
        f"CAST(SUM(registrations) AS BIGINT) AS total_registrations, {sums} FROM log GROUP BY 1, 2)")
    o["month_report"] = _with(
        f"SELECT {BASE} FROM monthly WHERE report_month = DATE '{REPORT_MONTH}' ORDER BY campaign_name", CHAIN)
    o["top_spend"] = _with(
        f"SELECT * FROM monthly ORDER BY report_month DESC, total_spend DESC, campaign_name ASC LIMIT {TOP_K}",
        CHAIN)
    o["check_not_null"] = _with(" UNION ALL ".join(
        _not_null_sql("log", "campaign_performance_raw_appends", ["campaigns_execution_date", "campaign_name"])
        + _not_null_sql("monthly", "monthly_campaign_summary", ["report_month", "campaign_name"])
        + _not_null_sql("(SELECT * REPLACE (CASE WHEN registrations % 7 <> 3 THEN campaign_name END AS campaign_name) "
                        "FROM log)", "faulty_log", ["campaigns_execution_date", "campaign_name"])), CHAIN)
    o["check_expression"] = _with(
        _expr_sql("monthly", "monthly_campaign_summary", "roas_3d", ">= 0") + " UNION ALL "
        + _expr_sql("monthly", "monthly_campaign_summary", "cpi", ">= 0") + " UNION ALL "
        + _expr_sql("(SELECT * REPLACE (CASE WHEN total_clicks % 2 = 0 THEN -roas_3d ELSE roas_3d END AS roas_3d) "
                    "FROM monthly)", "faulty_monthly", "roas_3d", ">= 0"), CHAIN)
    o["check_unique"] = _with(" UNION ALL ".join([
        _unique_sql("log", "campaign_performance_raw_appends", list(KEY_COLS)),
        _unique_sql("stg", "stg_campaign_performance", ["campaign_performance_sk"]),
        _unique_sql("dim_campaigns", "dim_campaigns", ["campaign_key"]),
        _unique_sql("dim_ads", "dim_ads", ["ad_key"])]), CHAIN, DIMS_SQL)
    o["check_relationships"] = _with(" UNION ALL ".join([
        _rel_sql("fact", "campaign_key", "dim_campaigns", "campaign_key", "fct_daily_performance"),
        _rel_sql("fact", "ad_key", "dim_ads", "ad_key", "fct_daily_performance"),
        _rel_sql("fact", "date_key", "dates", "date_key", "fct_daily_performance"),
        _rel_sql("(SELECT * REPLACE (CASE WHEN impressions % 300 = 0 THEN 'orphan' ELSE campaign_key END "
                 "AS campaign_key) FROM fact)", "campaign_key", "dim_campaigns", "campaign_key", "faulty_fact")]),
        CHAIN, DIMS_SQL, _dates_sql(), _fact_sql())
    o["check_freshness"] = _with(
        "SELECT 'freshness' AS check_name, 'campaign_performance_raw_appends' AS model_name, "
        "'_etl_loaded_at' AS column_name, max_loaded_at, age_hours, "
        "CASE WHEN max_loaded_at IS NULL OR age_hours > 48.0 THEN 'error' "
        "WHEN age_hours > 24.0 THEN 'warn' ELSE 'pass' END AS status, "
        "CAST(CASE WHEN max_loaded_at IS NULL OR age_hours > 48.0 THEN 1 ELSE 0 END AS BIGINT) AS failures "
        f"FROM (SELECT m AS max_loaded_at, CAST(date_diff('microsecond', m, TIMESTAMP '{FRESHNESS_NOW}') AS DOUBLE)"
        " / 3600000000.0 AS age_hours FROM (SELECT max(_etl_loaded_at) AS m FROM log))", LOG_SQL)
    return o


# Expected clean values of dirty_records(): selector = cpc_cents % 10 on the log row.
SEL = "(cpc_cents % 10)"
DIRTY_EXPECT = {
    "ad_name": f"CASE WHEN {SEL} IN (4, 9) THEN 'N/A' ELSE ad_name END",
    "spend_cents": f"CASE WHEN {SEL} IN (4, 9) THEN CAST(0 AS BIGINT) ELSE spend_cents END",
    "impressions": f"CASE WHEN {SEL} = 7 THEN CAST(0 AS BIGINT) ELSE impressions END",
    "clicks": f"CASE WHEN {SEL} IN (1, 2) THEN CAST(0 AS BIGINT) ELSE clicks END",
    "ctr": f"CASE WHEN {SEL} = 3 THEN CAST(0 AS DOUBLE) ELSE ctr END",
    "cpc_cents": f"CASE WHEN {SEL} = 6 THEN CAST(0 AS BIGINT) ELSE cpc_cents END",
    "revenue_1d_cents": f"CASE WHEN {SEL} IN (3, 5) THEN CAST(0 AS BIGINT) ELSE revenue_1d_cents END",
}
for _c in LIFEDAY_COLS:
    _zero = "(5, 9)" if _c.endswith(("_14d", "_14d_cents")) else "(5)"
    DIRTY_EXPECT.setdefault(_c, f"CASE WHEN {SEL} IN {_zero} THEN CAST(0 AS BIGINT) ELSE {_c} END")
# Quality counters the dirt must produce: column -> flag -> selector values.
DIRTY_FLAGS = {
    "clicks": {"negative": "(1)", "non_numeric": "(2)"},
    "ctr": {"non_finite": "(3)"},
    "revenue_1d_cents": {"non_finite": "(3)"},
    "cpc_cents": {"negative": "(6)"},
    "impressions": {"cast_failed": "(7)"},
}


def _half_up(c: str) -> str:
    return f"({c} + CASE WHEN {c} % 10 >= 5 THEN 1 ELSE 0 END)"


def _ingest_oracles() -> dict[str, str]:
    o: dict[str, str] = {}
    no_ts = ", ".join(c for c in LOG_COLS if c != LOADED_AT)
    o["ingest_roundtrip"] = _with(f"SELECT {no_ts}, TIMESTAMP '{BATCH_TS}' AS {LOADED_AT} FROM log", LOG_SQL)
    o["append_roundtrip"] = _with("SELECT * FROM log", LOG_SQL)
    o["stream_ingest"] = _with(f"SELECT {no_ts} FROM log", LOG_SQL)
    # The backfill of the first load begins 1826 days before its target.
    o["load_job"] = _with(
        f"SELECT {no_ts}, TIMESTAMP '{BATCH_TS}' AS {LOADED_AT} FROM log WHERE campaigns_execution_date "
        f"BETWEEN DATE '{LOAD_TARGETS[0]}' - INTERVAL 1826 DAY AND DATE '{LOAD_TARGETS[1]}'", LOG_SQL)
    o["ingest_malformed"] = _with(
        "SELECT CASE WHEN impressions % 1700 = 0 THEN 'malformed' ELSE 'cleaned' END AS outcome, count(*) AS n "
        "FROM log GROUP BY 1", LOG_SQL)
    o["stream_outcomes"] = o["ingest_malformed"]
    # A cut-off record is met in its month's folder, whatever its date.
    o["load_rejects"] = _with(
        "SELECT CASE WHEN impressions % 1700 = 0 THEN 'malformed' ELSE 'cleaned' END AS outcome, count(*) AS n FROM "
        "log WHERE CASE WHEN "
        f"impressions % 1700 = 0 THEN date_trunc('month', campaigns_execution_date) BETWEEN date_trunc('month', DATE "
        f"'{LOAD_TARGETS[0]}' - INTERVAL 1826 DAY) AND DATE '{LOAD_TARGETS[1]}' ELSE campaigns_execution_date BETWEEN "
        f"DATE '{LOAD_TARGETS[0]}' - INTERVAL 1826 DAY AND DATE '{LOAD_TARGETS[1]}' END GROUP BY 1", LOG_SQL)
    stages = [("snapshot", _not_null_sql("log", "campaign_performance_raw_appends",
                                         ["campaigns_execution_date", "campaign_name"])),
              ("staging", [_unique_sql("stg", "stg_campaign_performance", ["campaign_performance_sk"])]),
              ("core", [_unique_sql("dim_campaigns", "dim_campaigns", ["campaign_key"]),
                        _unique_sql("dim_ads", "dim_ads", ["ad_key"]),
                        _unique_sql("dates", "dim_dates", ["date_key"]),
                        _rel_sql("fact", "campaign_key", "dim_campaigns", "campaign_key", "fct_daily_performance"),
                        _rel_sql("fact", "ad_key", "dim_ads", "ad_key", "fct_daily_performance")]),
              ("reporting", _not_null_sql("monthly", "monthly_campaign_summary", ["report_month", "campaign_name"])
               + [_expr_sql("monthly", "monthly_campaign_summary", c, ">= 0") for c in ("roas_3d", "cpi")])]
    o["layer_checks"] = _with(
        " UNION ALL ".join(f"SELECT *, '{stage}' AS stage FROM ({sql})" for stage, sqls in stages for sql in sqls),
        CHAIN, DIMS_SQL, _dates_sql(), _fact_sql())
    o["report_export"] = _with(
        "SELECT campaign_name, report_month, total_spend, total_spend - lag(total_spend) OVER "
        "(PARTITION BY campaign_name ORDER BY report_month) AS spend_change FROM monthly", CHAIN)
    sel = ", ".join(f"{DIRTY_EXPECT[c]} AS {c}" if c in DIRTY_EXPECT else c
                    for c in LOG_COLS if c != LOADED_AT)
    o["ingest_dirty_clean"] = _with(f"SELECT {sel} FROM log", LOG_SQL)
    void = ("CASE WHEN bool_or(cpc_cents % 10 = 7) OVER (PARTITION BY campaigns_execution_date) "
            "THEN CAST(0 AS BIGINT) ELSE impressions END")
    per_day = ", ".join(f"{void if c == 'impressions' else DIRTY_EXPECT.get(c, c)} AS {c}"
                        for c in LOG_COLS if c != LOADED_AT)
    o["ingest_column_policy"] = _with(f"SELECT {per_day} FROM log", LOG_SQL)
    o["lifeday_unpivot_pivot"] = _with(f"SELECT {KEYS_SQL}, {', '.join(LIFEDAY_COLS)} FROM log", LOG_SQL)
    revs = [lifeday_cols(ld)[3] for ld in LIFEDAYS]
    o["money_to_cents"] = _with(
        f"SELECT {KEYS_SQL}, CASE WHEN cpc_cents % 10 = 6 THEN CAST(0 AS BIGINT) ELSE cpc_cents END AS cpc_cents, "
        f"{', '.join(revs)} FROM log", LOG_SQL)
    o["money_half_up"] = _with(
        f"SELECT {KEYS_SQL}, CASE WHEN cpc_cents % 10 = 6 THEN CAST(0 AS BIGINT) "
        f"ELSE CAST({_half_up('cpc_cents')} AS BIGINT) END AS cpc_cents, "
        + ", ".join(f"CAST({_half_up(r)} AS BIGINT) AS {r}" for r in revs) + " FROM log", LOG_SQL)
    o["money_cost_currency"] = _with(
        f"SELECT {KEYS_SQL}, CASE WHEN cpc_cents % 10 BETWEEN 4 AND 7 THEN CAST(0 AS BIGINT) "
        f"ELSE CAST({_half_up('spend_cents')} AS BIGINT) END AS spend_cents, impressions FROM log", LOG_SQL)
    parts = []
    for c in METRIC_COLS:
        flags = DIRTY_FLAGS.get(c, {})
        vals = ", ".join(
            f"CAST(count(*) FILTER (WHERE {SEL} IN {flags[k]}) AS BIGINT) AS {k}" if k in flags
            else f"CAST(count(*) FILTER (WHERE FALSE) AS BIGINT) AS {k}" for k in ingest.FLAGS)
        parts.append(f"SELECT '{c}' AS column_name, {vals} FROM log")
    # A load's windows: from the day after the mark (or the backfill's begin) to its target.
    bounds = (f"SELECT 0 AS i, DATE '{LOAD_TARGETS[0]}' - INTERVAL 1826 DAY AS lo, DATE '{LOAD_TARGETS[0]}' AS hi UNION ALL "
              f"SELECT 1, DATE '{LOAD_TARGETS[0]}' + INTERVAL 1 DAY, DATE '{LOAD_TARGETS[1]}'")
    each = []
    for c in METRIC_COLS:
        for k in ingest.FLAGS:
            cond = DIRTY_FLAGS.get(c, {}).get(k)
            each.append(f"SELECT i, '{c}' AS column_name, '{k}' AS flag, CAST("
                        + (f"count(*) FILTER (WHERE {SEL} IN {cond})" if cond else "0")
                        + " AS BIGINT) AS failures, count(*) AS rows FROM loaded GROUP BY i")
    o["load_quality"] = _with(
        f"SELECT TIMESTAMP '{BATCH_TS}' + to_days(CAST(i AS INTEGER)) AS loaded_at, column_name, flag, failures, rows FROM "
        f"({' UNION ALL '.join(each)})", LOG_SQL, f"bounds AS ({bounds})",
        "loaded AS (SELECT * FROM log JOIN bounds ON campaigns_execution_date BETWEEN lo AND hi)")
    middle = "({0}[(len({0}) - 1) // 2 + 1] + {0}[len({0}) // 2 + 1]) / 2".format
    o["quality_drift"] = _with(
        "SELECT load, failures, rows, share, baseline, spread, coalesce(len(earlier) >= 3 AND share - baseline > 0.01 "
        "AND share - baseline > 6 * spread, false) AS drifted FROM (SELECT *, " + middle("apart") + " AS spread FROM "
        "(SELECT *, list_sort(list_transform(earlier, lambda x: abs(x - baseline))) AS apart FROM (SELECT *, "
        + middle("earlier") + " AS baseline FROM earlier_shares)))",
        LOG_SQL,
        "months AS (SELECT CAST(date_trunc('month', campaigns_execution_date) AS DATE) AS m, count(*) AS rows, "
        f"count(*) FILTER (WHERE {SEL} = 2) AS n FROM log GROUP BY 1)",
        "shares AS (SELECT CAST(m AS VARCHAR) AS load, m, rows, CAST(CASE WHEN extract(month FROM m) % 7 = 0 THEN 3 * n "
        "ELSE n END AS BIGINT) AS failures, (CASE WHEN extract(month FROM m) % 7 = 0 THEN 3 * n ELSE n END)::DOUBLE / "
        "rows AS share FROM months)",
        "earlier_shares AS (SELECT *, list_sort(coalesce(list(share) OVER (ORDER BY m ROWS BETWEEN 12 PRECEDING AND "
        "1 PRECEDING), [])) AS earlier FROM shares)")
    o["quality_counts"] = _with(" UNION ALL ".join(parts), LOG_SQL)
    o["ingest_rejects"] = _with(
        "SELECT campaign_name AS campaign, CASE WHEN impressions = 100 THEN NULL ELSE 'not-a-date' END AS date, "
        "CASE WHEN impressions = 100 THEN 'missing_date' ELSE 'bad_date' END AS reject_reason "
        "FROM log WHERE impressions = 100 OR (impressions / 100) % 25 = 0", LOG_SQL)
    return o


ORACLE_SQL: dict[str, str] = {**_oracles(), **_ingest_oracles()}
