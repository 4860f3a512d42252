"""Sinks, the load job, the layer build with its check gates, SQL-file reports."""

import datetime as dt
import glob
import json
import os
import sys
import time

import pytest
from pyspark.sql import functions as F

from campaignlake.operators.checks import CheckFailed
from campaignlake.plans import build_layers, load, run_sql_reports
from campaignlake.plans.load import fill_incomplete, read_log
from campaignlake.plans.reports import export_reports
from campaignlake.sources import fixtures
from campaignlake.sources.fixtures import campaign_log, campaign_log_by_month
from campaignlake.sources.records import read_records, record_struct
from campaignlake.sources.sinks import append, export_report

from .conftest import ROOT, SF_SMALL

TS = dt.datetime(2024, 1, 1)


def write_landing(spark, log, path):
    """Land the log as JSON-lines records (one file per task)."""
    log.select(F.to_json(record_struct(log)).alias("value")).write.mode("overwrite").text(path)


def test_append_partitions_and_counts(spark, tmp):
    log = campaign_log(spark, SF_SMALL).limit(50)
    n = append(log, f"{tmp}/log")
    assert n == 50
    assert glob.glob(f"{tmp}/log/execution_month=*")
    assert spark.read.parquet(f"{tmp}/log").count() == 50
    assert append(log.limit(0), f"{tmp}/log") == 0
    with pytest.raises(ValueError):
        append(log, f"{tmp}/x", format="nope")


def test_load_backfill_then_incremental(spark, tmp):
    log = campaign_log(spark, SF_SMALL)
    landing = f"{tmp}/landing"
    write_landing(spark, log, landing)
    recs = read_records(spark, landing, multi_line=False)
    first = load(spark, recs, f"{tmp}/log", "1998-06-30", loaded_at=TS)
    assert first.hwm is None
    in_backfill = log.where(F.col("campaigns_execution_date").between("1993-06-29", "1998-06-30")).count()
    assert first.rows_appended == in_backfill
    hwm = log.where(F.col("campaigns_execution_date") <= "1998-06-30").agg(
        F.max("campaigns_execution_date")).first()[0]
    second = load(spark, recs, f"{tmp}/log", "1998-09-15", loaded_at=TS)
    assert second.hwm == hwm
    assert second.rows_appended == log.where(
        F.col("campaigns_execution_date").between(hwm + dt.timedelta(days=1), dt.date(1998, 9, 15))).count()
    again = load(spark, recs, f"{tmp}/log", "1998-09-15", loaded_at=TS)
    assert again.rows_appended == 0


def test_build_layers_and_reports(spark, tmp):
    log = campaign_log(spark, SF_SMALL)
    out = build_layers(log, warehouse=f"{tmp}/wh", date_range=("1995-01-01", "2002-01-01"))
    assert set(out.check_results) == {"snapshot", "staging", "core", "reporting"}
    t = out.tables
    assert t["fct_daily_performance"].count() == t["stg_campaign_performance"].count()
    assert os.path.isdir(f"{tmp}/wh/scd_campaign_performance")
    reports = run_sql_reports(spark, os.path.join(ROOT, "reports"),
                              {"monthly_campaign_summary": t["monthly_campaign_summary"]})
    assert set(reports) == {"spend_change", "top_spend"}
    assert reports["top_spend"].count() == 10
    paths = export_reports(reports, f"{tmp}/out", dt.date(2024, 11, 1), single_file=True)
    assert paths["top_spend"].endswith("top_spend_20241101")
    assert len(glob.glob(paths["top_spend"] + "/*.csv")) == 1


def test_gate_stops_the_chain(spark, tmp):
    log = campaign_log(spark, SF_SMALL).withColumn(
        "campaign_name", F.when(F.col("clicks") == 0, None).otherwise(F.col("campaign_name")))
    with pytest.raises(CheckFailed, match="snapshot"):
        build_layers(log, warehouse=f"{tmp}/wh2")


def test_export_empty_report_writes_nothing(spark, tmp):
    df = spark.range(0)
    assert export_report(df, "empty", f"{tmp}/out") is None
    assert not os.path.exists(f"{tmp}/out")


def test_read_records_json_array_file(spark, tmp):
    p = f"{tmp}/a.json"
    with open(p, "w") as fh:
        json.dump([{"date": "2024-10-01", "campaign": "C", "cost": 5}], fh)
    assert read_records(spark, p, multi_line=True).count() == 1


def test_daily_run_end_to_end(spark, tmp):
    from campaignlake.plans.daily import run_daily
    log = campaign_log(spark, SF_SMALL).where(F.col("campaigns_execution_date") <= "1998-10-31")
    write_landing(spark, log, f"{tmp}/landing")
    r = run_daily(spark, f"{tmp}/landing", f"{tmp}/log", f"{tmp}/wh", "1998-10-31",
                  reports_dir=os.path.join(ROOT, "reports"), out_dir=f"{tmp}/out",
                  date_range=("1993-01-01", "1999-01-01"), multi_line=False)
    in_horizon = log.where(F.col("campaigns_execution_date") >= "1993-10-30").count()
    assert r.load.hwm is None and r.load.rows_appended == in_horizon
    assert r.layers.tables["fct_daily_performance"].count() == r.layers.tables["stg_campaign_performance"].count()
    assert r.exported["spend_change"] and r.exported["top_spend"]
    assert r.rejected == 0 and r.layers.history_update.kind == "rebuilt"


def test_load_column_policy_applies_per_chunk(spark, tmp):
    """A fractional count voids that column only inside its own month chunk."""
    recs = [{"date": "2024-09-10", "campaign": "C", "clicks": 1.5},
            {"date": "2024-09-11", "campaign": "C", "clicks": 4},
            {"date": "2024-10-02", "campaign": "C", "clicks": 7}]
    os.makedirs(f"{tmp}/landing")
    with open(f"{tmp}/landing/b.json", "w") as fh:
        json.dump(recs, fh)
    r = load(spark, read_records(spark, f"{tmp}/landing", multi_line=True), f"{tmp}/log", "2024-10-05",
             loaded_at=TS, cast_failure="column")
    assert r.rows_appended == 3
    got = {str(x["campaigns_execution_date"]): x["clicks"] for x in spark.read.parquet(f"{tmp}/log").collect()}
    assert got == {"2024-09-10": 0, "2024-09-11": 0, "2024-10-02": 7}


def test_checkpoint_dir_comes_from_the_session(spark):
    from campaignlake.session import ensure_checkpoint_dir, scratch_path
    configured = spark.sparkContext.getCheckpointDir()
    assert configured
    root = ensure_checkpoint_dir(spark, fallback="/never/used")
    assert "/never/used" not in root
    assert scratch_path(spark, "x").startswith(root.rstrip("/") + "/campaignlake/x-")


def records(*days, **more):
    return [{"date": d, "campaign": "C", "ad": "A", "clicks": 1, **more} for d in days]


def land_lines(path, rows):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/r.json", "a") as fh:
        fh.writelines(json.dumps(r) + "\n" for r in rows)


@pytest.mark.parametrize("format", ["parquet", "orc", "json", "csv"])
def test_second_load_sees_the_mark_in_every_format(spark, tmp, format):
    land_lines(f"{tmp}/landing", records("2024-10-01", "2024-10-02", "2024-10-03"))
    recs = read_records(spark, f"{tmp}/landing")
    assert load(spark, recs, f"{tmp}/log", "2024-10-03", loaded_at=TS, format=format).rows_appended == 3
    again = load(spark, recs, f"{tmp}/log", "2024-10-03", loaded_at=TS, format=format)
    assert (again.hwm, again.rows_appended) == (dt.date(2024, 10, 3), 0)


def test_a_log_that_cannot_be_read_is_not_a_first_load(spark, tmp):
    os.makedirs(f"{tmp}/log")
    with open(f"{tmp}/log/part-0.parquet", "w") as fh:
        fh.write("broken")
    land_lines(f"{tmp}/landing", records("2024-10-01"))
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        load(spark, read_records(spark, f"{tmp}/landing"), f"{tmp}/log", "2024-10-03", loaded_at=TS)
    with pytest.raises(ValueError):
        load(spark, read_records(spark, f"{tmp}/landing"), "url", "2024-10-03", format="jdbc")


def test_table_overwrite_replaces_its_partitions(spark, tmp):
    log = campaign_log(spark, SF_SMALL).where("campaigns_execution_date < '1995-04-01'")
    name = "overwrite_test_log"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    append(log, name, format="table")
    n = spark.table(name).count()
    march = log.where("campaigns_execution_date >= '1995-03-01'")
    append(march, name, format="table", mode="overwrite")
    assert spark.table(name).count() == n  # the same rows again, other months untouched
    append(march.limit(1), name, format="table")
    assert spark.table(name).count() == n + 1
    spark.sql(f"DROP TABLE {name}")
    for format, mode in (("jdbc", "overwrite"), ("parquet", "ignore")):
        with pytest.raises(ValueError):
            append(log, f"{tmp}/x", format=format, mode=mode)


def test_gaps_are_refilled_and_landing_months_pruned(spark, tmp):
    days = [f"2024-{m:02d}-{d:02d}" for m in (7, 8, 9, 10) for d in (1, 15, 28)]
    for day in days:
        land_lines(f"{tmp}/landing/execution_month={day[:8]}01", records(day))
    land_lines(f"{tmp}/first", records(*(d for d in days if d[:7] != "2024-08")))
    load(spark, read_records(spark, f"{tmp}/first"), f"{tmp}/log", "2024-09-28", loaded_at=TS)
    recs = read_records(spark, f"{tmp}/landing")
    r = load(spark, recs, f"{tmp}/log", "2024-10-28", loaded_at=TS, refill_from="2024-07-15")
    assert r.rows_appended == 6  # the skipped August and the new October
    assert sorted(str(x[0]) for x in spark.read.parquet(f"{tmp}/log").select("campaigns_execution_date").collect()) == days
    again = load(spark, recs, f"{tmp}/log", "2024-10-28", loaded_at=TS, refill_from="2024-07-15")
    assert again.rows_appended == 0
    # a plain daily load of November reads no older month
    land_lines(f"{tmp}/landing/execution_month=2024-11-01", records("2024-11-02"))
    new = load(spark, read_records(spark, f"{tmp}/landing"), f"{tmp}/log", "2024-11-02", loaded_at=TS)
    assert new.rows_appended == 1


def test_load_prunes_landing_partitions(spark, tmp, monkeypatch):
    load_module = sys.modules["campaignlake.plans.load"]  # the package's name is the function's
    for month in ("07", "08", "09"):
        land_lines(f"{tmp}/landing/execution_month=2024-{month}-01", records(f"2024-{month}-03"))
    append_log = campaign_log(spark, SF_SMALL).limit(1).withColumn("campaigns_execution_date", F.lit("2024-08-31").cast("date"))
    append(append_log, f"{tmp}/log")
    seen = {}
    real = load_module.append
    monkeypatch.setattr(load_module, "append", lambda df, *a, **k: (seen.update(
        plan=df._jdf.queryExecution().executedPlan().toString()), real(df, *a, **k))[1])
    load(spark, read_records(spark, f"{tmp}/landing"), f"{tmp}/log", "2024-09-30", loaded_at=TS)
    assert "PartitionFilters: [isnotnull(execution_month" in seen["plan"]


@pytest.mark.parametrize("multi_line", [True, False])
def test_clean_and_rejects_partition_the_records(spark, tmp, multi_line):
    from campaignlake.operators.ingest import clean, rejects
    rows = [*records("2024-10-01", "2024-10-02"), {"date": "2024-10-03", "campaign": "C", "metrics": "wrong type"},
            *records("nonsense"), {"campaign": "no date"}]
    with open(f"{tmp}/r.json", "w") as fh:
        fh.write(json.dumps(rows) if multi_line else "\n".join(map(json.dumps, rows)))
    recs = read_records(spark, f"{tmp}/r.json", multi_line=multi_line).cache()
    good, bad = clean(recs, loaded_at=TS), rejects(recs)
    assert good.count() + bad.count() == recs.count() == 5
    dates = {str(r["campaigns_execution_date"]) for r in good.collect()}
    if not multi_line:
        assert dates == {"2024-10-01", "2024-10-02"}
        assert sorted(r["reject_reason"] for r in bad.collect()) == ["bad_date", "malformed", "missing_date"]
    assert not dates & {r["date"] for r in bad.collect()}
    recs.unpersist()


def test_daily_runs_merge_and_keep_rejects(spark, tmp):
    from campaignlake.operators import history
    from campaignlake.plans.daily import run_daily
    days = {"2024-10-02": records("2024-10-01", "2024-10-02"), "2024-10-03": records("2024-10-03", "bad day"),
            "2024-10-04": records("2024-10-04")}
    for i, (target, rows) in enumerate(days.items()):
        land_lines(f"{tmp}/landing", rows)
        r = run_daily(spark, f"{tmp}/landing", f"{tmp}/log", f"{tmp}/wh", target,
                      loaded_at=TS + dt.timedelta(days=i))
        assert r.layers.history_update.kind == ("merged" if i else "rebuilt")
        assert r.rejected == (1 if i == 1 else 0)  # the later run meets the bad record again and knows it
    got = r.layers.tables["scd_campaign_performance"]
    want = history.history_from_log(spark.read.parquet(f"{tmp}/log").drop("execution_month"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))
    assert spark.read.json(f"{tmp}/wh/rejects/target=2024-10-03").count() == 1


def test_gates_of_the_daily_run_and_stored_counters(spark, tmp):
    from campaignlake.operators import ingest
    from campaignlake.plans.daily import run_daily
    from campaignlake.plans.load import read_quality

    def land(day, broken=0):
        rows = records(day) * 20
        rows = [dict(r, clicks="12D") if i < broken else r for i, r in enumerate(rows)]
        land_lines(f"{tmp}/landing", rows)

    for i in range(1, 5):
        land(f"2024-10-0{i}")
        r = run_daily(spark, f"{tmp}/landing", f"{tmp}/log", f"{tmp}/wh", f"2024-10-0{i}", loaded_at=TS + dt.timedelta(days=i))
    stored = read_quality(spark, f"{tmp}/log")
    assert stored.select("load").distinct().count() == 4
    land("2024-10-05", broken=10)
    with pytest.raises(CheckFailed, match="drift.*clicks"):
        run_daily(spark, f"{tmp}/landing", f"{tmp}/log", f"{tmp}/wh", "2024-10-05", loaded_at=TS + dt.timedelta(days=5))
    last = {(x["column_name"], x["flag"]): x["failures"] for x in read_quality(spark, f"{tmp}/log").where(
        f"loaded_at = timestamp_ntz'{TS + dt.timedelta(days=5)}'").collect()}
    recs = read_records(spark, f"{tmp}/landing").where("date = '2024-10-05'")
    want = {(x["column_name"], k): x[k] for x in ingest.quality_counts(recs).collect() for k in ingest.FLAGS}
    assert last == want and last["clicks", "non_numeric"] == 10
    with pytest.raises(CheckFailed, match="freshness"):
        run_daily(spark, f"{tmp}/landing", f"{tmp}/log", f"{tmp}/wh", "2024-10-05", now=TS + dt.timedelta(days=8))


def test_column_policy_parses_the_records_once(spark, tmp):
    from campaignlake.operators.ingest import clean

    land_lines(f"{tmp}/landing", records("2024-10-01", "2024-10-02"))
    out = clean(read_records(spark, f"{tmp}/landing"), loaded_at=TS, cast_failure="column", chunk_col="date")
    assert "FileScan json" not in out._jdf.queryExecution().executedPlan().toString() and out.count() == 2


def test_a_warehouse_patches_fact_and_totals_by_month(spark, tmp):
    from campaignlake.operators import history, kpi, star
    from campaignlake.schema import LOADED_AT

    log, span = campaign_log(spark, SF_SMALL).cache(), ("1990-01-01", "2010-01-01")
    runs = [log.where(f"{LOADED_AT} < timestamp_ntz'1998-11-20'"), log.where(f"{LOADED_AT} < timestamp_ntz'1998-12-02'"),
            log]
    for i, seen in enumerate(runs):
        out = build_layers(seen, warehouse=f"{tmp}/wh", date_range=span)
        done = (out.history_update, out.fact_update, out.totals_update)
        assert [d.kind for d in done] == (["merged", "patched", "patched"] if i else ["rebuilt"] * 3)
        months = set(out.history_update.merged_months)
        assert not i or (0 < len(months) < 40 and set(out.fact_update.months) <= months)
        stg = star.staging(history.history_from_log(seen))
        same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.select(a.columns).collect()))
        assert same(out.tables["fct_daily_performance"], star.fact_daily(stg, date_range=span))
        assert same(out.tables["rpt_monthly_campaign_summary"], kpi.rpt_monthly_campaign_summary(stg))
        assert same(out.tables["dim_ads"], star.dim_ads(stg))
        # The gates look at the months of this run, all of them in the first.
        assert out.checked_months == (sorted(months) if i else None)
        looked = {p.split("execution_month=")[1][:10] for p in out.check_results["staging"].inputFiles()}
        assert looked == (months if i else set(out.history_update.state.open))
    again = build_layers(log, warehouse=f"{tmp}/wh", date_range=span)
    assert again.fact_update.kind == again.totals_update.kind == "current" and again.checked_months == []
    assert all(r["failures"] == 0 for g in again.check_results.values() for r in g.collect())
    other = build_layers(log, warehouse=f"{tmp}/wh", date_range=("1990-01-01", "2011-01-01"))
    assert other.fact_update.kind == "rebuilt" and other.checked_months is None


def test_the_source_gate_reads_the_months_of_fresh_rows(spark, tmp):
    from campaignlake.schema import LOADED_AT

    log = campaign_log(spark, SF_SMALL)
    early = f"{LOADED_AT} < timestamp_ntz'1998-12-02'"
    append(log.where(early), f"{tmp}/log")
    build_layers(read_log(spark, f"{tmp}/log", with_month=True), warehouse=f"{tmp}/wh")
    append(log.where(f"not {early}"), f"{tmp}/log")
    out = build_layers(read_log(spark, f"{tmp}/log", with_month=True), warehouse=f"{tmp}/wh")
    assert 0 < len(out.checked_months) < 40
    plan = out.check_results["snapshot"]._jdf.queryExecution().executedPlan().toString()
    assert "execution_month" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]


def test_months_that_failed_a_gate_are_looked_at_again(spark, tmp, monkeypatch):
    from campaignlake.operators import checks
    from campaignlake.schema import LOADED_AT

    log = campaign_log(spark, SF_SMALL).cache()
    build = lambda df: build_layers(df, warehouse=f"{tmp}/wh")
    build(log.where(f"{LOADED_AT} < timestamp_ntz'1998-12-02'"))
    # The merge is written, then a later gate fails.
    with monkeypatch.context() as m:
        m.setattr(checks, "relationships_of", lambda df, *a: checks.expression_is_true(
            df, "clicks", "< 0", "fct_daily_performance"))
        with pytest.raises(CheckFailed, match="core"):
            build(log)
    again = build(log)
    assert again.history_update.kind == "current" and len(again.checked_months) > 0
    assert build(log).checked_months == []
    # A fault in an old month comes with a late row; the gate before the merge finds it each time.
    bad = log.limit(1).withColumn("campaign_name", F.lit(None).cast("string"))
    for _ in range(2):
        with pytest.raises(CheckFailed, match="snapshot"):
            build(log.unionByName(bad))
    log.unpersist()


def test_unknown_history_plan_is_refused(spark, tmp):
    log = campaign_log(spark, SF_SMALL).limit(1)
    for include in (False, True):
        with pytest.raises(ValueError, match="bogus"):
            build_layers(log, warehouse=f"{tmp}/wh", include_load_ts=include, history_plan="bogus")


def test_qualified_report_views_write_nothing(spark, tmp):
    os.makedirs(f"{tmp}/sql")
    with open(f"{tmp}/sql/r.sql", "w") as fh:
        fh.write("SELECT count(*) AS n FROM main_reporting.summary AS s -- not other_main_reporting.summary2\n")
    before = {d.name for d in spark.catalog.listDatabases()}
    out = run_sql_reports(spark, f"{tmp}/sql", {"main_reporting.summary": spark.range(3)})
    assert out["r"].first()["n"] == 3
    assert {d.name for d in spark.catalog.listDatabases()} == before


def test_stray_dates_do_not_make_a_giant_calendar(spark):
    from campaignlake.operators import star
    df = spark.sql("SELECT date'2024-01-15' AS report_date UNION ALL SELECT date'9999-01-01'")
    with pytest.raises(ValueError, match="days"):
        star.dim_dates_spanning(df)
    ok = star.dim_dates_spanning(df.where("report_date < '2025-01-01'"))
    assert ok.count() == 15 and star.dim_dates_spanning(df.where("false")).count() == 0


def test_a_batch_without_load_time_gets_one(spark, tmp):
    log = campaign_log(spark, SF_SMALL).limit(5)
    before = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    append(log.drop("_etl_loaded_at"), f"{tmp}/log")
    assert all(before <= r[0] <= before + dt.timedelta(minutes=5)
               for r in spark.read.parquet(f"{tmp}/log").select("_etl_loaded_at").collect())


def test_layers_without_a_warehouse_can_be_dropped(spark):
    log = campaign_log(spark, SF_SMALL).where("campaigns_execution_date < '1995-06-01'")
    out = build_layers(log, date_range=("1995-01-01", "1996-01-01"), history_plan="split", stop_after="staging")
    paths = list(out.scratch)
    assert paths and all(os.path.isdir(p.removeprefix("file:")) for p in paths)
    out.drop_scratch(spark)
    assert not any(os.path.exists(p.removeprefix("file:")) for p in paths)


def test_half_loaded_dates_are_completed(spark, tmp):
    days = ("2024-01-30", "2024-01-31", "2024-02-01", "2024-03-05")
    whole = records(*days) + records("2024-01-31", "2024-01-31", clicks=7) + records("2024-02-01", campaign=None)
    half = records(*days) + records("2024-01-31", clicks=7)
    land_lines(f"{tmp}/half", half)
    load(spark, read_records(spark, f"{tmp}/half"), f"{tmp}/log", "2024-03-05", loaded_at=TS)
    land_lines(f"{tmp}/landing", whole)
    args = spark, read_records(spark, f"{tmp}/landing"), f"{tmp}/log", "2024-01-01", "2024-02-29"
    assert fill_incomplete(*args, loaded_at=TS + dt.timedelta(days=1)) == 2
    got = read_log(spark, f"{tmp}/log").collect()
    assert sorted((str(r[0]), r.campaign_name or "", r.clicks) for r in got) == sorted(
        (r["date"], r["campaign"] or "", r["clicks"]) for r in whole)
    assert fill_incomplete(*args, loaded_at=TS) == 0


def test_log_by_month_holds_the_rows_of_the_log(spark, tmp):
    log, by_month = campaign_log(spark, SF_SMALL), campaign_log_by_month(spark, SF_SMALL)
    append(by_month, f"{tmp}/log", moved=True)
    fixtures.land(by_month, f"{tmp}/landing")
    for stored, made in ((read_log(spark, f"{tmp}/log"), log), (spark.read.text(f"{tmp}/landing").select("value"),
                                                                 log.select(F.to_json(record_struct(log)).alias("value")))):
        assert stored.exceptAll(made).isEmpty() and made.exceptAll(stored).isEmpty()
    # A month's rows lie in few files, as after a rebalance.
    assert all(len(glob.glob(f"{m}/part-*")) == 1 for m in glob.glob(f"{tmp}/log/execution_month=*"))


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}


def test_writes_leave_no_shuffle_files(spark, tmp):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    log, before, setting = campaign_log(spark, SF_SMALL), shuffle_files(spark), spark.conf.get(key)
    append(log, f"{tmp}/log")
    fixtures.land(log, f"{tmp}/landing")
    for _ in range(100):  # they go in the background
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(key) == setting
