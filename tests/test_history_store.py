"""The stored history: runs that merge, rebuild, die half-way, or have nothing to do."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from campaignlake.operators import history
from campaignlake.plans import history_store as hs
from campaignlake.schema import LOG_SCHEMA

from .test_history import log_df, row, t, versions


def stored(spark, path, update):
    return hs.read_history(spark, path, update.state)


def same(spark, path, update, log):
    return sorted(map(str, stored(spark, path, update).collect())) == sorted(
        map(str, history.history_from_log(log).collect()))


RUNS = [
    [row(t(0), 1), row(t(0), 1, "D")],
    [row(t(1), 2), row(t(1), 1, "D"), row(t(2), 2)],
    [row(t(3), 1), row(t(3), 1, "E")],
]


def test_runs_equal_one_rebuild(spark, tmp):
    rows = []
    for i, batch in enumerate(RUNS):
        rows += batch
        log = log_df(spark, rows)
        done = hs.update(spark, log, tmp)
        assert done.kind == ("merged" if i else "rebuilt") and same(spark, tmp, done, log)
    again = hs.update(spark, log, tmp)
    assert again.kind == "current" and again.state == done.state
    now = hs.open_versions(spark, tmp, done.state)
    assert versions(now) == versions(history.current(stored(spark, tmp, done)))


def test_a_merge_reads_no_closed_versions(spark, tmp):
    log = log_df(spark, RUNS[0] + RUNS[1])
    state = hs.update(spark, log, tmp).state
    files = {r[0] for r in hs.open_versions(spark, tmp, state).select(F.input_file_name()).collect()}
    assert files and all("/open=1/" in f for f in files)
    read = hs.merged_versions(spark, log, tmp, state, sorted(state.open)).inputFiles()
    assert read and not any("/open=0/" in f for f in read if tmp in f)


def month_rows(months, at, spend=1):
    return [row(at, 1, c, day=dt.date(2024, m, 2), spend=spend + i) for m in months for i, c in enumerate("CD")]


def test_a_merge_reads_and_writes_touched_months_only(spark, tmp):
    rows = month_rows((1, 2, 3), t(0))
    hs.update(spark, log_df(spark, rows), tmp)
    rows += month_rows((2,), t(1), 5)
    log = log_df(spark, rows)
    before = hs.read_state(spark, tmp)
    read = hs.merged_versions(spark, log, tmp, before, ["2024-02-01"]).inputFiles()
    assert {f.split("execution_month=")[1][:10] for f in read if tmp in f} == {"2024-02-01"}
    done = hs.update(spark, log, tmp)
    assert done.kind == "merged" and done.merged_months == ("2024-02-01",) and not done.rebuilt_months
    assert done.state.open == {"2024-01-01": [0], "2024-02-01": [1], "2024-03-01": [0]}
    assert same(spark, tmp, done, log)
    feed = hs.read_changes(spark, tmp, done.state, 0).collect()
    assert sorted((r["sign"], r["spend_cents"]) for r in feed) == [(-1, 1), (-1, 2), (1, 5), (1, 6)]


def test_month_folders_of_the_log_are_pruned(spark, tmp):
    from campaignlake.plans.month_tables import in_months
    from campaignlake.sources.sinks import append

    append(log_df(spark, month_rows((1, 2, 3, 12), t(0))), f"{tmp}/log")
    log = spark.read.parquet(f"{tmp}/log")
    some = in_months(log, ["2024-12-01", "2024-02-01", "2024-03-01"])
    assert some.count() == 6
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [execution_month" in plan and "PushedFilters: [Or(And(GreaterThanOrEqual" in plan


def test_other_options_build_the_history_again(spark, tmp):
    rows = [row(t(0), 1), row(t(1), 1)]
    hs.update(spark, log_df(spark, rows), tmp, include_load_ts=True)
    log = log_df(spark, [*rows, row(t(2), 1)])
    done = hs.update(spark, log, tmp)
    assert done.kind == "rebuilt" and same(spark, tmp, done, log)
    done = hs.update(spark, log, tmp, include_load_ts=True)
    assert done.kind == "rebuilt" and stored(spark, tmp, done).count() == 3


def test_keys_without_a_date_and_rows_without_one(spark, tmp):
    keys = ("campaign_name", "ad_name")
    rows = month_rows((1, 2), t(0)) + [row(t(0), 9, "E", day=None)]
    loose = StructType([StructField(f.name, f.dataType) for f in LOG_SCHEMA.fields])
    for batch in ([], month_rows((3,), t(1), 7), [row(t(2), 3, "E", day=None), row(t(0), 3, "F", day=None)]):
        rows += batch
        log = spark.createDataFrame(rows, loose)
        a, b = hs.update(spark, log, f"{tmp}/a", keys=keys), hs.update(spark, log, f"{tmp}/b")
        assert sorted(map(str, stored(spark, f"{tmp}/a", a).collect())) == sorted(
            map(str, history.history_from_log(log, keys=keys).collect()))
        assert same(spark, f"{tmp}/b", b, log)


@pytest.mark.parametrize("late", [row(t(1), 7), row(None, 7)])
def test_a_late_row_builds_its_month_again(spark, tmp, late):
    rows = [row(t(0), 1), row(t(2), 1)]
    hs.update(spark, log_df(spark, rows), tmp)
    log = log_df(spark, [*rows, late, row(t(5), 3)])
    done = hs.update(spark, log, tmp)
    assert done.kind == "merged" and len(done.rebuilt_months) == 1 and same(spark, tmp, done, log)
    log = log_df(spark, [*rows, late, row(t(5), 3), row(t(6), 4)])
    done = hs.update(spark, log, tmp)
    assert done.kind == "merged" and same(spark, tmp, done, log)


def test_a_merge_that_died_is_repeated(spark, tmp, monkeypatch):
    hs.update(spark, log_df(spark, RUNS[0]), tmp)
    log = log_df(spark, RUNS[0] + RUNS[1])
    state = hs.read_state(spark, tmp)
    # The versions were written, the state row was not.
    month = next(iter(state.open))
    hs.merged_versions(spark, log, tmp, state, [month]).selectExpr("*", "int(valid_to is null) as open").write \
        .partitionBy("open").parquet(f"{tmp}/versions/data/execution_month={month}/merge=1")
    assert hs.read_state(spark, tmp) == state
    assert same(spark, tmp, hs.Update(state, "current"), log_df(spark, RUNS[0]))
    done = hs.update(spark, log, tmp)
    assert done.kind == "merged" and done.state.merge == 1 and same(spark, tmp, done, log)


def test_empty_logs_and_unknown_plans(spark, tmp):
    empty = log_df(spark, RUNS[0]).where("false")
    done = hs.update(spark, empty, tmp)
    assert done.state.merged_through is None and hs.read_history(spark, tmp, done.state) is None
    log = log_df(spark, RUNS[0])
    done = hs.update(spark, log, tmp, history_plan="split")
    assert done.kind == "rebuilt" and same(spark, tmp, done, log)
    with pytest.raises(ValueError):
        hs.update(spark, log, tmp, history_plan="auto")


def test_state_keeps_microseconds(spark, tmp):
    at = dt.datetime(2024, 10, 2, 3, 4, 5, 678901)
    done = hs.update(spark, log_df(spark, [row(at)]), tmp)
    assert hs.read_state(spark, tmp) == done.state and done.state.merged_through == at
