"""Type-2 history: rebuild, incremental merge, current rows, as-of."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from campaignlake.operators import history
from campaignlake.schema import LOG_COLS, LOG_SCHEMA, SORTED_METRIC_COLS
from campaignlake.sources.fixtures import campaign_log

from .conftest import SF_SMALL

D = dt.date(2024, 10, 1)


def t(h):
    return dt.datetime(2024, 10, 2) + dt.timedelta(hours=h)


def row(ts, clicks=1, campaign="C", ad="A", day=D, spend=100):
    vals = {c: 0 for c in SORTED_METRIC_COLS}
    vals.update(clicks=clicks, spend_cents=spend, ctr=0.0, cr=0.0)
    d = {"campaigns_execution_date": day, "campaign_name": campaign, "ad_name": ad,
         "_etl_loaded_at": ts, **vals}
    return tuple(d[c] for c in LOG_COLS)


def log_df(spark, rows):
    return spark.createDataFrame(rows, LOG_SCHEMA)


def versions(df):
    return sorted((r["campaign_name"], r["valid_from"], r["valid_to"], r["clicks"]) for r in df.collect())


def test_unchanged_reload_is_not_a_version(spark):
    h = history.history_from_log(log_df(spark, [row(t(0)), row(t(1))]))
    assert versions(h) == [("C", t(0), None, 1)]


def test_include_load_ts_makes_every_reload_a_version(spark):
    h = history.history_from_log(log_df(spark, [row(t(0)), row(t(1))]), include_load_ts=True)
    assert versions(h) == [("C", t(0), t(1), 1), ("C", t(1), None, 1)]


def test_changed_metric_closes_and_opens(spark):
    h = history.history_from_log(log_df(spark, [row(t(0), 1), row(t(1), 2)]))
    assert versions(h) == [("C", t(0), t(1), 1), ("C", t(1), None, 2)]


def test_a_b_a_gives_three_versions(spark):
    h = history.history_from_log(log_df(spark, [row(t(0), 1), row(t(1), 2), row(t(2), 1)]))
    assert versions(h) == [("C", t(0), t(1), 1), ("C", t(1), t(2), 2), ("C", t(2), None, 1)]


def test_same_key_and_time_collapse_by_tiebreak(spark):
    h = history.history_from_log(log_df(spark, [row(t(0), 5), row(t(0), 9)]))
    assert versions(h) == [("C", t(0), None, 9)]


def test_key_missing_from_later_batch_stays_open(spark):
    h0 = history.history_from_log(log_df(spark, [row(t(0), 1, "C"), row(t(0), 1, "D")]))
    m = history.snapshot_merge(h0, log_df(spark, [row(t(1), 2, "C")]), merged_through=t(0))
    assert versions(m.history) == [("C", t(0), t(1), 1), ("C", t(1), None, 2), ("D", t(0), None, 1)]


def test_late_row_is_returned_not_merged(spark):
    h0 = history.history_from_log(log_df(spark, [row(t(1), 1), row(t(5), 1)]))
    m = history.snapshot_merge(h0, log_df(spark, [row(t(3), 2), row(t(6), 3)]), merged_through=t(5))
    assert [r["clicks"] for r in m.late.collect()] == [2]
    assert versions(m.history) == [("C", t(1), t(6), 1), ("C", t(6), None, 3)]


def test_null_key_parts_are_a_key(spark):
    h = history.history_from_log(log_df(spark, [row(t(0), 1, campaign=None), row(t(1), 2, campaign=None)]))
    assert [r["valid_to"] for r in h.orderBy("valid_from").collect()] == [t(1), None]
    assert h.where(F.col("scd_id").isNull()).count() == 0


def test_latest_per_key(spark):
    df = log_df(spark, [row(t(0), 1), row(t(2), 7), row(t(2), 3), row(t(1), 9, "D")])
    got = sorted((r["campaign_name"], r["clicks"]) for r in history.latest_per_key(df).collect())
    assert got == [("C", 7), ("D", 9)]


def test_as_of(spark):
    h = history.history_from_log(log_df(spark, [row(t(0), 1), row(t(2), 2)]))
    assert [r["clicks"] for r in history.as_of(h, t(1)).collect()] == [1]
    assert [r["clicks"] for r in history.as_of(h, t(2)).collect()] == [2]
    assert history.as_of(h, t(-1)).count() == 0


@pytest.fixture(scope="module")
def small_log(spark):
    return campaign_log(spark, SF_SMALL).cache()


def _set(df):
    rows = [tuple(r) for r in df.select(*sorted(df.columns)).collect()]
    return sorted(rows, key=lambda t: tuple((v is None, v if v is not None else 0) for v in t))


def test_fold_of_merges_equals_rebuild(spark, small_log):
    """Merging time-ordered batches one by one gives exactly the full rebuild."""
    cuts = [dt.datetime(y, 1, 1) for y in (1996, 1997, 1998, 1999, 2000, 2001)]
    ts = F.col("_etl_loaded_at")
    hist = history.history_from_log(small_log.where(ts < F.lit(cuts[0])))
    for lo, hi in zip(cuts, cuts[1:] + [dt.datetime(2100, 1, 1)]):
        batch = small_log.where((ts >= F.lit(lo)) & (ts < F.lit(hi)))
        m = history.snapshot_merge(hist, batch, merged_through=lo - dt.timedelta(microseconds=1))
        assert m.late.count() == 0
        hist = m.history.checkpoint()  # cut the growing lineage (reliable checkpoint dir)
    assert _set(hist) == _set(history.history_from_log(small_log))


def test_intervals_do_not_overlap_and_one_open_per_key(spark, small_log):
    h = history.history_from_log(small_log)
    keys = ["campaigns_execution_date", "campaign_name", "ad_name"]
    per_key = h.groupBy(*keys).agg(F.sum(F.col("valid_to").isNull().cast("int")).alias("open"))
    assert per_key.where("open != 1").count() == 0
    bad = h.where(F.col("valid_to").isNotNull() & (F.col("valid_to") <= F.col("valid_from")))
    assert bad.count() == 0


def test_current_rows_equal_latest_values(spark, small_log):
    cur = history.current(history.history_from_log(small_log)).drop(
        "valid_from", "valid_to", "scd_id", "_etl_loaded_at")
    latest = history.latest_per_key(small_log).drop("_etl_loaded_at")
    assert _set(cur) == _set(latest)


def test_merge_or_rebuild_handles_late_rows_exactly(spark):
    # A@1, A@5 (unchanged, not stored as a version), late B@3: only a rebuild keeps A, B, A.
    full = [row(t(1), 1), row(t(5), 1), row(t(3), 2)]
    h0 = history.history_from_log(log_df(spark, full[:2]))
    got = history.merge_or_rebuild(h0, log_df(spark, full[2:]), log_df(spark, full), merged_through=t(5))
    assert versions(got) == [("C", t(1), t(3), 1), ("C", t(3), t(5), 2), ("C", t(5), None, 1)]
    # in-order batch: plain merge
    got2 = history.merge_or_rebuild(h0, log_df(spark, [row(t(6), 4)]), log_df(spark, full[:2] + [row(t(6), 4)]),
                                    merged_through=t(5))
    assert versions(got2) == [("C", t(1), t(6), 1), ("C", t(6), None, 4)]


def test_split_history_equals_history(spark, small_log):
    assert _set(history.history_from_log_split(small_log)) == _set(history.history_from_log(small_log))


def test_split_history_hot_key_across_days(spark):
    # one key loaded 40 times over 5 days with A/B/A changes, plus a NULL-campaign key
    rows = []
    for i in range(40):
        rows.append(row(t(i * 3), clicks=(i // 4) % 3))
        rows.append(row(t(i * 3), clicks=(i // 4) % 3))          # exact copy
        rows.append(row(t(i * 5), clicks=i % 2, campaign=None))
    df = log_df(spark, rows)
    assert _set(history.history_from_log_split(df)) == _set(history.history_from_log(df))


@pytest.mark.parametrize("include_load_ts", [False, True])
def test_null_load_times_give_the_same_versions_in_every_plan(spark, include_load_ts):
    rows = [row(None), row(t(0)), row(t(30)), row(None, 2, "D"), row(t(1), 2, "D"), row(t(40), 3, "D")]
    df = log_df(spark, rows)
    want = _set(history.history_from_log(df, include_load_ts=include_load_ts))
    assert _set(history.history_from_log_split(df, include_load_ts=include_load_ts)) == want
    assert _set(history.history_from_log(df, precombine=True, include_load_ts=include_load_ts)) == want
    if not include_load_ts:
        assert [v[:2] for v in versions(history.history_from_log(df).where("campaign_name = 'C'"))] == [("C", None)]


@pytest.mark.parametrize("include_load_ts", [False, True])
def test_precombined_history_equals_history_with_ties_nulls_and_signed_zeros(spark, include_load_ts):
    # Loads with several rows and copies, null keys, times and values, and both zeros; also rows of a key and a time only.
    values = [None, -0.0, 0.0, 1.5, float("nan")]
    rows = [(i % 7 or None, t(i % 4) if i % 5 else None, values[i % 3 + i % 2], i % 11 or None, "ab"[i % 2]) for i in range(300)]
    df = spark.createDataFrame(rows * 2, "k int, loaded timestamp_ntz, x double, n long, s string").repartition(5)
    for part in (df, df.select("k", "loaded")):
        want, got = (history.history_from_log(part, ["k"], "loaded", include_load_ts=include_load_ts, precombine=p)
                     for p in (False, True))
        assert got.columns == want.columns and got.dtypes == want.dtypes
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) != []


def test_null_load_time_in_a_batch_is_late(spark):
    h0 = history.history_from_log(log_df(spark, [row(t(0))]))
    m = history.snapshot_merge(h0, log_df(spark, [row(None, 9), row(t(2), 3)]), merged_through=t(0))
    assert [r["clicks"] for r in m.late.collect()] == [9]
    assert versions(m.history) == [("C", t(0), t(2), 1), ("C", t(2), None, 3)]


def test_merge_needs_merged_through(spark):
    h0 = history.history_from_log(log_df(spark, [row(t(1)), row(t(5))]))
    with pytest.raises(TypeError):
        history.snapshot_merge(h0, log_df(spark, [row(t(3), 2)]))
    with pytest.raises(ValueError):
        history.snapshot_merge(h0, log_df(spark, [row(t(3), 2)]), None)
    first = history.snapshot_merge(h0.where("false"), log_df(spark, [row(t(3), 2)]), None)
    assert versions(first.history) == [("C", t(3), None, 2)] and first.late.count() == 0


def test_storage_columns_are_not_checked(spark):
    df = log_df(spark, [row(t(0)), row(t(1))]).withColumn("load_batch", F.col("_etl_loaded_at").cast("string"))
    assert history.history_from_log(df).count() == history.history_from_log_split(df).count() == 1


def _asked(rows, key, at):
    """The clicks of the newest version of the key that begins no later than the instant; plain Python."""
    known = [(start, clicks) for k, start, clicks in rows if k == key and at is not None and start <= at]
    return max(known)[1] if known else None


def _as_of_table(spark, versions_of, asked):
    hist = spark.createDataFrame([(k, None if k == "K0" else "x", start, None, clicks) for k, start, clicks in versions_of],
                                 "campaign string, ad string, valid_from timestamp_ntz, valid_to timestamp_ntz, clicks long")
    probes = spark.createDataFrame([(n, k, None if k == "K0" else "x", at) for n, (k, at) in enumerate(asked)],
                                   "n int, campaign string, ad string, at timestamp_ntz")
    return history.as_of_join(probes, hist, "at", keys=["campaign", "ad"], columns=["clicks", "valid_from"]), probes, hist


def test_as_of_join_equals_a_search_through_all_versions(spark):
    # K0 (a null key part): 100 versions within a day, more than a block; K1: one, open for years; K2, K3: some days apart.
    minute = dt.timedelta(minutes=1)
    rows = [("K0", t(0) + 7 * i * minute, i) for i in range(100)] + [("K1", t(0), 1)]
    rows += [(f"K{k}", t(24 * day * k), day) for k in (2, 3) for day in range(6)]
    instants = [None, t(-500), t(0) - minute, t(0), t(0) + minute, t(11), t(11) + minute, t(12), t(24), t(30), t(200), t(24 * 900)]
    instants += [t(0) + 7 * i * minute for i in (31, 32, 33, 63, 64, 65, 99)]
    asked = [(f"K{k}", at) for k in range(5) for at in instants] * 2
    got, probes, _ = _as_of_table(spark, rows, asked)
    assert got.columns == ["n", "campaign", "ad", "at", "clicks", "valid_from"]
    found = {r["n"]: r["clicks"] for r in got.collect()}
    assert len(found) == got.count() == len(asked)
    assert found == {n: _asked(rows, k, at) for n, (k, at) in enumerate(asked)}


def test_as_of_join_keeps_clashing_names_other_key_types_and_maps(spark):
    hist = spark.createDataFrame([(1, t(0), {"a": 1}, 5), (2, t(1), {"b": 2}, 6)],
                                 "k int, valid_from timestamp_ntz, m map<string,int>, clicks int")
    probes = spark.createDataFrame([(2, t(9), 77), (3, t(9), 78)], "k long, at timestamp_ntz, clicks int")
    got = history.as_of_join(probes, hist, "at", keys=["k"], columns=["m", "clicks"])
    assert got.columns == ["k", "at", "clicks", "m", "clicks"]
    assert sorted(map(tuple, got.collect())) == [(2, t(9), 77, {"b": 2}, 6), (3, t(9), 78, None, None)]


def test_as_of_join_deals_the_probes_of_a_hot_key_to_many_tasks(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = [(f"K{k}", t(0), k) for k in range(20)]
        got, *_ = _as_of_table(spark, rows, [(f"K{max(0, i - 19980)}", t(1)) for i in range(20000)])
        assert {(r["campaign"], r["clicks"]) for r in got.collect()} == {(k, n) for k, _, n in rows}
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
