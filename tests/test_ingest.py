"""Ingest-clean edge cases (one test per case of the nested-record contract)."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campaignlake.operators import ingest
from campaignlake.schema import AD_COL, CAMPAIGN_COL, DATE_COL, LIFEDAY_COLS, LOADED_AT, LOG_COLS, LOG_SCHEMA
from campaignlake.sources import fixtures
from campaignlake.sources.records import money, parse_records, read_records, to_records

TS = dt.datetime(2024, 1, 2, 3, 4, 5)


def rec(**kw):
    base = {"date": "2024-10-01", "campaign": "C", "ad": "A", "cost": 100, "impressions": 10,
            "clicks": 2, "registrations": 1, "ctr": 0.2, "cr": 0.5, "cpc": 0.5,
            "metrics": [{"lifeday": ld, "players": 1, "payers": 1, "payments": 1, "revenue": 1.0}
                        for ld in (1, 3, 7, 14)]}
    for k, v in kw.items():
        if v is ...:
            base.pop(k, None)
        else:
            base[k] = v
    return base


def clean_rows(spark, *records, raw=None, **kw):
    docs = list(raw or []) + [json.dumps(r) for r in records]
    df = spark.createDataFrame([(d,) for d in docs], "value string")
    out = ingest.clean(parse_records(df), loaded_at=TS, **kw)
    return [r.asDict() for r in out.collect()]


def one(spark, **kw):
    rows = clean_rows(spark, rec(**kw))
    assert len(rows) == 1
    return rows[0]


def test_columns_in_log_order(spark):
    df = ingest.clean(parse_records(spark.createDataFrame([(json.dumps(rec()),)], "value string")),
                      loaded_at=TS)
    assert tuple(df.columns) == LOG_COLS
    r = df.first()
    assert r["_etl_loaded_at"] == TS and r["campaigns_execution_date"] == dt.date(2024, 10, 1)


def test_money_truncates_toward_zero(spark):
    r = one(spark, cpc=1.999, metrics=[{"lifeday": 1, "revenue": 0.005}])
    assert r["cpc_cents"] == 199 and r["revenue_1d_cents"] == 0


def test_half_up_option(spark):
    rows = clean_rows(spark, rec(cpc=1.995), rounding="half_up")
    assert rows[0]["cpc_cents"] == 200


def test_negative_money_truncates_then_clips(spark):
    assert one(spark, cpc=-1.999)["cpc_cents"] == 0


def test_cost_is_already_cents(spark):
    assert one(spark, cost=12)["spend_cents"] == 12


@pytest.mark.parametrize("cost", [..., None, "", 0])
def test_missing_null_or_falsy_cost_is_zero(spark, cost):
    assert one(spark, cost=cost)["spend_cents"] == 0


@pytest.mark.parametrize("ad", [..., None])
def test_missing_or_null_ad_defaults(spark, ad):
    assert one(spark, ad=ad)["ad_name"] == "N/A"


@pytest.mark.parametrize("metrics", [..., [], None])
def test_missing_empty_null_metrics_give_zero(spark, metrics):
    r = one(spark, metrics=metrics)
    assert all(r[c] == 0 for c in LIFEDAY_COLS)


def test_duplicate_lifeday_last_wins(spark):
    r = one(spark, metrics=[{"lifeday": 1, "players": 5}, {"lifeday": 1, "players": 9}])
    assert r["players_1d"] == 9


def test_lifeday_number_or_string(spark):
    r = one(spark, metrics=[{"lifeday": "1", "players": 4}, {"lifeday": 3, "players": 6}])
    assert r["players_1d"] == 4 and r["players_3d"] == 6


def test_unknown_lifeday_ignored(spark):
    r = one(spark, metrics=[{"lifeday": 2, "players": 5}])
    assert all(r[c] == 0 for c in LIFEDAY_COLS)


def test_infinity_and_nan_become_zero(spark):
    raw = ['{"date":"2024-10-01","campaign":"C","ctr":Infinity,"cr":-Infinity,'
           '"metrics":[{"lifeday":1,"revenue":NaN}],"cpc":1e400}']
    r = clean_rows(spark, raw=raw)[0]
    assert r["ctr"] == 0.0 and r["cr"] == 0.0 and r["revenue_1d_cents"] == 0 and r["cpc_cents"] == 0


def test_non_numeric_is_zero_and_counted(spark):
    obs = Observation("q")
    rows = clean_rows(spark, rec(clicks="abc"), observation=obs)
    assert rows[0]["clicks"] == 0
    assert obs.get["non_numeric__clicks"] == 1


def test_negative_count_clipped_and_counted(spark):
    obs = Observation("q2")
    rows = clean_rows(spark, rec(clicks=-3), observation=obs)
    assert rows[0]["clicks"] == 0 and obs.get["negative__clicks"] == 1


def test_fractional_count_row_policy(spark):
    rows = clean_rows(spark, rec(clicks=1.5), rec(clicks=2))
    assert sorted(r["clicks"] for r in rows) == [0, 2]


def test_fractional_count_column_policy(spark):
    rows = clean_rows(spark, rec(clicks=1.5), rec(clicks=2), cast_failure="column")
    assert [r["clicks"] for r in rows] == [0, 0]
    # other columns are untouched
    assert all(r["impressions"] == 10 for r in rows)


def test_column_policy_is_per_chunk(spark):
    from pyspark.sql import functions as F
    from campaignlake.schema import RECORD_SCHEMA
    docs = [(json.dumps(rec(clicks=1.5)), 1), (json.dumps(rec(clicks=2)), 2)]
    df = spark.createDataFrame(docs, "value string, chunk int")
    recs = df.select(F.from_json("value", RECORD_SCHEMA).alias("r"), "chunk").select("r.*", "chunk")
    out = ingest.clean(recs, loaded_at=TS, cast_failure="column", chunk_col="chunk").collect()
    assert sorted(r["clicks"] for r in out) == [0, 2]


def test_bad_date_goes_to_rejects(spark):
    docs = [json.dumps(rec(date="x")), json.dumps(rec(date=...)), json.dumps(rec())]
    df = parse_records(spark.createDataFrame([(d,) for d in docs], "value string"))
    assert ingest.clean(df, loaded_at=TS).count() == 1
    reasons = sorted(r["reject_reason"] for r in ingest.rejects(df).collect())
    assert reasons == ["bad_date", "missing_date"]
    with pytest.raises(ValueError):
        ingest.clean(df, loaded_at=TS, strict=True)


def test_empty_batch(spark):
    df = parse_records(spark.createDataFrame([], "value string"))
    assert ingest.clean(df, loaded_at=TS).count() == 0


def test_fill_numeric_none_keeps_nulls(spark):
    rows = clean_rows(spark, rec(clicks="abc"), fill_numeric=None)
    assert rows[0]["clicks"] is None


def test_large_integer_exact(spark):
    assert one(spark, impressions="9007199254740993")["impressions"] == 9007199254740993


def test_read_records_multiline_file(spark, tmp):
    path = f"{tmp}/batch.json"
    with open(path, "w") as fh:
        json.dump([rec(), rec(campaign="D", cpc="0.07")], fh)
    df = read_records(spark, path)
    rows = sorted(ingest.clean(df, loaded_at=TS).collect(), key=lambda r: r["campaign_name"])
    assert [r["campaign_name"] for r in rows] == ["C", "D"]
    assert rows[1]["cpc_cents"] == 7


def test_cost_in_currency_units(spark):
    costs = [12.349, "7.5", "1e2", -3, "n/a", None, ..., "", "NaN", 0.001]
    rows = clean_rows(spark, *(rec(cost=c) for c in costs), cost_unit="currency")
    assert [r["spend_cents"] for r in rows] == [1234, 750, 10000, 0, 0, 0, 0, 0, 0, 0]
    assert all(r["cpc_cents"] == 50 for r in rows)
    assert clean_rows(spark, rec(cost=12.345), cost_unit="currency", rounding="half_up")[0]["spend_cents"] == 1235
    # As cents the cost is a whole number, as before.
    assert [r["spend_cents"] for r in clean_rows(spark, rec(cost=1234), rec(cost=12.5))] == [1234, 0]
    counts = {r["column_name"]: r["cast_failed"] for r in ingest.quality_counts(parse_records(spark.createDataFrame(
        [(json.dumps(rec(cost=12.5)),)], "value string")), cost_unit="currency").collect()}
    assert counts["spend_cents"] == 0
    with pytest.raises(ValueError, match="cost_unit"):
        one_row = spark.createDataFrame([(json.dumps(rec()),)], "value string")
        ingest.clean(parse_records(one_row), cost_unit="dollars")


def test_clean_is_idempotent_on_its_output(spark):
    from campaignlake.sources.records import to_records
    first = ingest.clean(parse_records(spark.createDataFrame([(json.dumps(rec(cpc=1.239)),)], "value string")),
                         loaded_at=TS)
    again = ingest.clean(parse_records(to_records(first)), loaded_at=TS)
    assert [r.asDict() for r in first.collect()] == [r.asDict() for r in again.collect()]


def test_quality_counts_one_row_per_metric(spark):
    df = parse_records(spark.createDataFrame([(json.dumps(rec(clicks=-1, ctr="Infinity", cost=1.5)),)],
                                             "value string"))
    got = {r["column_name"]: r.asDict() for r in ingest.quality_counts(df).collect()}
    assert len(got) == 23
    assert got["clicks"]["negative"] == 1 and got["ctr"]["non_finite"] == 1
    assert got["spend_cents"]["cast_failed"] == 1


def test_session_with_default_limit_gets_compiled_code(spark):
    key, mine = "spark.sql.codegen.hugeMethodLimit", spark.newSession()
    df = mine.createDataFrame([(json.dumps(rec()),)], "value string")
    for had, has in (("65535", "8000"), ("20000", "20000")):  # Spark's default, and a caller's choice
        mine.conf.set(key, had)
        ingest.clean(parse_records(df), loaded_at=TS)
        assert mine.conf.get(key) == has


def test_number_texts_with_letters(spark):
    texts = ["1e3", "1E3", "12D", "1.5f", "0x1F", "0X1", "Infinity", "-7", "5d ", "def", " 4"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", ingest._as_number(F.col("t")).alias("d"))
    assert {r.t: r.d for r in got.collect()} == {
        "1e3": 1000.0, "1E3": 1000.0, "12D": None, "1.5f": None, "0x1F": None, "0X1": None, "Infinity": float("inf"),
        "-7": -7.0, "5d ": None, "def": None, " 4": 4.0}


def _log_rows(spark):
    number = {"long": 1234, "double": 0.25}
    def row(day, ad, cents):
        values = {DATE_COL: day, CAMPAIGN_COL: 'a "b" \\ c', AD_COL: ad, LOADED_AT: TS, "cpc_cents": cents}
        return tuple(values.get(f.name, number.get(f.dataType.typeName())) for f in LOG_SCHEMA)
    rows = [row(dt.date(2024, 1 + i % 3, 2), f"ad{i}", c) for i, c in enumerate([0, 5, -7, 123456, 10**17, 3, 8, 14])]
    return spark.createDataFrame([*rows, row(None, "undated", 0)], T.StructType(
        [T.StructField(f.name, f.dataType) for f in LOG_SCHEMA]))


def test_landing_is_compressed_and_whole(spark, tmp):
    log = _log_rows(spark)
    docs = {"plain": to_records(log), "dirty": fixtures.dirty_records(log)}
    fixtures.land(log, f"{tmp}/plain")
    fixtures.land_dirty(log, f"{tmp}/dirty")
    for kind, made in docs.items():
        files = [f for _, _, fs in os.walk(f"{tmp}/{kind}") for f in fs if f.startswith("part-")]
        assert files and all(f.endswith(".gz") for f in files)
        landed = spark.read.text(f"{tmp}/{kind}")
        assert sorted(r.value for r in landed.collect()) == sorted(r.value for r in made.collect())
        assert {str(r.execution_month) for r in landed.select("execution_month").collect()} == {
            "2024-01-01", "2024-02-01", "2024-03-01", "None"}
        assert ingest.clean(read_records(spark, f"{tmp}/{kind}"), loaded_at=TS).count() == 8


def test_landing_moves_typed_rows_not_documents(spark, tmp, monkeypatch):
    plans = []
    monkeypatch.setattr(fixtures, "_write_landing",
                        lambda docs, path: plans.append(docs._jdf.queryExecution().optimizedPlan().toString()))
    log = _log_rows(spark)
    fixtures.land(log, tmp)
    fixtures.land_dirty(log, tmp)
    for plan in plans:
        above, below = plan.split("RebalancePartitions")
        assert "AS value" in above and "AS value" not in below


def test_cents_as_amounts(spark):
    cents = [0, 5, -5, 99, -123456, 10**17 + 1, 2**63 - 1, -2**63, None]
    got = spark.createDataFrame([(c,) for c in cents], "c long").select(money(F.col("c")).cast("string").alias("t"))
    assert [r.t for r in got.collect()] == ["0.00", "0.05", "-0.05", "0.99", "-1234.56", "1000000000000000.01",
                                            "92233720368547758.07", "-92233720368547758.08", None]
