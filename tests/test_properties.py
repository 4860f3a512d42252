"""Property-based tests (hypothesis): ingest invariants and load-window coverage."""

import datetime as dt
import json
from decimal import ROUND_DOWN, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from campaignlake.operators import ingest, windows
from campaignlake.schema import LIFEDAYS, LOG_COLS, METRIC_COLS
from campaignlake.sources.records import parse_records

TS = dt.datetime(2024, 1, 1)
SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])

number = st.one_of(
    st.integers(min_value=-10**6, max_value=10**12),
    st.decimals(min_value=-10**6, max_value=10**6, places=3, allow_nan=False, allow_infinity=False).map(str),
    st.sampled_from(["abc", "", "Infinity", "-Infinity", "NaN", None, "1e400", " 7 "]),
)
metric = st.fixed_dictionaries({
    "lifeday": st.sampled_from([1, 3, 7, 14, 2, "1", "14", "1.0"]),
    "players": number, "payers": number, "payments": number, "revenue": number,
})
record = st.fixed_dictionaries({
    "date": st.dates(min_value=dt.date(2000, 1, 1), max_value=dt.date(2030, 12, 31)).map(str),
    "campaign": st.text(min_size=1, max_size=5),
    "cost": number, "impressions": number, "clicks": number, "registrations": number,
    "ctr": number, "cr": number, "cpc": number,
    "metrics": st.one_of(st.none(), st.lists(metric, max_size=6)),
}, optional={"ad": st.one_of(st.none(), st.text(max_size=4))})


@SETTINGS
@given(st.lists(record, min_size=1, max_size=8))
def test_clean_invariants(spark, recs):
    df = parse_records(spark.createDataFrame([(json.dumps(r),) for r in recs], "value string"))
    rows = [r.asDict() for r in ingest.clean(df, loaded_at=TS).collect()]
    assert len(rows) == len(recs)
    for row in rows:
        assert list(row) == list(LOG_COLS)
        for c in METRIC_COLS:
            v = row[c]
            assert v is not None and v >= 0, (c, v)
        assert row["ad_name"] is not None
        assert row["_etl_loaded_at"] == TS


def _cents(x):
    return int((Decimal(str(x)) * 100).to_integral_value(rounding=ROUND_DOWN))


amount = st.one_of(
    *(st.decimals(min_value=0, max_value=10**9, places=p, allow_nan=False).map(lambda d: f"{d:f}") for p in range(16)),
    st.decimals(min_value=0, max_value=10**6, places=12, allow_nan=False).map(lambda d: f"{d:e}"),
    st.sampled_from(["19.999999999", "1.9999999999", "0.29999999999", "1.5e1", "1E-3", "2.999e+2", "7.", "1999999e-5"]))


@SETTINGS
@given(st.lists(amount, min_size=1, max_size=6))
def test_money_matches_exact_decimal_truncation(spark, amounts):
    recs = [{"date": "2024-10-01", "campaign": "C", "cpc": str(a),
             "metrics": [{"lifeday": ld, "revenue": str(a)} for ld in LIFEDAYS]} for a in amounts]
    df = parse_records(spark.createDataFrame([(json.dumps(r),) for r in recs], "value string"))
    got = sorted(r["cpc_cents"] for r in ingest.clean(df, loaded_at=TS).collect())
    assert got == sorted(_cents(a) for a in amounts)


@SETTINGS
@given(st.dates(min_value=dt.date(2001, 1, 1), max_value=dt.date(2040, 1, 1)),
       st.integers(min_value=0, max_value=800))
def test_windows_disjoint_and_covering(spark, target, back):
    hwm = target - dt.timedelta(days=back)
    ws = [(r["chunk"], r["window_start"], r["window_end"])
          for r in windows.incremental_windows(spark, hwm, target).orderBy("chunk").collect()]
    days = []
    for _, s, e in ws:
        assert s <= e and (s.year, s.month) == (e.year, e.month)
        days += [s + dt.timedelta(days=i) for i in range((e - s).days + 1)]
    assert days == [hwm + dt.timedelta(days=i + 1) for i in range(back)]
