"""The fact and the monthly totals, patched from what a merge of the history changed.

Both are stored by month (:mod:`.month_tables`) and remember the merge they are
up to.  An update takes the changes since then (:func:`.history_store.read_changes`)
and reads and writes only the months they name:

* the fact loses the rows of changed keys and gains the rows now open;
* the totals per (month, campaign, ad) get signed sums: a closed version
  subtracts its values, an opened one adds.  No version that stayed is read.

Campaigns, ads and the monthly reports are small aggregates of the totals.
After a rebuild of the whole history, or of a calendar, both are built anew.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.money import cents_to_eur
from ..operators import star
from ..schema import (AD_COL, CAMPAIGN_COL, DATE_COL, DIM_DATES_END, DIM_DATES_START, KEY_COLS, LIFEDAYS, LOADED_AT,
                      VALID_FROM, lifeday_cols)
from ..session import drop_path
from . import history_store, month_tables
from .month_tables import MERGE, MONTH, MonthTable

KEY = "__key"
COUNTED = ["spend_cents", "impressions", "clicks", "registrations",
           *(c for ld in LIFEDAYS for c in (lifeday_cols(ld)[0], lifeday_cols(ld)[1], lifeday_cols(ld)[3]))]
TOTAL_GROUP = [MONTH, CAMPAIGN_COL, AD_COL]


@dataclass(frozen=True)
class Patched:
    parts: dict[str, list[int]]
    kind: str                      # "rebuilt", "patched" or "current"
    months: tuple[str, ...] = ()   # months written


def _update(spark: SparkSession, history_path: str, path: str, options: list,
            whole: Callable[[DataFrame], DataFrame],
            patch: Callable[[DataFrame | None, DataFrame], DataFrame]) -> Patched:
    state = history_store.read_state(spark, history_path)
    if state is None:
        raise ValueError(f"no history at {history_path}")
    path, table = path.rstrip("/"), MonthTable(spark, path)
    own = month_tables.read_state(spark, path)
    number, body = own if own else (-1, {})
    parts = body.get("parts", {})
    if own and body["options"] == options and body["through"] >= state.base:
        if body["through"] == state.merge:
            return Patched(parts, "current")
        feed, kind = history_store.read_changes(spark, history_path, state, body["through"]), "patched"
        months = sorted(m for m, ns in state.changes.items() if ns[-1] > body["through"])
        out = None if feed is None else patch(table.read(parts, months), feed)
    else:
        now, kind, months = history_store.open_versions(spark, history_path, state, with_month=True), "rebuilt", sorted(
            {*parts, *state.open})
        out = None if now is None else whole(now)
    written = table.write(out, number + 1, months) if out is not None else []
    void = [table.folder(m, n) for m in months for n in parts.get(m, [])]
    parts = {**{m: ns for m, ns in parts.items() if m not in months}, **{m: [number + 1] for m in written}}
    month_tables.write_state(spark, path, number + 1,
                             {"through": state.merge, "options": options, "parts": parts, "void": void})
    for folder in body.get("void", []):
        drop_path(spark, folder)
    return Patched(parts, kind, tuple(months))


def _key() -> Column:
    """The natural key as one text, with nulls apart from any value."""
    return F.to_json(F.array(*(F.col(c).cast("string") for c in KEY_COLS)))


def now_open(feed: DataFrame) -> DataFrame:
    """The last change of each key: the row now open (``sign`` 1), or that none is (-1)."""
    rest = [c for c in feed.columns if c not in (*KEY_COLS, MONTH, MERGE, "sign")]
    last = F.max(F.struct(MERGE, "sign", *rest)).alias("last")
    grouped = feed.groupBy(*KEY_COLS, MONTH).agg(last)
    return grouped.select(*KEY_COLS, MONTH, "last.sign", *(f"last.{c}" for c in rest))


def _fact_rows(rows: DataFrame, date_range) -> DataFrame:
    """Fact rows of open log rows, with their month and key."""
    stg = star.staging(rows.withColumn(VALID_FROM, F.col(LOADED_AT)), only_current=False)
    fact = star.fact_daily(stg.withColumn(DATE_COL, F.col("report_date")), date_range=date_range, carry=(DATE_COL,))
    return fact.withColumn(KEY, _key()).withColumn(MONTH, F.trunc(DATE_COL, "MM")).drop(DATE_COL)


def update_fact(spark: SparkSession, history_path: str, path: str,
                date_range=(DIM_DATES_START, DIM_DATES_END)) -> Patched:
    """The stored daily fact, brought up to the history."""
    def patch(old: DataFrame | None, feed: DataFrame) -> DataFrame:
        last = now_open(feed)
        fresh = _fact_rows(last.where("sign = 1").drop("sign"), date_range)
        if old is None:
            return fresh
        stays = old.join(last.select(_key().alias(KEY)), KEY, "left_anti")
        return stays.select(fresh.columns).unionByName(fresh)

    return _update(spark, history_path, path, [str(d) for d in date_range],
                   lambda now: _fact_rows(now, date_range), patch)


def read_fact(spark: SparkSession, path: str, patched: Patched, months: list[str] | None = None) -> DataFrame | None:
    """The stored fact, of some months only if told which."""
    fact = MonthTable(spark, path).read(patched.parts, months)
    return None if fact is None else fact.drop(KEY, MONTH)


def _signed_totals(rows: DataFrame, sign: Column) -> DataFrame:
    aggs = [F.sum(sign).alias("n")]
    for c in COUNTED:
        aggs += [F.coalesce(F.sum(sign * F.col(c)), F.lit(0)).alias(c),
                 F.coalesce(F.sum(F.when(F.col(c).isNotNull(), sign)), F.lit(0)).alias(f"n_{c}")]
    return rows.groupBy(*TOTAL_GROUP).agg(*aggs)


def update_totals(spark: SparkSession, history_path: str, path: str) -> Patched:
    """Totals per (execution month, campaign, ad) of the open versions, brought up to the history."""
    def patch(old: DataFrame | None, feed: DataFrame) -> DataFrame:
        delta = _signed_totals(feed, F.col("sign"))
        if old is not None:
            both = old.select(delta.columns).unionByName(delta)
            delta = both.groupBy(*TOTAL_GROUP).agg(*(F.sum(c).alias(c) for c in delta.columns if c not in TOTAL_GROUP))
        return delta.where("n > 0")

    return _update(spark, history_path, path, [], lambda now: _signed_totals(now, F.lit(1).cast("long")), patch)


def read_totals(spark: SparkSession, path: str, patched: Patched) -> DataFrame | None:
    return MonthTable(spark, path).read(patched.parts)


def monthly_totals(totals: DataFrame) -> DataFrame:
    """The columns that :func:`campaignlake.operators.kpi.summary_of_totals` and ``report_of_totals`` take."""
    # A sum without any value is null, as in SQL.
    total = {c: F.when(F.sum(f"n_{c}") > 0, F.sum(c)) for c in COUNTED}
    aggs = [cents_to_eur(total["spend_cents"]).alias("total_spend"),
            *(total[c].alias(f"total_{c}") for c in ("impressions", "clicks", "registrations"))]
    for ld in LIFEDAYS:
        players, payers, _, revenue = lifeday_cols(ld)
        aggs += [cents_to_eur(total[revenue]).alias(f"total_revenue_{ld}d"), total[payers].alias(f"total_{payers}"),
                 total[players].alias(f"total_{players}")]
    return totals.groupBy(F.col(MONTH).alias("report_month"), CAMPAIGN_COL).agg(*aggs)
