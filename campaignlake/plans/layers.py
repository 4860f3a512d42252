"""Build the layers in order -- history, staging, core, reporting -- each followed by its checks.

A layer's checks run right after it is built; any failure raises
:class:`~campaignlake.operators.checks.CheckFailed` and stops the chain
before the next layer, as a staged warehouse build does.  History and the
core tables are persisted (written below the shared checkpoint folder, or a
given warehouse path) so the later layers read files rather than the whole
lineage; staging and the reports stay lazy views.  Tables below the checkpoint
folder go with :meth:`Layers.drop_scratch` once nothing reads them any more.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..operators import checks, history, kpi, star
from ..schema import DIM_DATES_END, DIM_DATES_START, KEY_COLS, STORAGE_COLS
from ..session import drop_path, scratch_path
from ..sources.sinks import materialize
from . import history_store, incremental, month_tables

STAGES = ("snapshot", "staging", "core", "reporting")


@dataclass
class Layers:
    tables: dict[str, DataFrame] = field(default_factory=dict)
    check_results: dict[str, DataFrame] = field(default_factory=dict)
    history_update: history_store.Update | None = None
    fact_update: incremental.Patched | None = None
    totals_update: incremental.Patched | None = None
    checked_months: list[str] | None = None  # of a stored history: the months that the gates looked at (None: all)
    scratch: list[str] = field(default_factory=list)  # tables written below the checkpoint folder

    def drop_scratch(self, spark: SparkSession) -> None:
        """Delete the intermediate tables; call it when nothing reads the layers any more."""
        while self.scratch:
            drop_path(spark, self.scratch.pop())


def _passed(spark: SparkSession, path: str, span: list[str]) -> int:
    """The merge up to which all gates have passed with these settings; -1 if there is none."""
    found = month_tables.read_state(spark, path)
    return found[0] if found and found[1]["span"] == span else -1


def build_layers(log: DataFrame, *, warehouse: str | None = None,
                 date_range=(DIM_DATES_START, DIM_DATES_END), persist: bool = True,
                 stop_after: str | None = None, include_load_ts: bool = False,
                 history_plan: str = "default") -> Layers:
    """Run snapshot -> staging -> core -> reporting with a check gate after each.

    With a ``warehouse`` the history is kept there and merged forward, and the
    fact and the monthly totals are patched by what the merge changed: a run
    reads and writes the months that have new log rows (see
    :mod:`.history_store` and :mod:`.incremental`).  Otherwise all is built from
    the whole log.

    The row-level checks of a run with a ``warehouse`` look at the months written
    since the gates last passed, not at the whole log: a row key includes its
    date, so a repeated key, a null or a missing parent lies within a month, and the
    dimensions hold the names of all months.  A run that fails a gate leaves its
    months unchecked, and the next run looks at them again.

    ``history_plan`` is how a build from the whole log runs: ``"default"`` (one
    exchange) or ``"split"`` (windows per key and load day, for keys restated
    very many times).
    """
    if history_plan not in history_store.PLANS:
        raise ValueError(f"unknown history_plan {history_plan!r}, expected one of {history_store.PLANS}")
    spark = log.sparkSession
    out = Layers()
    rows = log.drop(*STORAGE_COLS)

    def keep(df: DataFrame, name: str, kind: str) -> DataFrame:
        kind = kind if persist else "view"
        path = None
        if kind == "table":
            path = f"{warehouse.rstrip('/')}/{name}" if warehouse else scratch_path(spark, name)
            if not warehouse:
                out.scratch.append(path)
        df = materialize(df, name, kind, path)
        out.tables[name] = df
        return df

    # snapshot: type-2 history of the log; the source tests guard its input.
    source, months, stored = log, None, bool(warehouse and persist)
    if stored:
        path, marker = (f"{warehouse.rstrip('/')}/{n}" for n in ("scd_campaign_performance", "checked"))
        span = [str(d) for d in date_range]
        todo = history_store.pending(spark, log, path, include_load_ts=include_load_ts)
        if todo.before is None:  # merges are numbered from 0 again
            drop_path(spark, marker)
        passed = _passed(spark, marker, span)
        if not todo.whole and passed >= todo.before.base:
            months = sorted({*todo.months, *history_store.months_since(todo.before, passed)})
            source = history_store.log_rows(log, months)
        out.checked_months = months
    out.check_results["snapshot"] = checks.gate("snapshot", [
        checks.not_null(source, ["campaigns_execution_date", "campaign_name"], "campaign_performance_raw_appends")])
    if stored:
        out.history_update = history_store.update(spark, log, path, history_plan=history_plan, todo=todo,
                                                  include_load_ts=include_load_ts)
        state = out.history_update.state
        hist = history_store.read_history(spark, path, state)
        if hist is None:  # an empty log has no version
            hist = history.history_from_log(rows.where("false"))
            now = hist
        else:
            now = history_store.open_versions(spark, path, state)
        keep(hist, "scd_campaign_performance", "view")
    else:
        build = history.history_from_log_split if history_plan == "split" else history.history_from_log
        more = {"scratch": out.scratch} if history_plan == "split" else {}
        hist = keep(build(rows, include_load_ts=include_load_ts, **more), "scd_campaign_performance", "table")
        now = history.current(hist)
    if stop_after == "snapshot":
        return out

    stg = keep(star.staging(now, only_current=False), "stg_campaign_performance", "view")
    some = stg
    if months is not None:
        some = history_store.open_versions(spark, path, state, months)
        some = stg.where("false") if some is None else star.staging(some, only_current=False)
    out.check_results["staging"] = checks.gate("staging", [
        checks.unique(some, "campaign_performance_sk", "stg_campaign_performance")])
    if stop_after == "staging":
        return out

    totals = fact = None
    if stored:  # patched by what the merge changed, month by month
        fact_path, totals_path = (f"{warehouse.rstrip('/')}/{n}" for n in ("fct_daily_performance", "monthly_totals"))
        out.fact_update = incremental.update_fact(spark, path, fact_path, date_range)
        out.totals_update = incremental.update_totals(spark, path, totals_path)
        totals = incremental.read_totals(spark, totals_path, out.totals_update)
        fact = incremental.read_fact(spark, fact_path, out.fact_update)
    names = stg if totals is None else totals
    dim_c = keep(star.dim_campaigns(names), "dim_campaigns", "table")
    dim_a = keep(star.dim_ads(names, dim_c), "dim_ads", "table")
    dim_d = keep(star.dim_dates(spark, *date_range), "dim_dates", "table")
    if fact is None:
        fact = keep(star.fact_daily(stg, dim_d, dim_c, dim_a), "fct_daily_performance", "view" if stored else "table")
    else:
        fact = keep(fact, "fct_daily_performance", "view")
    some = fact
    if months is not None:
        some = incremental.read_fact(spark, fact_path, out.fact_update, months)
        some = fact.where("false") if some is None else some
    out.check_results["core"] = checks.gate("core", [
        checks.unique(dim_c, "campaign_key", "dim_campaigns"),
        checks.unique(dim_a, "ad_key", "dim_ads"),
        checks.unique(dim_d, "date_key", "dim_dates"),
        checks.relationships_of(some, [("campaign_key", dim_c, "campaign_key"), ("ad_key", dim_a, "ad_key")],
                                "fct_daily_performance"),
    ])
    if stop_after == "core":
        return out

    if totals is None:
        monthly, report = kpi.monthly_campaign_summary(stg), kpi.rpt_monthly_campaign_summary(stg)
    else:
        sums = incremental.monthly_totals(totals)
        monthly, report = kpi.summary_of_totals(sums), kpi.report_of_totals(sums)
    keep(monthly, "monthly_campaign_summary", "view")
    keep(report, "rpt_monthly_campaign_summary", "view")
    keep(kpi.rpt_campaign_deep_dive(stg), "rpt_campaign_deep_dive", "view")
    keep(kpi.monthly_from_log(log), "test_monthly_campaign_summary", "view")
    out.check_results["reporting"] = checks.gate("reporting", [
        checks.not_null(monthly, ["report_month", "campaign_name"], "monthly_campaign_summary"),
        checks.expression_is_true(monthly, "roas_3d", ">= 0", "monthly_campaign_summary"),
        checks.expression_is_true(monthly, "cpi", ">= 0", "monthly_campaign_summary"),
    ])
    if stored and passed != state.merge:
        month_tables.write_state(spark, marker, state.merge, {"span": span})
    return out


def natural_key_unique(log: DataFrame) -> DataFrame:
    """Uniqueness of the natural key in the log (expected to fail: the log keeps every version)."""
    return checks.unique(log, list(KEY_COLS), "campaign_performance_raw_appends")
