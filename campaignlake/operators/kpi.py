"""Monthly and daily marketing KPIs (ROAS, CPI, cost per payer, LTV, ARPPU, retention).

Aggregations group by (month, campaign): Spark plans a partial hash
aggregate per task and a final one after the shuffle, so a campaign holding a
third of all rows is reduced map-side to one row per task before it moves.
Currency sums are taken over integer cents (exact, order independent) and
divided once; KPI divisions go through :mod:`campaignlake.functions.ratios`.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import in_month, month_bucket
from ..functions.money import sum_eur
from ..functions.ratios import ratio_or_null, ratio_or_zero
from ..schema import CAMPAIGN_COL, DATE_COL, KEY_COLS, LIFEDAYS, LOADED_AT, VALID_TO

BASE_TOTALS = ("total_spend", "total_impressions", "total_clicks", "total_registrations",
               "total_payers_14d", "total_revenue_14d")
REPORT_COLS = ("report_month", CAMPAIGN_COL) + BASE_TOTALS


def _monthly_totals(stg: DataFrame, lifedays=LIFEDAYS) -> DataFrame:
    aggs = [
        sum_eur("spend_eur").alias("total_spend"),
        F.sum("impressions").alias("total_impressions"),
        F.sum("clicks").alias("total_clicks"),
        F.sum("registrations").alias("total_registrations"),
    ]
    for ld in lifedays:
        aggs += [sum_eur(f"revenue_{ld}d_eur").alias(f"total_revenue_{ld}d"),
                 F.sum(f"payers_{ld}d").alias(f"total_payers_{ld}d"),
                 F.sum(f"players_{ld}d").alias(f"total_players_{ld}d")]
    return stg.groupBy(month_bucket("report_date").alias("report_month"), F.col(CAMPAIGN_COL)).agg(*aggs)


def monthly_campaign_summary(stg: DataFrame) -> DataFrame:
    """Monthly totals per campaign with ROAS 3d, CPI, CPP 14d and 14d retention (NULL on zero)."""
    return summary_of_totals(_monthly_totals(stg, (3, 14)))


def summary_of_totals(m: DataFrame) -> DataFrame:
    """The summary's columns from monthly totals."""
    return m.select(
        *REPORT_COLS,
        ratio_or_null("total_revenue_3d", "total_spend").alias("roas_3d"),
        ratio_or_null("total_spend", "total_registrations").alias("cpi"),
        ratio_or_null("total_spend", "total_payers_14d").alias("cpp_14d"),
        ratio_or_null("total_players_14d", "total_registrations").alias("retention_rate_14d"),
    )


def rpt_monthly_campaign_summary(stg: DataFrame, ordered: bool = True) -> DataFrame:
    """Monthly report: base totals, ROAS 3d, CPI, CPP and retention for every lifeday."""
    return report_of_totals(_monthly_totals(stg), ordered)


def report_of_totals(m: DataFrame, ordered: bool = True) -> DataFrame:
    """The report's columns from monthly totals of all lifedays."""
    out = m.select(
        *REPORT_COLS,
        ratio_or_null("total_revenue_3d", "total_spend").alias("roas_3d"),
        ratio_or_null("total_spend", "total_registrations").alias("cpi"),
        *[ratio_or_null("total_spend", f"total_payers_{ld}d").alias(f"cpp_{ld}d") for ld in LIFEDAYS],
        *[ratio_or_null(f"total_players_{ld}d", "total_registrations").alias(f"retention_rate_{ld}d")
          for ld in LIFEDAYS],
    )
    return out.orderBy("report_month", CAMPAIGN_COL) if ordered else out


def rpt_campaign_deep_dive(stg: DataFrame) -> DataFrame:
    """Daily per-ad KPIs on the 7-day lifeday (row-local: no shuffle)."""
    return stg.select(
        "report_date", CAMPAIGN_COL, "ad_name", "spend_eur", "impressions", "clicks",
        "registrations", "revenue_7d_eur", "payers_7d", "players_7d", "payments_7d",
        ratio_or_null("revenue_7d_eur", "spend_eur").alias("roas_7d"),
        ratio_or_null("spend_eur", "payers_7d").alias("cpp_7d_eur"),
        ratio_or_null("spend_eur", "players_7d").alias("cpl_7d_eur"),
        ratio_or_null("revenue_7d_eur", "registrations").alias("ltv_7d_eur"),
        ratio_or_null("revenue_7d_eur", "payers_7d").alias("arppu_7d_eur"),
        ratio_or_null("players_7d", "registrations").alias("retention_rate_7d"),
        ratio_or_null("payers_7d", "registrations").alias("payer_conversion_rate_7d"),
    )


def monthly_from_log(log: DataFrame, ordered: bool = True) -> DataFrame:
    """Cross-check of the monthly KPIs straight from the raw log, in cents, 0 instead of NULL.

    Reads every appended row, so restated rows are counted once per version.
    """
    sums = [F.sum("spend_cents").alias("total_spend_cents"),
            F.sum("impressions").alias("total_impressions"),
            F.sum("clicks").alias("total_clicks"),
            F.sum("registrations").alias("total_registrations")]
    for ld in LIFEDAYS:
        sums += [F.sum(f"revenue_{ld}d_cents").alias(f"total_revenue_{ld}d_cents"),
                 F.sum(f"payers_{ld}d").alias(f"total_payers_{ld}d"),
                 F.sum(f"players_{ld}d").alias(f"total_players_{ld}d")]
    m = log.groupBy(month_bucket(DATE_COL).alias("report_month"), F.col(CAMPAIGN_COL)).agg(*sums)
    out = m.select(
        "report_month", CAMPAIGN_COL, "total_spend_cents", "total_impressions", "total_clicks",
        "total_registrations", "total_payers_14d", "total_revenue_14d_cents",
        ratio_or_zero("total_revenue_3d_cents", "total_spend_cents").alias("roas_3d"),
        ratio_or_zero("total_spend_cents", "total_registrations").alias("cpi_cents"),
        *[ratio_or_zero("total_spend_cents", f"total_payers_{ld}d").alias(f"cpp_{ld}d_cents")
          for ld in LIFEDAYS],
        *[ratio_or_zero(f"total_players_{ld}d", "total_registrations").alias(f"retention_rate_{ld}d")
          for ld in LIFEDAYS],
    )
    return out.orderBy("report_month", CAMPAIGN_COL) if ordered else out


RECONCILED = ("spend_cents", "registrations", "revenue_14d_cents")


def reconciliation(log: DataFrame, history: DataFrame, keys=KEY_COLS, ts: str = LOADED_AT) -> DataFrame:
    """Per month and campaign: the raw log's totals against those of the current versions, and why they differ.

    ``<c>_difference`` (log less current) is the total of versions that were closed since
    (``<c>_closed``) and of rows that made no version (``<c>_repeated``: loads that changed nothing,
    copies, and rows that lost a tie).  ``<c>_unexplained`` is what is left; other than 0, log and
    history do not belong together.  Months and campaigns of either side are kept, nulls included.
    """
    group = [month_bucket(DATE_COL).alias("report_month"), F.col(CAMPAIGN_COL)]
    # A row per load of a key on each side; a version stands for one row of its load.
    loads = log.groupBy(*keys, ts).agg(*(F.sum(c).alias(f"log_{c}") for c in RECONCILED))
    versions = history.select(*(F.col(k).alias(f"__{k}") for k in (*keys, ts)), *RECONCILED,
                              F.col(VALID_TO).isNull().alias("__open"))
    same = functools.reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in (*keys, ts)))
    both = loads.join(versions, same, "full").select(
        *(F.coalesce(k, f"__{k}").alias(k) for k in keys), "__open",
        *(F.coalesce(c, F.lit(0)).alias(c) for x in RECONCILED for c in (x, f"log_{x}")))
    is_open, closed = F.col("__open"), ~F.coalesce(F.col("__open"), F.lit(True))
    sums = []
    for c in RECONCILED:
        sums += [F.sum(f"log_{c}").alias(f"{c}_log"),
                 F.coalesce(F.sum(F.when(is_open, F.col(c))), F.lit(0)).alias(f"{c}_current"),
                 F.coalesce(F.sum(F.when(closed, F.col(c))), F.lit(0)).alias(f"{c}_closed"),
                 F.coalesce(F.sum(F.when(F.col(f"log_{c}") >= F.col(c), F.col(f"log_{c}") - F.col(c))),
                            F.lit(0)).alias(f"{c}_repeated")]
    out = both.groupBy(*group).agg(*sums)
    shown = []
    for c in RECONCILED:
        difference = F.col(f"{c}_log") - F.col(f"{c}_current")
        shown += [F.col(f"{c}_log"), F.col(f"{c}_current"), difference.alias(f"{c}_difference"),
                  F.col(f"{c}_closed"), F.col(f"{c}_repeated"),
                  (difference - F.col(f"{c}_closed") - F.col(f"{c}_repeated")).alias(f"{c}_unexplained")]
    return out.select("report_month", CAMPAIGN_COL, *shown)


def month_report(stg: DataFrame, month) -> DataFrame:
    """The month's summary rows (8 report columns), ordered by campaign.

    The month becomes a date range on ``report_date`` below the aggregate, so
    it reaches the scan as pushed filters instead of being evaluated after it.
    """
    m = monthly_campaign_summary(stg.where(in_month("report_date", month)))
    return m.select(*REPORT_COLS).orderBy(CAMPAIGN_COL)


def top_spend(monthly: DataFrame, k: int = 10) -> DataFrame:
    """Top-k (month, campaign) rows by month desc, spend desc (campaign breaks ties).

    ``orderBy + limit`` plans as TakeOrderedAndProject: each task keeps its own
    top k and only those k rows per task reach the final merge.
    """
    return (monthly.orderBy(F.col("report_month").desc(), F.col("total_spend").desc(),
                            F.col(CAMPAIGN_COL).asc()).limit(k))
