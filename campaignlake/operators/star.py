"""Staging projection and the star schema (campaign, ad and date dimensions; daily fact).

Join strategy
-------------
* ``dim_dates`` has one row per day of a range of at most ``MAX_DAYS`` days.  It
  comes from ``spark.range``, whose size the planner knows, so it is broadcast
  without a hint; a calendar from elsewhere is joined by its measured size.
* ``dim_campaigns`` / ``dim_ads`` grow with the data, so they are never
  force-broadcast; the planner (AQE) broadcasts them only once their runtime
  size is measured under the threshold and otherwise shuffles, splitting
  skewed campaigns.
* When the dimensions are the ones built from the same staging rows (the
  normal pipeline), every key a join would fetch is a pure function of the
  fact row's own columns: md5 of the campaign, md5 of campaign-ad unless the
  ad is the default, the date when inside the date range.  ``fact_daily``
  then derives them row-locally: the same result with no join and no shuffle.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import as_date, day_of_week_sun0
from ..functions.keys import ad_key, campaign_key, row_key
from ..functions.money import cents_to_eur
from ..schema import (AD_COL, CAMPAIGN_COL, DATE_COL, DEFAULT_AD, DIM_DATES_END,
                      DIM_DATES_START, LIFEDAYS, LOADED_AT, VALID_FROM, lifeday_cols,
                      staging_lifeday_cols)
from .history import current

# Longest calendar: two centuries.
MAX_DAYS = 73_050


def staging(history: DataFrame, only_current: bool = True) -> DataFrame:
    """Current rows of the history, renamed, with cents converted to currency units."""
    src = current(history) if only_current else history
    cols = [
        row_key().alias("campaign_performance_sk"),
        F.col(DATE_COL).alias("report_date"),
        F.col(CAMPAIGN_COL),
        F.col(AD_COL),
        cents_to_eur("spend_cents").alias("spend_eur"),
        F.col("impressions"), F.col("clicks"), F.col("registrations"),
        cents_to_eur("cpc_cents").alias("cpc_eur"),
        F.col("ctr"), F.col("cr"),
    ]
    for ld in LIFEDAYS:
        players, payers, payments, revenue = lifeday_cols(ld)
        eur = staging_lifeday_cols(ld)[3]
        cols += [F.col(players), F.col(payers), F.col(payments), cents_to_eur(revenue).alias(eur)]
    cols += [F.col(VALID_FROM).alias("valid_from_timestamp"),
             F.col(LOADED_AT).alias("updated_at_timestamp")]
    return src.select(*cols)


def dim_campaigns(stg: DataFrame) -> DataFrame:
    """One row per non-null campaign: ``campaign_key = md5(campaign_name)``.

    ``distinct`` is a partial + final hash aggregate: each task reduces its
    rows to its distinct campaigns before the shuffle.
    """
    d = stg.where(F.col(CAMPAIGN_COL).isNotNull()).select(CAMPAIGN_COL).distinct()
    return d.select(campaign_key().alias("campaign_key"), F.col(CAMPAIGN_COL))


def dim_ads(stg: DataFrame, campaigns: DataFrame | None = None) -> DataFrame:
    """One row per (campaign, ad) with a real ad; ``campaign_fk`` from the campaign dimension.

    With ``campaigns=None`` the campaign dimension is the one built from the
    same staging rows, whose key is md5 of the name, so the foreign key is
    computed in place; pass a dimension to look it up with a left join.
    """
    pairs = (stg.where(F.col(AD_COL).isNotNull() & (F.col(AD_COL) != F.lit(DEFAULT_AD)))
             .select(CAMPAIGN_COL, AD_COL).distinct())
    if campaigns is None:
        fk = campaign_key()
        return pairs.select(ad_key().alias("ad_key"), fk.alias("campaign_fk"),
                            F.col(AD_COL), F.col(CAMPAIGN_COL))
    c = campaigns.select(F.col("campaign_key"), F.col(CAMPAIGN_COL).alias("__c"))
    j = pairs.join(c, pairs[CAMPAIGN_COL] == c["__c"], "left")
    return j.select(ad_key().alias("ad_key"), F.col("campaign_key").alias("campaign_fk"),
                    F.col(AD_COL), F.col(CAMPAIGN_COL))


def dim_dates(spark: SparkSession, start=DIM_DATES_START, end=DIM_DATES_END) -> DataFrame:
    """Daily calendar from ``start`` (inclusive) to ``end`` (exclusive) with its parts.

    Generated by ``spark.range`` (split over tasks), not one exploded array.
    """
    s, e = as_date(start), as_date(end)
    n = max((e - s).days, 0)
    d = F.date_add(F.lit(s), F.col("id").cast("int"))
    return date_attributes(spark.range(0, n).select(d.alias("date_key")))


def dim_dates_spanning(df: DataFrame, date_col: str = "report_date", max_days: int = MAX_DAYS) -> DataFrame:
    """Calendar from the first day of the data's first month up to its last date.

    The bounds are one row, read when this is called; the calendar is then the
    usual one.  A span beyond ``max_days`` raises: it points to a stray date.
    """
    b = df.agg(F.trunc(F.min(date_col), "MM").alias("lo"), F.max(date_col).alias("hi")).first()
    if b["lo"] is None:
        return dim_dates(df.sparkSession, DIM_DATES_START, DIM_DATES_START)
    if (b["hi"] - b["lo"]).days >= max_days:
        raise ValueError(f"{date_col} spans {b['lo']} to {b['hi']}, more than {max_days} days")
    return dim_dates(df.sparkSession, b["lo"], b["hi"] + _dt.timedelta(days=1))


def date_attributes(days: DataFrame) -> DataFrame:
    """Calendar attributes of a ``date_key`` column."""
    dk = F.col("date_key")
    return days.select(
        dk,
        F.year(dk).alias("year"),
        F.month(dk).alias("month"),
        F.dayofmonth(dk).alias("day"),
        day_of_week_sun0(dk).alias("day_of_week"),
        F.dayofyear(dk).alias("day_of_year"),
        F.quarter(dk).alias("quarter_of_year"),
        F.date_format(dk, "MMMM").alias("month_name"),
        F.date_format(dk, "MMM").alias("month_name_short"),
        F.date_format(dk, "EEEE").alias("day_name"),
        F.date_format(dk, "EEE").alias("day_name_short"),
        day_of_week_sun0(dk).isin(0, 6).alias("is_weekend"),
    )


FACT_MEASURES = (
    ["spend_eur", "impressions", "clicks", "registrations", "cpc_eur", "ctr", "cr"]
    + [c for ld in LIFEDAYS for c in staging_lifeday_cols(ld)]
)


def fact_daily(stg: DataFrame, dates: DataFrame | None = None,
               campaigns: DataFrame | None = None, ads: DataFrame | None = None,
               date_range=(DIM_DATES_START, DIM_DATES_END), carry: tuple[str, ...] = ()) -> DataFrame:
    """Daily performance fact: staging rows with date, campaign and ad keys.

    Row count always equals staging (each dimension is unique on its join key).
    Dimensions left as None are the ones the pipeline builds from this same
    staging (``date_range`` for the calendar); their keys are derived in
    place.  Dimensions passed in are joined on their natural keys.  ``carry``: columns of the staging rows
    to keep beside the fact's.
    """
    f = stg
    if dates is None:
        s, e = as_date(date_range[0]), as_date(date_range[1])
        rd = F.col("report_date")
        f = f.withColumn("date_key", F.when((rd >= F.lit(s)) & (rd < F.lit(e)), rd))
    else:
        f = f.join(dates.select("date_key"), F.col("report_date") == F.col("date_key"), "left")
    if campaigns is None:
        f = f.withColumn("campaign_key", campaign_key())
    else:
        c = campaigns.select(F.col("campaign_key"), F.col(CAMPAIGN_COL).alias("__dc_name"))
        f = f.join(c, F.col(CAMPAIGN_COL) == F.col("__dc_name"), "left")
    if ads is None:
        ad = F.col(AD_COL)
        f = f.withColumn("ad_key", F.when(ad.isNotNull() & (ad != F.lit(DEFAULT_AD)), ad_key()))
    else:
        a = ads.select(F.col("ad_key"), F.col(CAMPAIGN_COL).alias("__da_c"), F.col(AD_COL).alias("__da_a"))
        f = f.join(a, (F.col(CAMPAIGN_COL) == F.col("__da_c")) & (F.col(AD_COL) == F.col("__da_a")), "left")
    return f.select(
        F.col("campaign_performance_sk").alias("daily_performance_sk"),
        "date_key", "campaign_key", "ad_key", CAMPAIGN_COL, AD_COL,
        *FACT_MEASURES, "valid_from_timestamp", "updated_at_timestamp", *carry)
