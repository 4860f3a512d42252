"""The load job: plan windows from the high-water mark, select, clean, append.

One Spark job covers every planned window: the plan is a small DataFrame
(one row per month), records are matched to windows by a broadcast join, and
the cleaned rows are appended partitioned by execution month.  The only
driver-side values are the high-water mark and the row count.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.completeness import incomplete_dates, lacking
from ..operators.ingest import clean, parsed_date, rejects
from ..functions.dates import month_start, ntz_literal
from ..operators.quality import COUNTERS
from ..operators.windows import (gap_windows, high_water_mark_value, parse_target, period_scan,
                                 plan_load, read_log_if_exists, select_windows)
from ..schema import BACKFILL_DAYS, FILE_FORMATS, LOADED_AT, LOG_COLS, LOG_SCHEMA, STORAGE_COLS
from ..session import ensure_checkpoint_dir, read_if_exists
from ..sources.sinks import append, quality_beside, rejects_beside


@dataclass
class LoadResult:
    hwm: _dt.date | None
    plan: DataFrame
    rows_appended: int
    rejects: DataFrame  # records that no earlier load has reported
    quality: DataFrame | None = None  # the load's counters, also stored beside the log


def _new_rejects(spark: SparkSession, records: DataFrame, path: str, loaded_at: _dt.datetime) -> DataFrame:
    """Store the records that cannot be loaded, but for those stored already, and return them.

    A record without a usable date belongs to no window, so every run over its
    month meets it again; it is known by a digest of its fields.
    """
    found = rejects(records).drop("execution_month")
    found = found.withColumn("record_digest", F.sha2(F.to_json(F.struct(*sorted(found.columns))), 256))
    known = read_if_exists(spark, path)
    if known is not None:
        found = found.join(known.select("record_digest"), "record_digest", "left_anti")
    run = f"{path}/load={loaded_at.strftime('%Y%m%dT%H%M%S%f')}-{uuid.uuid4().hex[:8]}"
    found.write.parquet(run)
    return spark.read.schema(found.schema).parquet(run)


def load(spark: SparkSession, records: DataFrame, log_path: str, target, *,
         horizon_days: int = BACKFILL_DAYS, loaded_at: _dt.datetime | None = None,
         format: str = "parquet", refill_from=None, **clean_options) -> LoadResult:
    """Load the records that fall into the planned windows up to ``target``.

    No high-water mark (missing or empty log) -> backfill ``horizon_days``;
    otherwise from the day after it.  Nothing to do when the log is current.
    With ``refill_from`` the dates from there up to the mark that the log lacks
    (a chunk that once failed) are loaded as well.
    Records landed in ``execution_month`` folders are read for the planned
    months only.
    The column cast-failure policy (``cast_failure="column"``) applies per
    window chunk, as the source pipeline loads one chunk at a time.
    With a log in files, rejected records are stored beside it, each once.
    """
    t = parse_target(target)
    hwm = high_water_mark_value(spark, log_path, format=format)
    plan = plan_load(spark, hwm, t, horizon_days)
    first = t - _dt.timedelta(days=horizon_days) if hwm is None else hwm + _dt.timedelta(days=1)
    if refill_from is not None and hwm is not None:
        first = min(first, parse_target(refill_from))
        # The gaps go first and keep their numbers; a chunk is a window, so numbers stay distinct.
        gaps = gap_windows(read_log_if_exists(spark, log_path, format), first, min(hwm, t))
        plan = gaps.unionByName(plan.withColumn("chunk", F.col("chunk") + F.lit(1 + (hwm - first).days)))
    if "execution_month" in records.columns:
        month = F.col("execution_month").cast("date")
        records = records.where((month >= F.lit(month_start(first))) & (month <= F.lit(month_start(t))))
    dated = records.withColumn("__date", parsed_date(records))
    selected = select_windows(dated, plan, "__date").drop("__date", "window_start", "window_end")
    # One job plans, selects, cleans and appends.
    counted = Observation("quality")
    cleaned = clean(selected, loaded_at=loaded_at, chunk_col="chunk", observation=counted, **clean_options)
    n = append(cleaned, log_path, format=format)
    bad, at, counters = rejects(records), loaded_at or _dt.datetime.now(_dt.timezone.utc), None
    if n:  # without rows nothing was observed
        counters = _counters(spark, counted.get, n, at)
    if format in FILE_FORMATS:
        bad = _new_rejects(spark, records, rejects_beside(log_path), at)
        if counters is not None:
            counters.write.mode("append").parquet(quality_beside(log_path))
    return LoadResult(hwm=hwm, plan=plan, rows_appended=n, rejects=bad, quality=counters)


def _counters(spark: SparkSession, observed: dict, rows: int, at: _dt.datetime) -> DataFrame:
    """What the load's own pass observed, a row per column and kind of fault."""
    name = f"{at.strftime('%Y%m%dT%H%M%S%f')}-{uuid.uuid4().hex[:8]}"
    return spark.createDataFrame(
        [(name, at.replace(tzinfo=None), key.partition("__")[2], key.partition("__")[0], int(value or 0), rows)
         for key, value in observed.items()], COUNTERS)


def read_quality(spark: SparkSession, log_path: str) -> DataFrame:
    """The counters of all loads into a log at a path."""
    found = read_if_exists(spark, quality_beside(log_path))
    return spark.createDataFrame([], COUNTERS) if found is None else found


def fill_incomplete(spark: SparkSession, records: DataFrame, log_path: str, start, end, *,
                    loaded_at: _dt.datetime | None = None, format: str = "parquet", **clean_options) -> int:
    """Append what the log lacks of the dates from ``start`` to ``end``; returns the number of rows.

    Dates on which landed and loaded rows differ (:mod:`..operators.completeness`) get the rows that are
    landed more often than loaded, so a date loaded half is completed and no row is loaded twice.
    """
    lo, hi = parse_target(start), parse_target(end)
    if "execution_month" in records.columns:
        month = F.col("execution_month").cast("date")
        records = records.where((month >= F.lit(month_start(lo))) & (month <= F.lit(month_start(hi))))
    log = period_scan(read_log(spark, log_path, format=format, with_month=True), lo, hi)
    landed = period_scan(clean(records, loaded_at=loaded_at, **clean_options), lo, hi)
    dates = incomplete_dates(landed, log, lo, hi)
    # Found once: the log is about to change.
    ensure_checkpoint_dir(spark)
    more = lacking(landed, log, dates).checkpoint()
    at = loaded_at or _dt.datetime.now(_dt.timezone.utc)
    return append(more.withColumn(LOADED_AT, ntz_literal(at)).select(*LOG_COLS), log_path, format=format)


def read_log(spark: SparkSession, log_path: str, months=None, format: str = "parquet",
             with_month: bool = False) -> DataFrame:
    """The log's own columns; ``months`` (first days of months) prunes partition directories.

    ``with_month`` keeps ``execution_month``, by which a stored history finds the months it has to read.
    """
    df = read_log_if_exists(spark, log_path, format)
    if df is None:
        return spark.createDataFrame([], LOG_SCHEMA)
    if months:
        df = df.where(F.col("execution_month").isin([F.lit(m).cast("date") for m in months]))
    return df.drop(*(c for c in STORAGE_COLS if not with_month or c != "execution_month"))
