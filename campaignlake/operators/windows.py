"""Load planning: high-water mark, month-chunk windows, window selection, gap finding.

Windows are data (a DataFrame of ``chunk, window_start, window_end``), not a
driver loop: one job selects the records of every window at once.  A plan
holds one row per calendar month between its bounds (61 for a five-year
backfill), a size fixed by the dates, so it is safe to broadcast.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import as_date
from ..schema import BACKFILL_DAYS, DATE_COL, FILE_FORMATS, LOG_SCHEMA
from ..session import folder_names, read_if_exists

WINDOW_COLS = ("chunk", "window_start", "window_end")


def parse_target(value) -> _dt.date:
    """Validate a target date (``YYYY-MM-DD``); raises ValueError otherwise."""
    return as_date(value)


def high_water_mark(log: DataFrame, date_col: str = DATE_COL) -> DataFrame:
    """One row, ``hwm`` = newest execution date in the log (NULL when empty).

    A global max is a partial aggregate per task plus one tiny final merge;
    on Parquet the planner needs only the date column.
    """
    return log.agg(F.max(F.col(date_col)).alias("hwm"))


def high_water_mark_value(spark: SparkSession, source: str | DataFrame | None,
                          date_col: str = DATE_COL, format: str = "parquet"):
    """The high-water mark as a Python date; None when the table or path is missing or empty.

    ``source`` is a DataFrame, a path (read in ``format``) or a table name.  Only
    "there is nothing yet" counts as a first load; any other failure to read
    the log is raised, as a backfill on top of it would double its rows.

    Of a log in month folders the newest folder that has rows is read, whatever the log's length.
    """
    if isinstance(source, str):
        for newest in newest_month_folders(spark, source, format) if date_col == DATE_COL else ():
            mark = high_water_mark(newest, date_col).first()["hwm"]
            if mark is not None:
                return mark
        source = read_log_if_exists(spark, source, format)
    if source is None:
        return None
    return high_water_mark(source, date_col).first()["hwm"]


def newest_month_folders(spark: SparkSession, path: str, format: str = "parquet"):
    """The month folders of a log in files, newest first, one DataFrame at a time; none if it has another layout."""
    if format not in FILE_FORMATS or not ("/" in path or ":" in path):
        return
    names = [n for n in folder_names(spark, path) if not n.startswith(("_", "."))]
    if not all(re.fullmatch(r"execution_month=\d{4}-\d\d-\d\d", n) for n in names):
        return
    for name in sorted(names, reverse=True):
        reader = spark.read.format(format).option("basePath", path)
        yield (reader if format == "parquet" else reader.schema(LOG_SCHEMA)).load(f"{path.rstrip('/')}/{name}")


def read_log_if_exists(spark: SparkSession, target: str, format: str = "parquet") -> DataFrame | None:
    """The log at a path, or the table of that name; None if it does not exist yet."""
    if format in FILE_FORMATS and ("/" in target or ":" in target):
        # Text formats carry no types, so the log's schema is given.
        schema = None if format == "parquet" else LOG_SCHEMA
        return read_if_exists(spark, target, format, schema)
    if format == "jdbc":
        raise ValueError("a JDBC log's high-water mark needs a connection: pass its DataFrame")
    return spark.table(target) if spark.catalog.tableExists(target) else None


def windows_between(bounds: DataFrame, lo: str = "lo", hi: str = "hi",
                    newest_first: bool = False) -> DataFrame:
    """Month chunks covering ``[lo, hi]`` of each bounds row (none when lo > hi).

    The first and last chunk are clipped to the bounds.  ``chunk`` numbers from
    1 in load order: newest first for a backfill, oldest first otherwise.
    """
    lo_c, hi_c = F.col(lo), F.col(hi)
    # Bounds without a window never make a sequence, but the expression may be evaluated for them.
    last_month = F.greatest(F.trunc(lo_c, "MM"), F.trunc(hi_c, "MM"))
    months = F.sequence(F.trunc(lo_c, "MM"), last_month, F.expr("INTERVAL 1 MONTH"))
    exploded = (bounds.where(lo_c.isNotNull() & hi_c.isNotNull() & (lo_c <= hi_c))
                .select(lo_c.alias("__lo"), hi_c.alias("__hi"), F.size(months).alias("__n"),
                        F.posexplode(months).alias("__pos", "__m")))
    chunk = (F.col("__n") - F.col("__pos")) if newest_first else (F.col("__pos") + 1)
    return exploded.select(
        chunk.cast("int").alias("chunk"),
        F.greatest(F.col("__m"), F.col("__lo")).alias("window_start"),
        F.least(F.last_day(F.col("__m")), F.col("__hi")).alias("window_end"),
    )


def _bounds(spark: SparkSession, lo, hi) -> DataFrame:
    return spark.range(1).select(F.lit(lo).cast("date").alias("lo"), F.lit(hi).cast("date").alias("hi"))


def backfill_windows(spark: SparkSession, target, horizon_days: int = BACKFILL_DAYS) -> DataFrame:
    """First-load plan: month chunks from ``target`` back ``horizon_days`` days, newest first."""
    t = parse_target(target)
    return windows_between(_bounds(spark, t - _dt.timedelta(days=horizon_days), t), newest_first=True)


def incremental_windows(spark: SparkSession, hwm, target) -> DataFrame:
    """Catch-up plan: month chunks from ``hwm + 1`` to ``target``, oldest first; empty if current."""
    t, h = parse_target(target), as_date(hwm)
    return windows_between(_bounds(spark, h + _dt.timedelta(days=1), t), newest_first=False)


def plan_load(spark: SparkSession, hwm, target, horizon_days: int = BACKFILL_DAYS) -> DataFrame:
    """No high-water mark -> backfill plan; otherwise the incremental plan."""
    if hwm is None:
        return backfill_windows(spark, target, horizon_days)
    return incremental_windows(spark, hwm, target)


def plan_from_log(log: DataFrame, target: Column | None = None,
                  horizon_days: int = BACKFILL_DAYS, date_col: str = DATE_COL) -> DataFrame:
    """The same decision, computed inside Spark from a log DataFrame (no driver round trip).

    ``target`` defaults to the log's own newest date.  Empty log -> backfill.
    """
    agg = log.agg(F.max(F.col(date_col)).alias("hwm"))
    tgt = target if target is not None else F.col("hwm")
    b = agg.select(F.col("hwm"), tgt.cast("date").alias("hi"))
    backfill = F.date_sub(F.col("hi"), horizon_days)
    b = b.select(F.coalesce(F.date_add(F.col("hwm"), 1), backfill).alias("lo"), "hi",
                 F.col("hwm").isNull().alias("__backfill"))
    # A plan is either a backfill (newest first) or incremental (oldest first).
    back = windows_between(b.where(F.col("__backfill")), newest_first=True)
    inc = windows_between(b.where(~F.col("__backfill")), newest_first=False)
    return back.unionByName(inc)


def gap_windows(log: DataFrame, start, end, date_col: str = DATE_COL) -> DataFrame:
    """Load plan for the dates of ``[start, end]`` that the log lacks: one window per
    unbroken run of missing dates in a calendar month, oldest first.

    Works on the missing dates, at most one row per day of the period.
    """
    days = missing_dates(log, start, end, date_col).select(
        "missing_date", F.trunc("missing_date", "MM").alias("__m"))
    # Dates of one run keep the same distance to their number in the month.
    in_month = Window.partitionBy("__m").orderBy("missing_date")
    runs = (days.withColumn("__run", F.date_sub("missing_date", F.row_number().over(in_month)))
            .groupBy("__m", "__run").agg(F.min("missing_date").alias("window_start"),
                                         F.max("missing_date").alias("window_end")))
    return runs.select(F.row_number().over(Window.orderBy("window_start")).alias("chunk"),
                       "window_start", "window_end")


def period_scan(df: DataFrame, period_from, period_to, date_col: str = DATE_COL,
                month_col: str = "execution_month") -> DataFrame:
    """Rows whose date lies in ``[period_from, period_to]`` (both inclusive).

    On a log landed partitioned by ``execution_month`` the month bounds prune
    whole directories; the date range itself reaches the Parquet reader as
    pushed filters (row-group skipping) for the edge months.
    """
    lo, hi = as_date(period_from), as_date(period_to)
    cond = (F.col(date_col) >= F.lit(lo)) & (F.col(date_col) <= F.lit(hi))
    if month_col in df.columns:
        cond = cond & (F.col(month_col) >= F.lit(lo.replace(day=1))) & (F.col(month_col) <= F.lit(hi.replace(day=1)))
    return df.where(cond)


def select_windows(df: DataFrame, windows: DataFrame, date_col: str = DATE_COL) -> DataFrame:
    """Rows of ``df`` whose date lies in a planned window, tagged with the window.

    Each window lies inside one calendar month, so the range join becomes an
    equi-join on the month plus a range check: a broadcast hash join against
    the (month-count bounded) plan instead of a nested loop.
    """
    w = windows.select(*WINDOW_COLS, F.trunc("window_start", "MM").alias("__wm"))
    d = F.col(date_col)
    j = df.join(F.broadcast(w), (F.trunc(d, "MM") == F.col("__wm"))
                & (d >= F.col("window_start")) & (d <= F.col("window_end")), "inner")
    return j.select(*WINDOW_COLS, *df.columns)


def missing_dates(log: DataFrame, start, end, date_col: str = DATE_COL) -> DataFrame:
    """Calendar dates in ``[start, end]`` with no row in the log (gaps a skipped chunk leaves).

    Both sides are bounded by the number of days in the range: the log side is
    a distinct over dates (partial aggregate first), the calendar comes from
    ``spark.range``; the anti join drops loaded days.
    """
    s, e = as_date(start), as_date(end)
    spark = log.sparkSession
    cal = spark.range(0, (e - s).days + 1).select(
        F.date_add(F.lit(s), F.col("id").cast("int")).alias("missing_date"))
    loaded = (log.where((F.col(date_col) >= F.lit(s)) & (F.col(date_col) <= F.lit(e)))
              .select(F.col(date_col).alias("missing_date")).distinct())
    return cal.join(loaded, "missing_date", "left_anti")
