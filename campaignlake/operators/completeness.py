"""Whether the log holds what was landed, date by date, and what it lacks.

A date that was loaded half is no gap for a finder that looks for dates without
rows.  Here both sides are reduced to a fingerprint per date, the number of rows
and the sum of their hashes, which tells multisets of rows apart whatever order
they arrive in.  The sums combine before the shuffle, so what meets is a row per
date and side; rows are compared only for the dates whose fingerprints differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_date
from ..schema import DATE_COL, LOADED_AT, LOG_COLS

# What a row is, whenever it was loaded.
COMPARED = tuple(c for c in LOG_COLS if c != LOADED_AT)


def _hash(df: DataFrame, columns) -> Column:
    """A row's hash; minus zero counts as zero, and a null as a value of its own."""
    kinds = dict(df.dtypes)
    parts = []
    for c in columns:
        value = F.col(c) + F.lit(0.0) if kinds[c] in ("double", "float") else F.col(c)
        parts += [value, F.col(c).isNull()]
    return F.xxhash64(*parts)


def fingerprints(df: DataFrame, columns=COMPARED, date_col: str = DATE_COL) -> DataFrame:
    """``(date, rows, hash_sum)`` per date.  The sum is exact (38 digits), so nothing cancels by overflow."""
    return df.groupBy(F.col(date_col).alias("date")).agg(
        F.count("*").alias("rows"), F.sum(_hash(df, columns).cast("decimal(20,0)")).alias("hash_sum"))


def incomplete_dates(landed: DataFrame, log: DataFrame, start, end, columns=COMPARED,
                     date_col: str = DATE_COL) -> DataFrame:
    """``(date, landed_rows, log_rows)`` of the dates from ``start`` to ``end`` where the two sides differ."""
    within = (F.col(date_col) >= F.lit(as_date(start))) & (F.col(date_col) <= F.lit(as_date(end)))
    a = fingerprints(landed.where(within), columns, date_col).withColumnsRenamed({"rows": "landed_rows", "hash_sum": "a"})
    b = fingerprints(log.where(within), columns, date_col).withColumnsRenamed({"rows": "log_rows", "hash_sum": "b"})
    both = a.join(b, "date", "full").fillna(0, ["landed_rows", "log_rows"])
    differ = (F.col("landed_rows") != F.col("log_rows")) | ~F.col("a").eqNullSafe(F.col("b"))
    return both.where(differ).select("date", "landed_rows", "log_rows")


def lacking(landed: DataFrame, log: DataFrame, dates: DataFrame, columns=COMPARED,
            date_col: str = DATE_COL) -> DataFrame:
    """Rows of the given dates that ``landed`` holds more often than ``log``, that much more often.

    Copies are counted, not listed: equal rows combine before the shuffle on both sides.
    The dates go to every task, a row per day of a period whatever the size of the tables: the planner
    cannot know that and would move all rows of both sides to find those of the few dates.
    """
    days = F.broadcast(dates.select(F.col("date").alias("__date")).distinct())
    on_days = lambda df: df.join(days, F.col(date_col) == F.col("__date"), "left_semi").select(*columns)
    signed = (on_days(landed).withColumn("__n", F.lit(1)).unionByName(on_days(log).withColumn("__n", F.lit(-1))))
    more = signed.groupBy(*columns).agg(F.sum("__n").alias("__n")).where("__n > 0")
    return more.select(*columns, F.explode(F.sequence(F.lit(1), F.col("__n"))).alias("__copy")).drop("__copy")
