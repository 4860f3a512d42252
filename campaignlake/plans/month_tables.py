"""Tables stored by month in generations, and the small state that says which count.

Layout below a table's path::

    data/execution_month=<m>/merge=<n>/   what run n wrote for month m; never changed afterwards

A state names, for each month, the runs whose files make up the table.  It is
written last, so a run that died leaves files that nothing refers to; the run
that is repeated under the same number deletes them first.  A month that a run
does not touch is neither read nor written, and readers get the folders by name:
no other month is even listed.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import DATE_COL
from ..session import drop_path, path_exists, read_if_exists

MONTH, MERGE = "execution_month", "merge"
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"  # the folder of rows without a month


def month_name(value) -> str:
    """Folder name of a month (a date or None)."""
    return NO_MONTH if value is None else value.isoformat()


def in_months(df: DataFrame, months: list[str], date_col: str = DATE_COL) -> DataFrame:
    """Rows whose date lies in the months, as ranges that reach the scan; month folders are pruned where there are any."""
    dated = [m for m in months if m != NO_MONTH]
    none = NO_MONTH in months

    def either(found: Column | None, null: Column) -> Column:
        if none:
            found = null if found is None else found | null
        return F.lit(False) if found is None else found

    within = None
    for first, after in _runs(dated):
        part = (F.col(date_col) >= F.lit(first).cast("date")) & (F.col(date_col) < F.lit(after).cast("date"))
        within = part if within is None else within | part
    out = df.where(either(within, F.col(date_col).isNull()))
    if MONTH in df.columns:
        listed = F.col(MONTH).isin([F.lit(m).cast("date") for m in dated]) if dated else None
        out = out.where(either(listed, F.col(MONTH).isNull()))
    return out


def _runs(months: list[str]) -> list[tuple[str, str]]:
    """Unbroken runs of months as (first day, first day after)."""
    def after(m: str) -> str:
        year, month = int(m[:4]), int(m[5:7])
        return f"{year + month // 12:04d}-{month % 12 + 1:02d}-01"

    out: list[tuple[str, str]] = []
    for m in sorted(months):
        if out and out[-1][1] == m:
            out[-1] = (out[-1][0], after(m))
        else:
            out.append((m, after(m)))
    return out


class MonthTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, f"{path.rstrip('/')}/data"

    def folder(self, month: str, merge: int) -> str:
        return f"{self.path}/{MONTH}={month}/{MERGE}={merge}"

    def read(self, parts: dict[str, list[int]], months: list[str] | None = None,
             keep_merge: bool = False, inner: str | None = None) -> DataFrame | None:
        """The rows of the named runs, of all months or of some; None if there are none.

        ``inner`` names a partition folder inside a run's.  With the storage column ``execution_month``;
        ``merge`` if asked for.
        """
        paths = [self.folder(m, n) + (f"/{inner}" if inner else "")
                 for m, ns in sorted(parts.items()) if months is None or m in months for n in ns]
        if not paths:
            return None
        df = self.spark.read.option("basePath", self.path).parquet(*paths)
        df = df.withColumn(MONTH, F.col(MONTH).cast("date")).drop(*([inner.partition("=")[0]] if inner else []))
        return df if keep_merge else df.drop(MERGE)

    def write(self, df: DataFrame, merge: int, months: list[str], inner: tuple[str, ...] = ()) -> list[str]:
        """Write run ``merge`` of the months (``df`` has ``execution_month``); returns those that have rows."""
        for m in months:
            drop_path(self.spark, self.folder(m, merge))  # left by a run that died
        (df.withColumn(MERGE, F.lit(merge)).hint("rebalance", MONTH)
         .write.mode("append").partitionBy(MONTH, MERGE, *inner).parquet(self.path))
        return [m for m in months if path_exists(self.spark, self.folder(m, merge))]

    def drop(self, month: str, merge: int) -> None:
        drop_path(self.spark, self.folder(month, merge))


def read_state(spark: SparkSession, path: str) -> tuple[int, dict] | None:
    """Number and content of the last complete run, or None before the first."""
    states = read_if_exists(spark, f"{path}/state")
    if states is None:
        return None
    s = states.agg(F.max_by(F.struct(MERGE, "body"), MERGE).alias("s")).first()["s"]
    return s[MERGE], json.loads(s["body"])


def write_state(spark: SparkSession, path: str, merge: int, body: dict) -> None:
    spark.range(1).select(F.lit(json.dumps(body)).alias("body")).write.mode("overwrite").parquet(
        f"{path}/state/{MERGE}={merge}")
