"""Quality of a load against the loads before it.

A load's counters (see ``ingest.clean(observation=...)``) say how many values of
each column were no numbers, not finite, negative or not castable.  A source that
changes shows as a share that jumps, not as a value that is wrong in itself; so
a load is held against a trailing baseline: the median of the shares of earlier
loads and their median deviation from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .checks import RESULT_COLS

# (load, loaded_at, column_name, flag, failures, rows): one row per load, column and kind of fault.
COUNTERS = "load string, loaded_at timestamp_ntz, column_name string, flag string, failures long, rows long"


def drift(counters: DataFrame, window: int = 30, deviations: float = 6.0, least_share: float = 0.01,
          least_loads: int = 3) -> DataFrame:
    """``counters`` with each load's ``share`` of faulty values, the ``baseline`` and ``spread`` of the up to
    ``window`` loads before it, and ``drifted``.

    A share drifts if it lies above the median of the loads before by more than
    ``deviations`` median deviations and by more than ``least_share``; columns with
    fewer than ``least_loads`` loads before are not judged.  Loads without rows
    count neither way.  Windows run per (column, kind of fault) over a row a load.
    """
    before = Window.partitionBy("column_name", "flag").orderBy("loaded_at", "load").rowsBetween(-window, -1)
    shares = counters.where("rows > 0").withColumn("share", F.col("failures") / F.col("rows"))
    known = shares.withColumn("earlier", F.collect_list("share").over(before))  # at most ``window`` numbers

    def median(values):
        ordered, n = F.array_sort(values), F.size(values)
        return (F.get(ordered, F.floor((n - 1) / 2).cast("int")) + F.get(ordered, F.floor(n / 2).cast("int"))) / 2

    judged = known.withColumn("baseline", median(F.col("earlier")))
    judged = judged.withColumn("spread", median(F.transform("earlier", lambda x: F.abs(x - F.col("baseline")))))
    above = F.col("share") - F.col("baseline")
    drifted = ((F.size("earlier") >= least_loads) & (above > least_share)
               & (above > F.lit(deviations) * F.col("spread")))
    return judged.select(*counters.columns, "share", "baseline", "spread",
                         F.coalesce(drifted, F.lit(False)).alias("drifted"))


def drift_check(counters: DataFrame, model: str = "", **limits) -> DataFrame:
    """One check row per column of the newest load: how many of its kinds of fault have drifted."""
    judged = drift(counters, **limits)
    newest = judged.agg(F.max(F.struct("loaded_at", "load")).alias("newest"))
    last = judged.join(F.broadcast(newest), F.struct("loaded_at", "load") == F.col("newest"))  # one row
    return last.groupBy("column_name").agg(F.count_if("drifted").alias("failures")).select(
        F.lit("drift").alias("check_name"), F.lit(model).alias("model_name"), "column_name",
        F.col("failures").cast("bigint").alias("failures")).select(*RESULT_COLS)
