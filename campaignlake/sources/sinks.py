"""Sinks: append to the log, materialise layers, export reports.

One ``append`` for every target format (explicit ``format=``; an unknown
format raises instead of silently falling back to a default sink).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.dates import month_bucket, ntz_literal
from ..schema import DATE_COL, FILE_FORMATS, LOADED_AT, LOG_SCHEMA
from ..session import read_if_exists, scratch_path, shuffles_dropped


def with_execution_month(df: DataFrame, date_col: str = DATE_COL) -> DataFrame:
    """Add the ``execution_month`` partition column (first day of the row's month)."""
    if "execution_month" in df.columns:
        return df
    return df.withColumn("execution_month", month_bucket(date_col))


def with_load_time(df: DataFrame, ts_col: str = LOADED_AT) -> DataFrame:
    """The load time where a batch has none: the time of this call, as UTC wall time."""
    now = ntz_literal(_dt.datetime.now(_dt.timezone.utc))
    return df.withColumn(ts_col, F.coalesce(F.col(ts_col), now) if ts_col in df.columns else now)


def create_log_table(spark, target: str, format: str = "parquet",
                     partition_by=("execution_month",)) -> bool:
    """Create the (empty) append log with its explicit schema if it does not exist.

    ``target`` is a path for file formats or a catalog name for ``table``.
    Returns True when it was created.  NOT NULL columns of the schema are
    enforced by the not-null checks, not by the file format.
    """
    empty = with_execution_month(spark.createDataFrame([], LOG_SCHEMA))
    if format == "table":
        if spark.catalog.tableExists(target):
            return False
        empty.write.partitionBy(*partition_by).saveAsTable(target)
        return True
    if read_if_exists(spark, target, format, empty.schema) is not None:
        return False
    empty.write.mode("ignore").partitionBy(*partition_by).format(format).save(target)
    return True


def append(df: DataFrame, target: str, *, format: str = "parquet",
           partition_by=("execution_month",), mode: str = "append",
           options: dict | None = None, moved: bool = False) -> int:
    """Append a cleaned batch to the log; returns the number of rows written.

    * file formats: ``target`` is a path; data lands partitioned by
      ``execution_month`` so month filters prune directories.  ``mode=
      "overwrite"`` replaces only the partitions present in the batch
      (dynamic partition overwrite), which makes a rerun of a month
      idempotent.
    * ``table``: catalog table, created from the batch schema when missing,
      written by column name; overwrite replaces the batch's partitions.
    * ``iceberg``: catalog table through ``writeTo`` (needs an Iceberg catalog);
      overwrite replaces the batch's partitions.
    * ``jdbc``: ``options`` holds url/user/password/driver; Spark commits one
      transaction per partition.  It has no partitions to replace, so
      overwriting is refused.
    A batch without a load-time column gets the time of the call.
    A batch is moved to its months before it is written, unless it says that
    it lies by month already (``moved``).
    The row count comes from an Observation on the write itself (no extra
    pass); an empty batch writes nothing.
    """
    if mode not in ("append", "overwrite") or (mode == "overwrite" and format == "jdbc"):
        raise ValueError(f"mode {mode!r} is not supported for sink format {format!r}")
    if format not in (*FILE_FORMATS, "table", "iceberg", "jdbc"):
        raise ValueError(f"unknown sink format {format!r}")
    opts = dict(options or {})
    if DATE_COL in df.columns and LOADED_AT not in df.columns:
        df = with_load_time(df)
    if format in FILE_FORMATS or format in ("table", "iceberg"):
        if partition_by and "execution_month" in partition_by:
            df = with_execution_month(df)
    if partition_by and format != "jdbc" and not moved:
        # Else every task writes a file for every month it has a row of.  AQE splits large months.
        df = df.hint("rebalance", *partition_by)
    obs = Observation("append")
    counted = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    with shuffles_dropped(df.sparkSession):
        _write(counted, target, format, partition_by, mode, opts)
    return int(obs.get.get("rows", 0) or 0)


def _write(df: DataFrame, target: str, format: str, partition_by, mode: str, opts: dict) -> None:
    if format in FILE_FORMATS:
        w = df.write.mode(mode).options(**opts)
        if mode == "overwrite":
            w = w.option("partitionOverwriteMode", "dynamic")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.format(format).save(target)
    elif format == "table":
        spark = df.sparkSession
        if spark.catalog.tableExists(target):
            w = df.select(*spark.table(target).columns).write.mode(mode)
            w.option("partitionOverwriteMode", "dynamic").insertInto(target, overwrite=mode == "overwrite")
        else:
            w = df.write.mode("errorifexists")
            if partition_by:
                w = w.partitionBy(*partition_by)
            w.saveAsTable(target)
    elif format == "iceberg":
        spark = df.sparkSession
        if spark.catalog.tableExists(target):
            w = df.writeTo(target)
            w.append() if mode == "append" else w.overwritePartitions()
        else:
            wt = df.writeTo(target).using("iceberg")
            if partition_by:
                wt = wt.partitionedBy(*[F.col(c) for c in partition_by])
            wt.create()
    else:
        df.write.mode("append").format("jdbc").options(dbtable=target, **opts).save()


def rejects_beside(log_path: str) -> str:
    """Where the records go that could not be loaded into the log at a path."""
    return f"{log_path.rstrip('/')}-rejects"


def quality_beside(log_path: str) -> str:
    """Where the quality counters of the loads into the log at a path are kept."""
    return f"{log_path.rstrip('/')}-quality"


def materialize(df: DataFrame, name: str, kind: str = "view", path: str | None = None,
                format: str = "parquet") -> DataFrame:
    """Expose a layer as a view (lazy) or persist it as a table (lineage cut).

    A table is written below the shared ``spark.checkpoint.dir`` unless a path
    is given, then read back, so later stages restart from stored files rather
    than recomputing the chain (and survive executor loss).  The returned
    DataFrame is registered as temp view ``name``.
    """
    spark = df.sparkSession
    if kind == "view":
        out = df
    elif kind == "table":
        target = path or scratch_path(spark, name.replace(".", "_"))
        df.write.mode("overwrite").format(format).save(target)
        out = spark.read.format(format).load(target)
    else:
        raise ValueError(f"unknown materialization {kind!r}")
    out.createOrReplaceTempView(name.replace(".", "_"))
    return out


def export_report(df: DataFrame, name: str, out_dir: str, run_date: _dt.date | None = None,
                  format: str = "csv", single_file: bool = False) -> str | None:
    """Write a report as ``{out_dir}/{name}_{yyyymmdd}``; nothing when the result is empty.

    ``single_file=True`` funnels the result through one task into one file;
    use it only for aggregated reports of bounded size.  Otherwise each task
    writes its own part file.
    """
    if df.isEmpty():
        return None
    stamp = (run_date or _dt.date.today()).strftime("%Y%m%d")
    path = f"{out_dir.rstrip('/')}/{name}_{stamp}"
    out = df.coalesce(1) if single_file else df
    w = out.write.mode("overwrite").format(format)
    if format == "csv":
        w = w.option("header", True)
    w.save(path)
    return path
