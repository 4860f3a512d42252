"""SQL-file reports: every ``*.sql`` in a folder is a report named by its file stem.

The SQL text goes to ``spark.sql``; the views it names are
registered beforehand from DataFrames (so a report is planned together with
the layers it reads and Catalyst prunes what it does not use).
"""

from __future__ import annotations

import datetime as _dt
import glob
import os
import re

from pyspark.sql import DataFrame, SparkSession

from ..sources.sinks import export_report


def register_views(spark: SparkSession, views: dict[str, DataFrame]) -> dict[str, str]:
    """Register each DataFrame as a temp view; returns name -> view name.

    Nothing is written: a qualified name ``db.view`` becomes the temp view
    ``db__view``, and a report that uses the qualified name reads that.
    """
    names = {name: name.replace(".", "__") for name in views}
    for name, df in views.items():
        df.createOrReplaceTempView(names[name])
    return names


def run_sql_reports(spark: SparkSession, sql_dir: str,
                    views: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Plan every report of ``sql_dir`` (sorted by name); returns stem -> DataFrame."""
    names = register_views(spark, views or {})
    out: dict[str, DataFrame] = {}
    for path in sorted(glob.glob(os.path.join(sql_dir, "*.sql"))):
        with open(path, encoding="utf-8") as fh:
            text = fh.read().strip().rstrip(";")
        for name, view in names.items():
            if name != view:
                text = re.sub(rf"(?<![\w.`]){re.escape(name)}(?![\w.`])", view, text)
        out[os.path.splitext(os.path.basename(path))[0]] = spark.sql(text)
    return out


def export_reports(reports: dict[str, DataFrame], out_dir: str, run_date: _dt.date | None = None,
                   **kw) -> dict[str, str | None]:
    """Export each report; an empty report produces no file (value None)."""
    return {name: export_report(df, name, out_dir, run_date, **kw) for name, df in reports.items()}
