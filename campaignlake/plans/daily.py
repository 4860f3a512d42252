"""The daily run: load new records, rebuild the layers behind their check gates, export reports.

    python -m campaignlake.plans.daily --landing DIR --log DIR --warehouse DIR \\
        --target YYYY-MM-DD [--reports DIR --out DIR]

Order as in a staged warehouse build: load (high-water mark -> windows ->
clean -> append), a gate on the log's age and on jumps in the loaded values' quality, then snapshot -> staging -> core -> reporting, each layer
followed by its checks (a failure stops the run), then every ``*.sql``
report of ``--reports`` exported to ``--out`` (no file for an empty result).
"""

from __future__ import annotations

import argparse
import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import ntz_literal
from ..operators import checks, quality
from ..operators.windows import parse_target
from ..schema import LOADED_AT
from ..session import build_session
from ..sources.records import read_records
from .layers import Layers, build_layers
from .load import LoadResult, load, read_log, read_quality
from .reports import export_reports, run_sql_reports


@dataclass
class DailyResult:
    load: LoadResult
    rejected: int
    layers: Layers
    exported: dict[str, str | None]


def run_daily(spark: SparkSession, landing: str, log_path: str, warehouse: str, target, *,
              reports_dir: str | None = None, out_dir: str | None = None,
              date_range=None, multi_line: bool = False, refill_from=None, now: _dt.datetime | None = None,
              max_age_hours: tuple[float, float] = (24.0, 48.0), drift_limits: dict | None = None,
              **clean_options) -> DailyResult:
    """Load, check what was loaded, build the layers, run the reports.

    Two gates stand before the layers: the log must be fresh (newest load time against ``now``, by default
    the time of this load) and no column's share of faulty values may have jumped against earlier loads
    (:mod:`..operators.quality`; ``drift_limits`` are its parameters).
    """
    t = parse_target(target)
    loaded = load(spark, read_records(spark, landing, multi_line=multi_line), log_path, t,
                  refill_from=refill_from, **clean_options)
    rejected = store_rejects(loaded.rejects, f"{warehouse.rstrip('/')}/rejects/target={t.isoformat()}")
    log = read_log(spark, log_path, with_month=True)
    at = now or clean_options.get("loaded_at") or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    # Only rows young enough to pass are looked at; none is an error.
    young = log.where(F.col(LOADED_AT) >= ntz_literal(at - _dt.timedelta(hours=max_age_hours[1])))
    gates = [checks.freshness(young, LOADED_AT, at, *max_age_hours, "campaign_performance_raw_appends")]
    if loaded.quality is not None:
        gates.append(quality.drift_check(read_quality(spark, log_path), "load", **(drift_limits or {})))
    checks.gate("load", gates)
    kw = {"date_range": date_range} if date_range else {}
    layers = build_layers(log, warehouse=warehouse, **kw)
    exported: dict[str, str | None] = {}
    if reports_dir and out_dir:
        reports = run_sql_reports(spark, reports_dir, layers.tables)
        exported = export_reports(reports, out_dir, t, single_file=False)
    return DailyResult(load=loaded, rejected=rejected, layers=layers, exported=exported)


def store_rejects(rejects: DataFrame, path: str) -> int:
    """Write the rejected records with their reasons as JSON; returns how many there are."""
    counted = Observation("rejects")
    rejects.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").json(path)
    return int(counted.get.get("rows", 0) or 0)


def main(argv=None) -> None:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--landing", required=True)
    p.add_argument("--log", required=True)
    p.add_argument("--warehouse", required=True)
    p.add_argument("--target", default=(_dt.date.today() - _dt.timedelta(days=1)).isoformat())
    p.add_argument("--reports")
    p.add_argument("--out")
    p.add_argument("--json-arrays", action="store_true", help="landing files hold an array of records each")
    p.add_argument("--refill-from", help="also load dates from this day on that the log lacks")
    a = p.parse_args(argv)
    spark = build_session(app_name="campaignlake-daily", shuffle_partitions=None)
    r = run_daily(spark, a.landing, a.log, a.warehouse, a.target, reports_dir=a.reports,
                  out_dir=a.out, multi_line=a.json_arrays, refill_from=a.refill_from)
    print(f"hwm={r.load.hwm} appended={r.load.rows_appended} rejected={r.rejected} "
          f"history={r.layers.history_update.kind} exported={r.exported}")


if __name__ == "__main__":
    main()
