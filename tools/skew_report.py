"""Measure task skew of the history and the monthly roll-up on a deliberately skewed log.

    python tools/skew_report.py [sf_dir]

Five scenarios over logs derived from the driver tables:
* ``normal``: the log projection as is;
* ``copies+hot campaign, default`` / ``..., precombined``: one campaign holds a
  third of all rows, and about as many rows again are re-appended copies of a
  single natural key, without and with the map-side collapse of copies;
* ``hot key, default`` / ``hot key, split by day``: a third of the rows moved
  onto one natural key, each keeping its own load time, through the default
  history and through the day-split one.
Spark's event log is written to a fresh scratch folder; per stage it prints
the task count and the median / max task time and shuffle records read, so a
straggler (one task doing a hot group's work) would show as max >> median.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from campaignlake.operators import history, kpi, star  # noqa: E402
from campaignlake.session import build_session  # noqa: E402
from campaignlake.sources.fixtures import campaign_log  # noqa: E402


def skewed_log(log):
    """A third of the rows moved into one campaign, plus about as many copies of one key."""
    hot = log.withColumn("campaign_name", F.when(F.col("clicks") % 3 == 0, F.lit("HOT"))
                         .otherwise(F.col("campaign_name")))
    # one row to the driver (a tool, not a query): the key that gets copied
    k = hot.orderBy("campaigns_execution_date", "campaign_name", "ad_name", "_etl_loaded_at").first()
    copy_cols = [F.lit(k[c]).cast(hot.schema[c].dataType).alias(c) for c in hot.columns]
    copies = hot.where(F.col("registrations") % 3 == 0).select(*copy_cols)
    return hot.unionByName(copies)


def hot_key_log(log):
    """A third of the rows moved onto one natural key, each keeping its own load time."""
    one = F.col("clicks") % 3 == 0
    return (log.withColumn("campaign_name", F.when(one, F.lit("HOT")).otherwise(F.col("campaign_name")))
            .withColumn("ad_name", F.when(one, F.lit("HOT_AD")).otherwise(F.col("ad_name")))
            .withColumn("campaigns_execution_date",
                        F.when(one, F.lit("1998-01-01").cast("date")).otherwise(F.col("campaigns_execution_date"))))


def _event_lines(event_dir: str):
    """Lines of every event file below ``event_dir`` (Spark 4 writes rolling directories)."""
    for root, _, files in os.walk(event_dir):
        for f in sorted(files):
            if not f.startswith(("events_", "local-", "app-")) or f.endswith(".inprogress.crc"):
                continue
            path = os.path.join(root, f)
            if f.endswith(".zstd"):
                import zstandard
                with open(path, "rb") as fh:
                    text = zstandard.ZstdDecompressor().stream_reader(fh).read().decode()
                yield from text.splitlines()
            else:
                with open(path) as fh:
                    yield from fh


def stage_stats(event_dir: str):
    """Per stage: [(task ms, shuffle records read)] and the job group it ran under."""
    tasks = defaultdict(list)
    names = {}
    for line in _event_lines(event_dir):
        e = json.loads(line)
        if e.get("Event") == "SparkListenerJobStart":
            group = (e.get("Properties") or {}).get("spark.jobGroup.id", "")
            for sid in e.get("Stage IDs", []):
                names[sid] = group
        elif e.get("Event") == "SparkListenerTaskEnd":
            info, metrics = e["Task Info"], e.get("Task Metrics") or {}
            dur = info["Finish Time"] - info["Launch Time"]
            rd = metrics.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
            tasks[e["Stage ID"]].append((dur, rd))
    return tasks, names


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    event_dir = tempfile.mkdtemp(prefix="campaignlake-eventlog-")
    spark = build_session("local[8]", extra={"spark.eventLog.enabled": "true",
                                             "spark.eventLog.dir": event_dir})
    log = campaign_log(spark, sf_dir)
    cases = [("normal", log, history.history_from_log),
             ("copies+hot campaign, default", skewed_log(log), history.history_from_log),
             ("copies+hot campaign, precombined", skewed_log(log),
              lambda df: history.history_from_log(df, precombine=True)),
             ("hot key, default", hot_key_log(log), history.history_from_log),
             ("hot key, split by day", hot_key_log(log), history.history_from_log_split)]
    for label, df, build in cases:
        spark.sparkContext.setJobGroup(label, label)
        t0 = time.time()
        h = build(df)
        h.write.format("noop").mode("overwrite").save()
        t_hist = time.time() - t0
        t0 = time.time()
        kpi.monthly_campaign_summary(star.staging(h)).write.format("noop").mode("overwrite").save()
        t_month = time.time() - t0
        print(f"{label}: history={t_hist:.2f}s monthly={t_month:.2f}s", flush=True)
    spark.stop()
    tasks, names = stage_stats(event_dir)
    print(f"{'stage':>5} {'tasks':>5} {'med ms':>7} {'max ms':>7} {'med recs':>9} {'max recs':>9}  job group")
    for sid in sorted(tasks):
        ds = [d for d, _ in tasks[sid]]
        rs = [r for _, r in tasks[sid]]
        if len(ds) < 2 or max(rs) == 0:
            continue
        print(f"{sid:5d} {len(ds):5d} {statistics.median(ds):7.0f} {max(ds):7.0f} "
              f"{statistics.median(rs):9.0f} {max(rs):9.0f}  {names.get(sid, '')}")
    print(f"event log: {event_dir}")


if __name__ == "__main__":
    main(sys.argv)
