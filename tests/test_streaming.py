"""Structured Streaming ingest: each landed file is cleaned and appended exactly once."""

import json
import os

from campaignlake.streaming import start_ingest_stream


def land(path, name, records):
    os.makedirs(path, exist_ok=True)
    tmp = os.path.join(path, f".{name}.tmp")
    with open(tmp, "w") as fh:
        json.dump(records, fh)
    os.rename(tmp, os.path.join(path, name))  # atomic publish into the landing folder


def rec(day, clicks):
    return {"date": day, "campaign": "C", "ad": "A", "cost": 10, "clicks": clicks,
            "metrics": [{"lifeday": 1, "players": 1, "revenue": "0.5"}]}


def test_stream_resumes_without_a_given_checkpoint(spark, tmp):
    landing, log = f"{tmp}/landing", f"{tmp}/log"
    land(landing, "b1.json", [rec("2024-10-01", 1), rec("2024-10-02", 2)])
    start_ingest_stream(spark, landing, log, multi_line=True).awaitTermination(120)
    land(landing, "b2.json", [rec("2024-10-03", 3)])
    start_ingest_stream(spark, landing, log, multi_line=True).awaitTermination(120)
    assert sorted(r["clicks"] for r in spark.read.parquet(log).collect()) == [1, 2, 3]


def test_stream_appends_each_file_once(spark, tmp):
    landing, log, cp = f"{tmp}/landing", f"{tmp}/log", f"{tmp}/cp"
    land(landing, "b1.json", [rec("2024-10-01", 1), rec("2024-10-02", 2)])
    q = start_ingest_stream(spark, landing, log, checkpoint_location=cp, multi_line=True)
    q.awaitTermination(120)
    assert spark.read.parquet(log).count() == 2
    # a rerun with no new file adds nothing; a new file adds only its rows
    q = start_ingest_stream(spark, landing, log, checkpoint_location=cp, multi_line=True)
    q.awaitTermination(120)
    assert spark.read.parquet(log).count() == 2
    land(landing, "b2.json", [rec("2024-10-03", 3)])
    q = start_ingest_stream(spark, landing, log, checkpoint_location=cp, multi_line=True)
    q.awaitTermination(120)
    df = spark.read.parquet(log)
    assert sorted(r["clicks"] for r in df.collect()) == [1, 2, 3]
    assert {r["revenue_1d_cents"] for r in df.collect()} == {50}
    assert "load_batch" in df.columns and "execution_month" in df.columns
