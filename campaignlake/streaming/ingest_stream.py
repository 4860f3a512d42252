"""Incremental ingest as a Structured Streaming query over a landing folder.

The batch load tracks progress with a high-water mark on the execution date,
which never refills a skipped chunk.  A file-source stream tracks progress by
*file* in its checkpoint instead: each landed JSON file is cleaned and
appended exactly once, late or not, and a restarted query resumes where it
stopped.  Run it with ``availableNow`` as the daily job, or continuously.

Each micro-batch has two outputs, the log and the records that cannot be loaded,
both written with dynamic partition overwrite into ``load_batch=<epoch>``
partitions, so a retried epoch replaces its own output instead of appending it
twice.  Every record is in one of the two.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.ingest import clean, rejects
from ..schema import CORRUPT_COL, RECORD_SCHEMA
from ..sources.sinks import append, rejects_beside


def record_stream(spark: SparkSession, landing_dir: str, multi_line: bool = False,
                  max_files_per_trigger: int | None = None, once_within: str | None = None) -> DataFrame:
    """Streaming DataFrame of nested records from files landing in ``landing_dir``: JSON lines,
    or with ``multi_line`` an array of records per file.

    ``once_within`` (an interval such as ``"2 days"``) lets an equal record in again only if
    its file is that much younger: a file that lands twice under two names adds nothing.  The
    state holds a digest for each record of that time.
    """
    schema = T.StructType(RECORD_SCHEMA.fields + [T.StructField(CORRUPT_COL, T.StringType())])
    r = (spark.readStream.schema(schema).option("multiLine", multi_line)
         .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_COL)
         .option("allowNonNumericNumbers", True))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    records = r.json(landing_dir)
    if once_within:
        digest = F.sha2(F.to_json(F.struct(*records.columns)), 256)
        records = (records.select("*", digest.alias("__digest"), F.col("_metadata.file_modification_time").alias("__at"))
                   .withWatermark("__at", once_within).dropDuplicatesWithinWatermark(["__digest"])
                   .drop("__digest", "__at"))
    return records


def start_ingest_stream(spark: SparkSession, landing_dir: str, log_path: str, *,
                        checkpoint_location: str | None = None, available_now: bool = True,
                        processing_time: str | None = None, multi_line: bool = False,
                        max_files_per_trigger: int | None = None, once_within: str | None = None,
                        rejects_path: str | None = None, **clean_options) -> StreamingQuery:
    """Start the stream landing_dir -> clean -> log (append by epoch, idempotent on retry).

    Records that cannot be loaded go to ``rejects_path`` (default: beside the log) with their reason.

    Unless given, the checkpoint lies beside the log, at a path that follows from
    the log's, so that every run of the same log resumes where the last one
    stopped (a fresh checkpoint would number its batches from 0 again and
    overwrite theirs).
    """
    cp = checkpoint_location or f"{log_path.rstrip('/')}-stream-checkpoint"
    bad_path = rejects_path or rejects_beside(log_path)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        loaded_at = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        cleaned = clean(batch, loaded_at=loaded_at, **clean_options)
        append(cleaned.withColumn("load_batch", F.lit(epoch_id).cast("bigint")), log_path,
               partition_by=("load_batch", "execution_month"), mode="overwrite")
        append(rejects(batch).withColumn("load_batch", F.lit(epoch_id).cast("bigint")), bad_path,
               partition_by=("load_batch",), mode="overwrite")

    w = (record_stream(spark, landing_dir, multi_line, max_files_per_trigger, once_within).writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", cp))
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start()
