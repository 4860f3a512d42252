"""Session construction and shared-storage helpers.

Library functions never create a session; they take the caller's.  These
helpers are for tests, the bench and command-line use.
"""

from __future__ import annotations

import contextlib
import os
import re
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# Settings the library is designed around.  AQE re-plans joins from runtime
# sizes (a dimension becomes a broadcast only once its measured size is under
# the threshold), splits skewed shuffle partitions and coalesces tiny ones.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    # Files of checkpoint() go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # See compiled_code().
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = 8,
                  app_name: str = "campaignlake", extra: dict | None = None) -> SparkSession:
    """A session with the recommended settings.

    With a ``master`` (tests, bench) also a driver size for local mode; without
    one the master, sizes and the checkpoint folder come from the submission.
    """
    b = SparkSession.builder.appName(app_name)
    conf = dict(RECOMMENDED_CONF)
    if master:
        b = b.master(master)
        conf["spark.driver.memory"] = os.environ.get("CAMPAIGNLAKE_DRIVER_MEMORY", "8g")
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def compiled_code(spark: SparkSession) -> None:
    """Keep generated code to what the JVM compiles, in a session that does not say otherwise.

    Wide projections (the 23-column ingest coercion, the record documents) fuse
    into one generated method of ~40 KB, beyond the JVM's 8 KB limit for its
    compiler, so it would run in the bytecode interpreter.  At 8000 Spark keeps
    whole-stage code for every other subtree and uses split, compiled expression
    code for that one.  Only speed depends on it; a value set by the caller stays.
    """
    key = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(key) == "65535":  # Spark's default: whatever fits a class file
        spark.conf.set(key, RECOMMENDED_CONF[key])


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """Shuffle files of the writes made in here go as each ends, not when the driver next collects its garbage.

    What a write has stored is read from there, so nothing asks for them again.
    Spark before 4.1 does not know the setting and keeps them.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir`` (set one only if unset)."""
    return ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the cluster's ``spark.checkpoint.dir``; set a fallback only if it is unset.

    On a cluster this folder is shared storage, so lineage cut by
    ``checkpoint()`` or tables written below it survive executor loss.  Where
    none is named, a local session gets a folder of this machine; on a cluster
    that would lose data with the machine, so there it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured is None and current is None:
        if fallback is None and not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        configured = fallback or os.path.join(tempfile.gettempdir(), "campaignlake-checkpoints")
    if current is None:
        sc.setCheckpointDir(configured)
    return configured or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder for an intermediate table."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/campaignlake/{name}-{uuid.uuid4().hex[:12]}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that the caller wrote (nothing happens if it is gone)."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder (one listing, no files opened); none if there is no such folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def read_if_exists(spark: SparkSession, path: str, format: str = "parquet", schema=None) -> DataFrame | None:
    """The data at ``path``, or None if there is none yet; any other failure is raised."""
    if not path_exists(spark, path):
        return None
    reader = spark.read.format(format)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.load(path)
    except AnalysisException as e:
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # a folder without data
            return None
        raise
