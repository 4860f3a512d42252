"""Helpers shared by the operators of this package."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from campaignlake.session import ensure_checkpoint_dir

# A word, wherever a contract speaks of words: anything but ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WORD_BYTES = re.compile(WORD_PATTERN.encode())
WORD_TEXT = re.compile(WORD_PATTERN)

MASK64 = (1 << 64) - 1
SALTS = 64  # tasks that the rows of one key spread over


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and go on from the files.

    Later stages neither recompute nor depend on what single executors hold.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = f"__{stem}"
    while name.lower() in taken:
        name = f"__{stem}_{uuid.uuid4().hex[:8]}"
    return name


def salt(by: Column) -> Column:
    return F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")


def spread_join(rows: DataFrame, values: DataFrame, key: str, salted: Column) -> DataFrame:
    """``rows`` with the columns of ``values``, which has one row a key; keys without one go.

    A value is repeated once for each salt that its key has rows of, so a key
    with very many rows spreads over ``SALTS`` tasks and a rare one costs no more
    than in a plain join.
    """
    name = fresh(rows, "salt")
    rows = rows.withColumn(name, salted)
    met = rows.select(key, name).distinct().join(values, key)
    return rows.join(met, [key, name]).drop(name)


def crc_mod(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus`` (null id: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def raw(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string or binary Arrow column."""
    if not pa.types.is_binary(column.type):
        column = column.cast(pa.binary())
    return column.to_pylist()
