"""Reproducible shuffle into shards by a Feistel permutation of row numbers.

Rows are numbered from 0 to N - 1 in the order of (id, checksum, size), so a
number depends on the rows alone and not on files or partitions.  A keyed
Feistel network permutes the numbers below the next power of four, and a number
that lands at N or beyond walks on along its cycle until it is below N: that is
a permutation of 0 to N - 1.  A row at permuted position p goes to shard
p mod S, slot p div S, so shard sizes differ by one at most, slots have no gaps,
and both can be computed from the row number alone, and back (``locate`` and
``row_at``), without the table.

Numbering never gathers rows: a range partitioning of the small digests
(id, checksum, size), a count per partition, and the place within the partition.
Equal digests are spread by a salt, as it does not matter which of them gets
which of their numbers.

Defined results: a null text has size 1 and the checksum of no bytes; null ids
sort first; repeated rows get a slot each; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import MASK64, cut, map_arrow

ROUNDS = 6
PARTITION_BITS = 33  # monotonically_increasing_id: partition above, row within it below


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """A round's function: 64-bit finaliser of the half and the round's key."""
    x = x + np.uint64(key)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _keys(seed: int) -> list[int]:
    return [int(_mix(np.array([(seed * 0x9E3779B97F4A7C15 + r) & MASK64], np.uint64), r + 1)[0])
            for r in range(ROUNDS)]


class Permutation:
    """A keyed permutation of 0 to n - 1 with its inverse."""

    def __init__(self, n: int, seed: int = 0):
        self.n, self.keys = n, _keys(seed)
        self.half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)

    def _network(self, x: np.ndarray, inverse: bool) -> np.ndarray:
        half, mask = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        left, right = x >> half, x & mask
        if inverse:
            for key in reversed(self.keys):
                left, right = right ^ (_mix(left, key) & mask), left
        else:
            for key in self.keys:
                left, right = right, left ^ (_mix(right, key) & mask)
        return (left << half) | right

    def _walk(self, x: np.ndarray, inverse: bool) -> np.ndarray:
        x = np.asarray(x, dtype=np.uint64)
        if x.size and int(x.max()) >= self.n:
            raise ValueError("a number lies outside the permuted range")
        out = self._network(x, inverse)
        while (outside := out >= np.uint64(self.n)).any():
            out[outside] = self._network(out[outside], inverse)
        return out.astype(np.int64)

    def forward(self, x: np.ndarray) -> np.ndarray:
        return self._walk(x, False)

    def backward(self, x: np.ndarray) -> np.ndarray:
        return self._walk(x, True)


def locate(row: np.ndarray, n: int, shards: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Shard and slot of row numbers in a table of ``n`` rows."""
    slot, shard = np.divmod(Permutation(n, seed).forward(row), shards)
    return shard, slot


def row_at(shard: np.ndarray, slot: np.ndarray, n: int, shards: int, seed: int = 0) -> np.ndarray:
    """The row number that sits in a shard's slot."""
    return Permutation(n, seed).backward(np.asarray(slot) * shards + np.asarray(shard))


def numbered(digests: DataFrame, order: list[str]) -> DataFrame:
    """``digests`` with ``row``, the global number in the given order."""
    salted = digests.withColumn("__salt", F.hash(F.monotonically_increasing_id()))
    placed = (salted.repartitionByRange(*order, "__salt").sortWithinPartitions(*order)
              .drop("__salt").withColumn("__at", F.monotonically_increasing_id()))
    placed = cut(placed.withColumn("__part", F.shiftright("__at", PARTITION_BITS))
                 .withColumn("__at", F.col("__at").bitwiseAND(F.lit((1 << PARTITION_BITS) - 1))))
    counts = placed.groupBy("__part").agg(F.count("*").alias("n"))  # a row per partition
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__base"))
    return (placed.join(base, "__part").withColumn("row", F.col("__base") + F.col("__at"))
            .drop("__part", "__at", "__base"))


def shard_rows(docs: DataFrame, shards: int = 16, seed: int = 0, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """One row per document: id, size, text_crc32, row, shard and slot."""
    text = F.col(f"`{text_col}`").cast("string").cast("binary")
    digests = docs.select(F.col(f"`{id_col}`").alias("id"),
                          (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
                          F.crc32(F.coalesce(text, F.lit(b""))).alias("text_crc32"))
    rows = numbered(digests, ["id", "text_crc32", "size"])
    total = rows.count()
    names = ["id", "size", "text_crc32", "row"]

    def run(batches):
        for batch in batches:
            of = dict(zip(batch.schema.names, batch.columns))
            shard, slot = locate(of["row"].to_numpy(), total, shards, seed)
            yield pa.RecordBatch.from_arrays(
                [*(of[c] for c in names), pa.array(shard.astype(np.int32)), pa.array(slot)],
                [*names, "shard", "slot"])

    kind = dict(rows.dtypes)["id"]
    return map_arrow(rows.select(*names), run, f"id {kind}, size long, text_crc32 long, row long, "
                                               "shard int, slot long").withColumnRenamed("id", id_col)


def shuffled(docs: DataFrame, placed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents of a table with unique ids in shard and slot order.

    Partitions are ranges of (shard, slot), so a large shard spreads over many;
    ready for ``write.partitionBy("shard")``.  Columns of the documents named
    ``shard`` or ``slot`` are replaced.
    """
    docs = docs.drop("shard", "slot")
    where = placed.select(F.col(id_col).alias("__id"), F.col("shard").alias("__shard"), F.col("slot").alias("__slot"))
    joined = docs.join(where, docs[id_col].eqNullSafe(F.col("__id"))).drop("__id")
    return (joined.repartitionByRange("__shard", "__slot").sortWithinPartitions("__shard", "__slot")
            .withColumnsRenamed({"__shard": "shard", "__slot": "slot"}))
