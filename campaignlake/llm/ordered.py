"""Running counts and sums along sorted groups, without gathering a group in a task.

``in_order`` deals rows to ranges of (keys, order) and writes them below the
checkpoint folder; a group may span any number of partitions.  ``running`` then
goes over the partitions twice: the first pass tells of each partition its first
and last group and what it holds of the last one (one small row a partition, the
only thing that reaches the driver), the second starts from what the partitions
before hold of its first group.  Keys are longs without nulls.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from .common import MASK64, cut, map_arrow

PART = "__part"


def in_order(df: DataFrame, keys: list[str], order: list[Column | str], keep: list[Column | str] = ("*",)) -> DataFrame:
    """``keep`` of the rows, sorted by keys and order over all partitions; equal rows are spread."""
    placed = (df.withColumn("__salt", F.hash(F.monotonically_increasing_id()))
              .repartitionByRange(*keys, *order, "__salt").sortWithinPartitions(*keys, *order).drop("__salt"))
    return cut(placed.select(*keep, F.spark_partition_id().alias(PART)))


def _signed(x: int) -> int:
    return ((x + (1 << 63)) & MASK64) - (1 << 63)


class Along:
    """Counts and wrapping 64-bit sums along the groups of one partition's batches."""

    def __init__(self, carry=None, sums: int = 0):
        self.key, self.count, self.sums = carry or (None, 0, (0,) * sums)

    def step(self, keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
        n = len(keys[0])
        new = np.zeros(n, bool)
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
        new[0] = self.key != tuple(int(k[0]) for k in keys)
        goes_on = np.cumsum(new) == 0  # rows of the group that the batch before ended with
        first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        count = np.arange(n) - first + 1 + np.where(goes_on, self.count, 0)
        sums = []
        for v, so_far in zip(values, self.sums):
            total = np.cumsum(v, dtype=np.int64)
            sums.append(total - np.where(first > 0, total[first - 1], 0) + np.where(goes_on, np.int64(so_far), 0))
        self.key = tuple(int(k[-1]) for k in keys)
        self.count, self.sums = int(count[-1]), tuple(int(s[-1]) for s in sums)
        return count, sums


def _numpy(batch: pa.RecordBatch, names: list[str]) -> list[np.ndarray]:
    return [batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False).astype(np.int64)
            for n in names]


def running(placed: DataFrame, keys: list[str], sums: dict[str, str] | None = None, count: str | None = None,
            last: str | None = None, row: str | None = None) -> DataFrame:
    """``placed`` (from ``in_order``) with columns added to each row.

    ``count``: number of rows of its group up to it; ``sums``: by name, the column
    summed over those rows (wrapping); ``last``: whether it is its group's last;
    ``row``: its number in the whole table, from 0.
    """
    sums = sums or {}
    summed = list(sums.values())
    width = len(keys)

    def tails(batches):
        along, first, rows = Along(sums=len(summed)), None, 0
        part = None
        for batch in batches:
            if not batch.num_rows:
                continue
            along.step(k := _numpy(batch, keys), _numpy(batch, summed))
            if first is None:
                first, part = [int(x[0]) for x in k], batch.column(PART)[0].as_py()
            rows += batch.num_rows
        if first is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([[part, rows, *first, *along.key, along.count, *along.sums]], pa.list_(pa.int64()))], ["t"])

    carry, after, base, open_, rows, before = {}, {}, {}, None, 0, None
    for part, n, *rest in sorted(r["t"] for r in map_arrow(placed, tails, "t array<long>").collect()):
        first, final = tuple(rest[:width]), tuple(rest[width:2 * width])
        held, values = rest[2 * width], tuple(rest[2 * width + 1:])
        base[part], rows = rows, rows + n
        after[before], before = first, part
        joins = open_ is not None and open_[0] == first
        if joins:
            carry[part] = open_
        if joins and first == final:
            open_ = (final, open_[1] + held, tuple(_signed(a + b) for a, b in zip(open_[2], values)))
        else:
            open_ = (final, held, values)

    def run(batches):
        along, waiting, at = None, None, 0

        def closed(held, following):
            batch, columns, names, final = held
            if last:
                k = _numpy(batch, keys)
                ends = np.ones(batch.num_rows, bool)
                ends[:-1] = np.logical_or.reduce([x[1:] != x[:-1] for x in k])
                ends[-1] = following != final
                columns, names = [*columns, pa.array(ends)], [*names, last]
            return pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *names])

        part = None
        for batch in batches:
            if not batch.num_rows:
                continue
            k = _numpy(batch, keys)
            if along is None:
                part = batch.column(PART)[0].as_py()
                along = Along(carry.get(part), len(summed))
            if waiting:
                yield closed(waiting, tuple(int(x[0]) for x in k))
            counted, totals = along.step(k, _numpy(batch, summed))
            columns, names = [pa.array(t) for t in totals], list(sums)
            if count:
                columns, names = [*columns, pa.array(counted)], [*names, count]
            if row:
                columns, names = [*columns, pa.array(base[part] + at + np.arange(batch.num_rows))], [*names, row]
            at += batch.num_rows
            waiting = (batch, columns, names, along.key)
        if waiting:
            yield closed(waiting, after.get(part))

    extra = [*(StructField(n, LongType()) for n in [*sums, *([count] if count else []), *([row] if row else [])]),
             *([StructField(last, BooleanType())] if last else [])]
    return map_arrow(placed, run, StructType([*placed.schema.fields, *extra]))
