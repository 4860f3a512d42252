"""Best-fit packing of documents into sequences, large items first by matching.

A document's tokens and a closing id are one item; only documents longer than a
sequence are cut, into full pieces from the back, so that the first piece is the
one that may be shorter.  No item is cut to fill a gap.

Where an item goes depends on nothing but its length, so the packing is planned
on the histogram of lengths, whose size is bounded by the sequence length and
not by the data:

* large items (over a third of the capacity) share a bin with one other large
  item at most.  From the longest down, each is matched with the longest that
  still fits it, which leaves the fewest bins;
* smaller items follow from the longest down, each into the tightest gap that
  takes it, or into a new bin if there is none.

Equal lengths are placed in runs, so the plan is a few thousand runs "items
number r0 to r1 of length n go to bins from b on, k to a bin, from offset o".
Each piece has a number among those of its length: its place in its partition
plus the count in earlier partitions.  Pieces look their number up in the plan;
nothing is sorted and no group of pieces ever meets in one task.

Defined results: null and empty texts are one piece of one token, the closing
id; repeated rows are items of their own; empty input gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokens
from .common import cut, map_arrow

RANK_BITS = 40  # room for the number of an item among those of its length


class Plan:
    """Runs of equal lengths: rows (length, r0, first bin, per bin, offset), and the bins used."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.bins, self.runs = capacity, 0, []
        self._placed: dict[int, int] = {}
        self._gaps: dict[int, list[tuple[int, int]]] = {}
        self._sizes: list[int] = []
        if any(not 0 < n <= capacity for n in counts):
            raise ValueError("a length lies outside 1 to the capacity")
        self._match({n: c for n, c in counts.items() if 3 * n > capacity})
        for length in sorted((n for n in counts if 3 * n <= capacity), reverse=True):
            self._fit(length, counts[length])

    def _put(self, length: int, items: int, first_bin: int, per_bin: int, offset: int) -> None:
        start = self._placed.get(length, 0)
        self.runs.append((length, start, first_bin, per_bin, offset))
        self._placed[length] = start + items

    def _open(self, count: int) -> int:
        self.bins += count
        return self.bins - count

    def _add_gap(self, gap: int, first_bin: int, count: int) -> None:
        if gap and count:
            if gap not in self._gaps:
                self._gaps[gap] = []
                insort(self._sizes, gap)
            self._gaps[gap].append((first_bin, count))

    def _match(self, left: dict[int, int]) -> None:
        alive = sorted(left)
        while alive:
            long = alive[-1]
            at = bisect_right(alive, self.capacity - long) - 1
            if at < 0:
                bins, partner = left[long], None
                first = self._open(bins)
                self._put(long, bins, first, 1, 0)
            elif alive[at] == long and left[long] > 1:
                bins, partner = left[long] // 2, long
                first = self._open(bins)
                self._put(long, 2 * bins, first, 2, 0)
            else:
                if alive[at] == long:  # a single one is left and can't pair with itself
                    at -= 1
                partner = alive[at] if at >= 0 else None
                bins = min(left[long], left[partner]) if partner else left[long]
                first = self._open(bins)
                self._put(long, bins, first, 1, 0)
                if partner:
                    self._put(partner, bins, first, 1, long)
            self._add_gap(self.capacity - long - (partner or 0), first, bins)
            left[long] -= bins
            if partner:
                left[partner] -= bins
            alive = [n for n in alive if left[n]] if not (left[long] and left.get(partner, 1)) else alive

    def _fit(self, length: int, count: int) -> None:
        while count:
            at = bisect_left(self._sizes, length)
            if at == len(self._sizes):
                gap, bins = self.capacity, -(-count // (self.capacity // length))
                first = self._open(bins)
            else:
                gap = self._sizes[at]
                first, bins = self._gaps[gap].pop()
                if not self._gaps[gap]:
                    del self._gaps[gap], self._sizes[at]
            each = gap // length
            items = min(count, each * bins)
            full, rest = divmod(items, each)
            self._put(length, items, first, each, self.capacity - gap)
            self._add_gap(gap - each * length, first, full)
            if rest:
                self._add_gap(gap - rest * length, first + full, 1)
            self._add_gap(gap, first + full + bool(rest), bins - full - bool(rest))
            count -= items

    def table(self) -> np.ndarray:
        rows = np.array(self.runs, dtype=np.int64).reshape(-1, 5)
        return rows[np.argsort((rows[:, 0] << RANK_BITS) + rows[:, 1], kind="stable")]


def place(table: np.ndarray, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of the items with these lengths and numbers."""
    run = table[np.searchsorted((table[:, 0] << RANK_BITS) + table[:, 1],
                                (length << RANK_BITS) + rank, side="right") - 1]
    bins, within = np.divmod(rank - run[:, 1], run[:, 3])
    return run[:, 2] + bins, run[:, 4] + within * length


def pieces(docs: DataFrame, id_col: str, text_col: str, capacity: int, closing_id: int,
           tokenizer: str | None, with_ids: bool) -> DataFrame:
    """Tokenised documents cut to pieces, each numbered among its length in its partition."""
    columns = ["id", "piece", "start", "length", "ids_crc32", "part", "nth"]

    def run(batches):
        encode = tokens.load(tokenizer)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            taken, numbers, arrays = [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                ids = np.append(encode(text or ""), np.uint32(closing_id)).astype("<u4")
                first = len(ids) % capacity or capacity
                cuts = [0, *range(first, len(ids), capacity), len(ids)]
                for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    taken.append(row)
                    numbers.append((piece, a, b - a, zlib.crc32(ids[a:b].tobytes()), seen[b - a]))
                    seen[b - a] += 1
                    if with_ids:
                        arrays.append(ids[a:b].astype(np.int32))
            table = np.array(numbers, np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(taken, pa.int64())), pa.array(table[:, 0].astype(np.int32)),
                 pa.array(table[:, 1]), pa.array(table[:, 2]), pa.array(table[:, 3]),
                 pa.array(np.full(len(taken), part, np.int32)), pa.array(table[:, 4]),
                 *([pa.array(arrays, pa.list_(pa.int32()))] if with_ids else [])],
                columns + ["ids"] * with_ids)

    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return map_arrow(slim, run, f"id {dict(slim.dtypes)['id']}, piece int, start long, length long, "
                                "ids_crc32 long, part int, nth long" + ", ids array<int>" * with_ids)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048,
         closing_id: int = 0, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    cut_pieces = cut(pieces(docs, id_col, text_col, capacity, closing_id, tokenizer, with_ids))
    counts = cut(cut_pieces.groupBy("length", "part").agg(F.count("*").alias("n")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = Plan(histogram, capacity).table()
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = cut_pieces.join(base, ["length", "part"]).withColumn("rank", F.col("base") + F.col("nth"))
    names = ["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(batches):
        for batch in batches:
            of = dict(zip(batch.schema.names, batch.columns))
            bins, offsets = place(table, of["length"].to_numpy(), of["rank"].to_numpy())
            yield pa.RecordBatch.from_arrays([*(of[c] for c in names), pa.array(bins), pa.array(offsets)],
                                             [*names, "sequence_id", "offset"])

    kinds = dict(ranked.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in names) + ", sequence_id long, offset long"
    return map_arrow(ranked.select(*names, "rank"), run, schema).withColumnRenamed("id", id_col)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from ``pack(..., with_ids=True)``.

    A group is one sequence, so its size is bounded by the capacity.
    """
    return (packed.groupBy("sequence_id")
            .agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
            .select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.offset").alias("offsets")))
