"""Benchmark decontamination with SimHash over item-sized windows.

An item of n words is looked for in every window of n consecutive words of a
document (in the whole document if it is shorter).  A window's fingerprint is
the SimHash of its five-word shingles, weighted by how often each occurs.
Candidates come from a multi-index over fingerprints: the items' 128 bits are cut
into 12 blocks, and two fingerprints within ``radius`` bits agree in some block to
within radius / 12 bits.  Per window size and block, a table gives for each value
of the block the items whose block is that near; a window's candidates are the
items of any of its block values, less those whose whole fingerprint is beyond the
radius.  They are verified exactly: the weighted Jaccard similarity of the two
shingle multisets (sum of minima over sum of maxima) must reach ``similarity``.

Two texts at similarity 0.8 differ in 19.4 of 128 bits on average (standard
deviation 4.1); the default radius of 40 lies five deviations above it, so about
one in five million is left out at that very edge, and none above it.

A window that shares no shingle with an item of its size has similarity zero with
all of them.  So only windows around a known shingle are fingerprinted and looked
up; nothing that the last step would accept is lost by that.

Benchmark items are a query set read in blocks of a bounded number of bytes, cut
along their running size, so that repeated items fill blocks like any others:
each block is one pass over the documents and the only thing sent to the
executors, so memory does not grow with the benchmark (an item is never split).

Words are compared with A-Z in lower case and split at ASCII white space.

Defined results: null and wordless texts and items match nothing; an item of
fewer than five words is one shingle; repeated rows and items match each on
its own; a null ``item_id`` is reported as null.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_BYTES, cut, fresh, raw
from .ordered import in_order, running

BITS = 128
BLOCKS, BLOCK_BITS = 12, 11  # the last block holds what is left of the bits
ITEM_BYTES = 200             # an item counts as at least so many bytes: its share of the tables is 3 KB
PAIRS = 4_000_000            # windows times items that are looked at at once


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    similarity: float = 0.8
    radius: int = 40
    block_bytes: int = 2_000_000  # bound of what one pass sends to the executors (some 150 MB there)


def shingles(words: list[bytes], size: int) -> list[tuple]:
    if len(words) <= size:
        return [tuple(words)] if words else []
    return list(zip(*(words[i:] for i in range(size))))


def signed_bits(keys: list[tuple]) -> np.ndarray:
    """+1 or -1 for each shingle and fingerprint bit."""
    digests = np.frombuffer(b"".join(xxhash.xxh3_128_digest(b" ".join(k), 42) for k in keys), np.uint8)
    return np.unpackbits(digests.reshape(-1, BITS // 8), axis=1).astype(np.int32) * 2 - 1


def simhash(sums: np.ndarray) -> np.ndarray:
    """Fingerprints, rows of bits, from rows of signed sums."""
    return sums > 0


def packed(prints: np.ndarray) -> np.ndarray:
    return np.packbits(prints, axis=-1).view(np.uint64).reshape(-1, BITS // 64)


def block_values(prints: np.ndarray) -> np.ndarray:
    """The blocks of fingerprints as numbers: rows of BLOCKS."""
    filled = np.zeros((len(prints), BLOCKS * BLOCK_BITS), np.int32)
    filled[:, :BITS] = prints
    return filled.reshape(-1, BLOCKS, BLOCK_BITS) @ (1 << np.arange(BLOCK_BITS, dtype=np.int32))


class Tables:
    """The multi-index over the fingerprints of items of one size."""

    def __init__(self, numbers: list[int], prints: np.ndarray, radius: int):
        self.numbers, self.radius, self.prints = numbers, radius, packed(prints)
        # near[block, value]: a bit for each item whose block differs from the value in radius / BLOCKS bits at most.
        values = block_values(prints)
        self.near = np.zeros((BLOCKS, 1 << BLOCK_BITS, -(-len(numbers) // 64)), np.uint64)
        every = np.arange(1 << BLOCK_BITS, dtype=values.dtype)
        for item in range(len(numbers)):
            for block in range(BLOCKS):
                close = np.bitwise_count(every ^ values[item, block]) <= radius // BLOCKS
                self.near[block, close, item // 64] |= np.uint64(1 << (item % 64))

    def candidates(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, distance) of all pairs within the radius."""
        values = block_values(windows)
        found = self.near[0, values[:, 0]]
        for block in range(1, BLOCKS):
            found = found | self.near[block, values[:, block]]
        bits = np.unpackbits(found.view(np.uint8), axis=1, bitorder="little")
        window, item = np.nonzero(bits)
        apart = np.bitwise_count(packed(windows)[window] ^ self.prints[item]).sum(axis=1, dtype=np.int64)
        within = apart <= self.radius
        return window[within], item[within], apart[within]


class Index:
    """A block of benchmark items: their shingles, and the fingerprint tables by window size."""

    def __init__(self, items: list[tuple[int | None, bytes]], settings: Settings):
        self.settings = settings
        self.ids, self.weights = [], []
        by_size: dict[int, tuple[list, list]] = {}
        known: dict[tuple, set[int]] = {}
        for item_id, text in items:
            words = WORD_BYTES.findall(text.lower())
            keys = shingles(words, settings.shingle)
            if not keys:
                continue
            numbers, prints = by_size.setdefault(len(words), ([], []))
            numbers.append(len(self.ids))
            prints.append(simhash(signed_bits(keys).sum(0)))
            self.ids.append(item_id)
            self.weights.append(Counter(keys))
            for k in self.weights[-1]:
                known.setdefault(k, set()).add(len(words))
        self.tables = {size: Tables(n, np.array(p), settings.radius) for size, (n, p) in sorted(by_size.items())}
        # Sizes of the windows that a shingle can be part of; items shorter than a shingle are one of their own length.
        self.sizes = {k: tuple(sorted(s)) for k, s in known.items()}
        self.lengths = sorted({len(k) for k in self.sizes})

    def search(self, text: bytes | None) -> list[dict]:
        """The best window of each item that the text contains."""
        words = WORD_BYTES.findall(text.lower()) if text else []
        near: dict[int, list[list[int]]] = {}  # window size -> ranges of window starts, in order
        for length in self.lengths:
            if len(words) >= length:
                parts = [words[i:] for i in range(length)]
                if self.sizes.keys().isdisjoint(zip(*parts)):
                    continue
                for at, key in enumerate(zip(*parts)):
                    for size in self.sizes.get(key, ()):
                        # Every window of the size that holds this shingle.
                        last = max(0, len(words) - size)
                        low, high = max(0, min(last, at + length - size)), min(last, at)
                        ranges = near.setdefault(size, [])
                        if ranges and low <= ranges[-1][1] + 1:
                            ranges[-1][1] = max(high, ranges[-1][1])
                        else:
                            ranges.append([low, high])
        best: dict[int, dict] = {}
        for size in sorted(near):
            self.look_up(size, near[size], words, best)
        return [best[number] for number in sorted(best)]

    def look_up(self, size: int, ranges: list[list[int]], words: list[bytes], best: dict[int, dict]) -> None:
        """Enter the first of the most similar windows, among those that start in the ranges, of each item found."""
        shingle, tables = min(self.settings.shingle, size), self.tables[size]
        for low, high in pieces(ranges, min(4096, PAIRS // len(tables.numbers) + 1)):
            part = words[low:high + size]
            keys = shingles(part, shingle)
            width = min(len(keys), max(1, min(size, len(part)) - shingle + 1))
            sums = np.zeros((len(keys) + 1, BITS), np.int32)
            np.cumsum(signed_bits(keys), axis=0, out=sums[1:])
            counts: tuple[int, Counter] = (-1, Counter())
            for i, item, apart in zip(*tables.candidates(simhash(sums[width:] - sums[:-width]))):
                number = tables.numbers[item]
                before = best.get(number)
                if before is not None and before["similarity"] == 1.0:
                    continue
                if counts[0] != i:
                    counts = (i, Counter(keys[i:i + width]))
                have, want = counts[1], self.weights[number]
                common = sum((have & want).values())
                score = common / (sum(have.values()) + sum(want.values()) - common)
                if score >= self.settings.similarity and (before is None or score > before["similarity"]):
                    best[number] = {"item_id": self.ids[number], "start_word": low + int(i),
                                    "n_words": min(size, len(part)), "similarity": score, "distance": int(apart)}


def pieces(ranges: list[list[int]], most: int) -> list[tuple[int, int]]:
    """The ranges cut to a bounded length, so that scratch space is bounded in very long texts."""
    return [(a, min(a + most - 1, high)) for low, high in ranges for a in range(low, high + 1, most)]


MATCH = pa.struct([("item_id", pa.int64()), ("start_word", pa.int64()), ("n_words", pa.int64()),
                   ("similarity", pa.float64()), ("distance", pa.int64())])
MATCH_DDL = "array<struct<item_id: long, start_word: long, n_words: long, similarity: double, distance: long>>"


def matches_column(text: Column, index: Index) -> Column:
    """The matches of a text column in one block of items."""
    @F.arrow_udf(MATCH_DDL)
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([index.search(t) for t in raw(texts)], pa.list_(MATCH))

    return run.asNondeterministic()(text.cast("string").cast("binary"))


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, settings: Settings):
    """Indexes of bounded size that together hold all items, cut along the running size of the sorted items."""
    items = benchmark.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                             F.col(f"`{text_col}`").cast("string").alias("text")).where("text is not null")
    items = items.select("*", F.lit(0).cast("long").alias("all"),
                         F.greatest(F.octet_length("text"), F.lit(ITEM_BYTES)).cast("long").alias("size"))
    placed = running(in_order(items, ["all"], ["id", "text"]), ["all"], sums={"upto": "size"})
    placed = cut(placed.select("id", "text", F.expr(f"(upto - size) div {settings.block_bytes}").alias("block")))
    for (block,) in placed.select("block").distinct().orderBy("block").collect():  # a row a block
        rows = placed.where(F.col("block") == block).select("id", "text").collect()
        index = Index(sorted(((r["id"], r["text"].encode()) for r in rows),
                             key=lambda r: (r[0] is None, r[0] or 0, r[1])), settings)
        if index.ids:
            yield index


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_id_col: str = "item_id", item_text_col: str = "text",
         settings: Settings = Settings()) -> DataFrame:
    """One row per document and item found in it, with the item's best window."""
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    out = None
    for index in item_blocks(benchmark, item_id_col, item_text_col, settings):
        found = slim.select("id", F.explode(matches_column(F.col("text"), index)).alias("m"))
        out = found if out is None else out.union(found)
    if out is None:
        out = slim.select("id", F.explode(F.lit(None).cast(MATCH_DDL)).alias("m"))
    return out.select(F.col("id").alias(id_col), "m.item_id", "m.start_word", "m.n_words",
                      "m.similarity", "m.distance")


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
               item_id_col: str = "item_id", item_text_col: str = "text",
               settings: Settings = Settings()) -> DataFrame:
    """The documents in which no benchmark item is found."""
    out = docs
    for index in item_blocks(benchmark, item_id_col, item_text_col, settings):
        mark = fresh(out, "matches")
        out = out.withColumn(mark, matches_column(F.col(f"`{text_col}`"), index))
        out = out.where(F.size(mark) == 0).select([F.col(f"`{c}`") for c in docs.columns])
    return out
