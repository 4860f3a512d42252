"""Language-model scores by deleted interpolation.

The model mixes three estimates of a token after its predecessor w:

    P(t | w) = l2 * c(w t) / c(w)  +  l1 * c(t) / N  +  l0 / (V + 1)

with counts over all training texts (a text starts after a start mark and ends
in an end token).  The weights depend on how often the context occurs: there is
a triple for each power of two of c(w).  They are learned by expectation
maximisation on held-out counts: every training token in turn is deleted from
the counts, and the weights make the tokens most likely under the counts that
lack them ((c(w t) - 1) / (c(w) - 1), (c(t) - 1) / (N - 1)).  For this the
deleted tokens are counted on a logarithmic grid of the estimates' ratios
(steps of an eighth of a power of two), a table of bounded size that all
training tokens enter.

Counts for a hundred million distinct bigrams can't be broadcast, and a row per
token would be shuffled twice.  So documents are first read into blocks of a few
million tokens, coded by the block's own word list.  A block asks for the counts
of its distinct words and bigrams, sorted by hash and cut into hash ranges; each
range's task adds up the training counts that the blocks bring along and answers
each block in the order it asked.  What moves is a compressed array for a block
and range, and a frequent word is one entry per block, so nothing is skewed.

Words are told apart by 64-bit hashes, bigrams by 56-bit ones.

Defined results: a null or empty text is one end token; without training texts
all counts are zero and every probability is 1 / (V + 1) = 1; repeated rows are
texts of their own; a null id is neither held out nor learned from.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_BYTES, cut, map_arrow, raw

BLOCK_TOKENS = 2_000_000   # tokens after which a block is closed
RANGE_TOKENS = 4_000_000   # tokens per hash range
BIGRAM_SHIFT = np.uint64(8)
LEVELS = 48                # context-frequency classes: 0, 1, 2-3, 4-7, ...
STEPS = 8                  # of the ratio grid, per power of two
ZERO = -(1 << 11)          # the grid's mark of an estimate of zero
END, START = (np.uint64(xxhash.xxh64_intdigest(x, 42)) for x in (b"", b" "))  # neither is a word


def squeeze(values: np.ndarray) -> bytes:
    """Compressed bytes of an integer array, byte lanes apart."""
    lanes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(lanes).tobytes())


def expand(data: bytes, kind) -> np.ndarray:
    lanes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(lanes.reshape(width, -1).T).view(kind).reshape(-1)


def squeeze_sorted(values: np.ndarray) -> bytes:
    return squeeze(np.diff(values, prepend=values.dtype.type(0)))


def expand_sorted(data: bytes, kind) -> np.ndarray:
    return np.cumsum(expand(data, kind), dtype=kind)


def join_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    x = first * np.uint64(0x9E3779B97F4A7C15) + second
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))) >> BIGRAM_SHIFT


def hash_range(hashes: np.ndarray, shift: int, ranges: int) -> np.ndarray:
    """Equal slices of the hash space; ``shift``: bits that the hashes lack at the top."""
    top = hashes >> np.uint64(32 - shift)
    return (top * np.uint64(ranges)) >> np.uint64(32)


# --- blocks -----------------------------------------------------------------

# words: sorted hashes; uses: how often each occurs in the block; tokens: the words' numbers, the
# most frequent word being 0, so that most numbers are small and compress well.
BLOCK_DDL = ("block long, ids array<{}>, held array<boolean>, lengths array<int>, words binary, uses binary, "
             "tokens binary")


def by_frequency(uses: np.ndarray) -> np.ndarray:
    """Number -> place among the sorted hashes."""
    return np.argsort(-uses.astype(np.int64), kind="stable")


def blocks(docs: DataFrame, block_tokens: int) -> DataFrame:
    """Coded blocks of the documents' tokens from columns id, held, text (binary)."""
    def run(batches):
        number = TaskContext.get().partitionId() << 32
        vocabulary: dict[bytes, int] = {b"": 0}
        ids, held, arrays, size, schema = [], [], [], 0, None

        def close():
            nonlocal number, size
            hashes = np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in vocabulary), np.uint64, len(vocabulary))
            words, place = np.unique(hashes, return_inverse=True)
            tokens = place[np.concatenate(arrays)]
            uses = np.bincount(tokens, minlength=len(words)).astype(np.uint32)
            code = np.empty(len(words), np.uint32)
            code[by_frequency(uses)] = np.arange(len(words), dtype=np.uint32)
            row = [number, pa.array(ids, schema.field(0).type), held[:], [len(a) for a in arrays],
                   squeeze_sorted(words), squeeze(uses), squeeze(code[tokens])]
            number, size = number + 1, 0
            vocabulary.clear()
            vocabulary[b""] = 0
            for kept in (ids, held, arrays):
                kept.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([row[0]], pa.int64()), pa.array([row[1].to_pylist()], pa.list_(schema.field(0).type)),
                 pa.array([row[2]], pa.list_(pa.bool_())), pa.array([row[3]], pa.list_(pa.int32())),
                 *(pa.array([blob], pa.binary()) for blob in row[4:])],
                ["block", "ids", "held", "lengths", "words", "uses", "tokens"])

        for batch in batches:
            schema = batch.schema
            for key, out, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), raw(batch.column(2))):
                found = WORD_BYTES.findall(text.lower()) if text else []
                put = vocabulary.setdefault
                codes = [put(w, len(vocabulary)) for w in found]
                codes.append(0)
                ids.append(key)
                held.append(out)
                arrays.append(np.array(codes, np.uint32))
                size += len(codes)
                if size >= block_tokens:
                    yield close()
        if ids:
            yield close()

    return map_arrow(docs, run, BLOCK_DDL.format(dict(docs.dtypes)["id"]))


def token_pairs(tokens: np.ndarray, lengths: np.ndarray, words: int) -> tuple[np.ndarray, ...]:
    """Distinct bigrams as (first, second) numbers, each token's bigram, and where texts start.

    The number after the words' stands for the start mark.
    """
    starts = np.cumsum(lengths) - lengths
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[starts] = words
    keys, pair = np.unique(before * words + tokens, return_inverse=True)
    return *np.divmod(keys, words), pair, starts


def learns(held: list[bool | None]) -> np.ndarray:
    return np.array([h is False for h in held], bool)


class Block:
    """A decoded block: tokens, and its distinct words and bigrams in the order of their hashes."""

    def __init__(self, row: dict):
        self.words = expand_sorted(row["words"], np.uint64)
        self.place = by_frequency(expand(row["uses"], np.uint32))
        self.tokens = expand(row["tokens"], np.uint32).astype(np.int64)
        lengths = np.array(row["lengths"], np.int64)
        self.learned = np.repeat(learns(row["held"]), lengths)
        self.first, self.second, self.pair, _ = token_pairs(self.tokens, lengths, len(self.words))
        by_number = np.append(self.words[self.place], START)
        hashes = join_hashes(by_number[self.first], by_number[self.second])
        # Distinct bigrams that share a hash share an entry.
        self.bigrams, self.entry = np.unique(hashes, return_inverse=True)

    def learned_counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Training tokens of each word and of each bigram entry, in the order of the hashes."""
        words = np.empty(len(self.words), np.int64)
        words[self.place] = np.bincount(self.tokens[self.learned], minlength=len(self.words))
        return words, np.bincount(self.entry[self.pair[self.learned]], minlength=len(self.bigrams))


# --- counts by hash range ---------------------------------------------------

def requests(coded: DataFrame, ranges: int) -> DataFrame:
    """What each block asks of each hash range: hashes, with its own training counts."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                out = []
                for kind, (hashes, counts) in enumerate(zip((block.words, block.bigrams), block.learned_counts())):
                    where = hash_range(hashes, 8 * kind, ranges)
                    present, at = np.unique(where, return_index=True)
                    for r, a, b in zip(present.tolist(), at, [*at[1:], len(where)]):
                        out.append((kind, r, row["block"], squeeze_sorted(hashes[a:b]),
                                    squeeze(counts[a:b].astype(np.uint32))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.int64(),
                                                               pa.binary(), pa.binary()))],
                    ["kind", "slice", "block", "hashes", "counts"])

    return map_arrow(coded.select("block", "held", "lengths", "words", "uses", "tokens"), run,
                     "kind int, slice long, block long, hashes binary, counts binary")


def answers(asked: DataFrame) -> DataFrame:
    """For each request the training counts over all blocks, in the order asked.

    The row with a null block has the sum of a range's counts and the number of
    its entries that occur in training.
    """
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        hashes = [expand_sorted(r["hashes"], np.uint64) for r in rows]
        counts = np.concatenate([expand(r["counts"], np.uint32) for r in rows])
        distinct, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.bincount(inverse, weights=counts, minlength=len(distinct)).astype(np.int64)
        parts = np.split(total[inverse], np.cumsum([len(h) for h in hashes])[:-1])
        kind, part = rows[0]["kind"], rows[0]["slice"]
        out = [(r["block"], kind, part, squeeze(p), None, None) for r, p in zip(rows, parts)]
        out.append((None, kind, part, None, int(total.sum()), int((total > 0).sum())))
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                        names=["block", "kind", "slice", "counts", "total", "distinct"])

    return asked.groupBy("kind", "slice").applyInArrow(
        run, "block long, kind int, slice long, counts binary, total long, distinct long")


COUNTED_DDL = ("ids array<{}>, held array<boolean>, lengths array<int>, tokens binary, word_counts binary, "
               "pair_counts binary, cells binary, times binary")


def counted_blocks(coded: DataFrame, found: DataFrame, texts: int, tokens: int, distinct: int) -> DataFrame:
    """The blocks with their answers in place of the hashes.

    ``word_counts`` goes by the words' numbers, ``pair_counts`` by the distinct
    bigrams; ``cells`` and ``times`` are the block's deleted tokens on the grid.
    """
    names = ["ids", "held", "lengths", "tokens", "word_counts", "pair_counts", "cells", "times"]

    def run(batches):
        for batch in batches:
            of = dict(zip(batch.schema.names, batch.columns))
            for at, row in enumerate(batch.drop_columns(["ids"]).to_pylist()):
                block = Block(row)
                parts = sorted(row["found"], key=lambda f: (f["kind"], f["slice"]))
                word, pair = (np.concatenate([expand(f["counts"], np.int64) for f in parts if f["kind"] == kind])
                              for kind in (0, 1))
                word, pair = word[block.place], pair[block.entry]
                context = np.append(word, texts)
                times = np.bincount(block.pair[block.learned], minlength=len(pair))
                cells, times = deleted_events(pair, context[block.first], word[block.second], times, tokens, distinct)
                blobs = (row["tokens"], squeeze(word), squeeze(pair), squeeze_sorted(cells), squeeze(times))
                yield pa.RecordBatch.from_arrays(
                    [*(of[c].slice(at, 1) for c in names[:3]), *(pa.array([x], pa.binary()) for x in blobs)], names)

    per_block = (found.where("block is not null").groupBy("block")
                 .agg(F.collect_list(F.struct("kind", "slice", "counts")).alias("found")))
    kind = dict(coded.dtypes)["ids"].removeprefix("array<").removesuffix(">")
    return map_arrow(coded.join(per_block, "block"), run, COUNTED_DDL.format(kind))


# --- weights ----------------------------------------------------------------

def level(counts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(counts), np.int64)
    seen = counts > 0
    out[seen] = np.minimum(np.log2(counts[seen].astype(np.float64)).astype(np.int64) + 1, LEVELS - 1)
    return out


def grid(estimate: np.ndarray, base: float) -> np.ndarray:
    out = np.full(len(estimate), ZERO, np.int64)
    some = estimate > 0
    out[some] = np.rint(STEPS * np.log2(estimate[some] / base)).astype(np.int64)
    return out


def deleted_events(c12: np.ndarray, c1: np.ndarray, c2: np.ndarray, times: np.ndarray, tokens: int,
                   distinct: int) -> tuple[np.ndarray, np.ndarray]:
    """Grid cells of training tokens under the counts without them, and how many are in each.

    For each bigram: its count, its context's, its token's, and how often it is deleted.
    """
    use = times > 0
    c12, c1, c2, times = c12[use] - 1, c1[use] - 1, c2[use] - 1, times[use]
    base = 1.0 / (distinct + 1)
    g2, g1 = grid(c12 / np.maximum(c1, 1), base), grid(c2 / max(tokens - 1, 1), base)
    cells, inverse = np.unique(((level(c1) << 24) + ((g2 - ZERO) << 12)) + (g1 - ZERO), return_inverse=True)
    return cells, np.bincount(inverse, weights=times, minlength=len(cells)).astype(np.int64)


def histogram(counted: DataFrame) -> tuple[list[int], list[int]]:
    """All blocks' deleted tokens on the grid; a task adds its blocks up first."""
    def run(batches):
        total: dict[int, int] = {}
        for batch in batches:
            for cells, times in zip(*(c.to_pylist() for c in batch.columns)):
                for cell, n in zip(expand_sorted(cells, np.int64).tolist(), expand(times, np.int64).tolist()):
                    total[cell] = total.get(cell, 0) + n
        yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.int64()), pa.array(total.values(), pa.int64())],
                                         ["cell", "times"])

    rows = (map_arrow(counted.select("cells", "times"), run, "cell long, times long")
            .groupBy("cell").agg(F.sum("times").alias("times")).collect())
    return [r["cell"] for r in rows], [r["times"] for r in rows]


def learn_weights(cells: np.ndarray, times: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Mixture weights (bigram, unigram, uniform) for each level, by EM."""
    weights = np.full((LEVELS, 3), 1 / 3)
    weights[0] = (0.0, 0.5, 0.5)
    cells, times = np.asarray(cells, np.int64), np.asarray(times, np.float64)
    levels, g = cells >> 24, np.stack([(cells >> 12) & 0xFFF, cells & 0xFFF], axis=1) + ZERO
    ratio = np.ones((len(cells), 3))
    ratio[:, :2] = np.where(g == ZERO, 0.0, 2.0 ** (g / STEPS))
    mass = np.bincount(levels, weights=times, minlength=LEVELS)
    for _ in range(rounds):
        share = weights[levels] * ratio
        share *= (times / share.sum(1))[:, None]
        new = np.stack([np.bincount(levels, weights=share[:, k], minlength=LEVELS) for k in range(3)], axis=1)
        new = np.where(mass[:, None] > 0, new / np.maximum(mass, 1)[:, None], weights)
        moved, weights = np.abs(new - weights).max(), new
        if moved < 1e-9:
            break
    # Any token stays possible after any context.
    weights[:, 2] = np.maximum(weights[:, 2], 1e-6)
    return weights / weights.sum(1, keepdims=True)


# --- scores -----------------------------------------------------------------

def score_block(row: dict, texts: int, tokens: int, distinct: int, weights: np.ndarray) -> list[np.ndarray]:
    """n_tokens, n_known, base_score and score of each text of a counted block."""
    word, c12 = expand(row["word_counts"], np.int64), expand(row["pair_counts"], np.int64)
    lengths, numbers = np.array(row["lengths"], np.int64), expand(row["tokens"], np.uint32).astype(np.int64)
    first, second, pair, starts = token_pairs(numbers, lengths, len(word))
    c1, c2 = np.append(word, texts)[first], word[second]
    w = weights[level(c1)]
    p = (w[:, 0] * c12 / np.maximum(c1, 1) + w[:, 1] * c2 / max(tokens, 1)
         + w[:, 2] / (distinct + 1)) if tokens else np.full(len(first), 1.0 / (distinct + 1))
    base = np.log10((word + 0.5) / (tokens + 0.5 * (distinct + 1)))
    add = lambda per_token: np.add.reduceat(per_token, starts)
    return [lengths, add((word > 0).astype(np.int64)[numbers]), add(base[numbers]), add(np.log10(p)[pair])]


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
          block_tokens: int = BLOCK_TOKENS, range_tokens: int = RANGE_TOKENS) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Counts come from the documents for which ``held_out`` is false.
    """
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), held_out.alias("held"),
                       F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))
    coded = cut(blocks(slim, block_tokens))
    size, texts = coded.agg(
        F.sum(F.expr("aggregate(lengths, 0L, (a, x) -> a + x)")),
        F.sum(F.expr("size(filter(held, x -> not x))"))).first()
    ranges = int((size or 0) // range_tokens) + 1
    found = cut(answers(requests(coded, ranges)))
    row = found.where("block is null and kind = 0").agg(F.sum("total"), F.sum("distinct")).first()
    tokens, distinct, texts = (int(x or 0) for x in (*row, texts))
    counted = cut(counted_blocks(coded, found, texts, tokens, distinct))
    weights = learn_weights(*histogram(counted))

    def scored(batches):
        for batch in batches:
            ids = batch.column(0)
            for at, r in enumerate(batch.drop_columns(["ids"]).to_pylist()):
                n, known, base, full = score_block(r, texts, tokens, distinct, weights)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, 1).flatten(), pa.array([h is True for h in r["held"]], pa.bool_()),
                     pa.array(n), pa.array(known), pa.array(np.full(len(n), tokens, np.int64)),
                     pa.array(base), pa.array(full)],
                    ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    kind = dict(slim.dtypes)["id"]
    return map_arrow(counted.drop("cells", "times"), scored, f"id {kind}, held_out boolean, n_tokens long, n_known long, "
                     "train_tokens long, base_score double, score double").withColumnRenamed("id", id_col)
