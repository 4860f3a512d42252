"""Token counts that follow edits without encoding whole texts again.

A text is cut into segments of about ``segment_chars`` characters, always
between a character that is no white space and white space.  No pre-token of
byte-level BPE spans such a place and none looks past it, whatever stands around
it, so the segments' token counts add up to the text's exactly.  Over the
segments stands a binary tree of sums, of characters and of tokens, kept as two
arrays per document (root at 1, the children of i at 2i and 2i + 1).

An edit (start, stop, replacement; in characters) descends by the character sums
to the segments it touches.  A segment's border still holds after the edit if
the characters on both its sides are untouched, so the region reaches from the
segment of the character before the edit to that of the character after it.
Only this region is cut and encoded again, over the same leaves, and the sums on
the leaves' paths to the root are updated.

Edits of a document apply one after another, each to the text that the earlier
ones left.  Defined results: a null text counts as empty and has no tokens; null
or missing edits change nothing; a null replacement deletes; positions are
clamped to the text and a stop before its start to the start, a null start is 0
and a null stop the start; repeated rows and null ids are documents like others.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import map_arrow

SEGMENT_CHARS = 256
# No white space in any sense, then a plain white-space character.
BORDER = re.compile(r"[^\s\x1c-\x1f](?=[ \t\n\r])")


def borders(text: str, size: int) -> list[int]:
    """Segment starts, the first being 0."""
    out = [0]
    while out[-1] + size < len(text) and (found := BORDER.search(text, out[-1] + size - 1)):
        out.append(found.start() + 1)
    return out


def segments(text: str, size: int) -> list[str]:
    cuts = [*borders(text, size), len(text)]
    return [text[a:b] for a, b in zip(cuts, cuts[1:])]


class TokenTree:
    """A text's segments under a tree of character and token sums."""

    def __init__(self, leaves: list[str], chars: list[int], counts: list[int]):
        self.leaves, self.chars, self.tokens = leaves, chars, counts
        self.width = len(chars) // 2
        self.encoded_segments = self.encoded_chars = 0

    @classmethod
    def build(cls, text: str, count, size: int) -> "TokenTree":
        leaves = segments(text, size)
        width = 1 << (len(leaves) - 1).bit_length()
        chars, counts = [0] * (2 * width), [0] * (2 * width)
        for i, leaf in enumerate(leaves):
            chars[width + i], counts[width + i] = len(leaf), count(leaf)
        for i in range(width - 1, 0, -1):
            chars[i], counts[i] = chars[2 * i] + chars[2 * i + 1], counts[2 * i] + counts[2 * i + 1]
        return cls(leaves, chars, counts)

    @classmethod
    def restore(cls, text: str, chars: list[int], counts: list[int]) -> "TokenTree":
        leaves, at = [], 0
        for n in chars[len(chars) // 2:]:
            leaves.append(text[at:at + n])
            at += n
        return cls(leaves, chars, counts)

    def find(self, position: int) -> tuple[int, int]:
        """The leaf that holds a character, and where the leaf starts."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if position - start >= self.chars[node]:
                start += self.chars[node]
                node += 1
        return node - self.width, start

    def set_leaf(self, leaf: int, text: str, tokens_: int) -> None:
        node = self.width + leaf
        more_chars, more_tokens = len(text) - self.chars[node], tokens_ - self.tokens[node]
        self.leaves[leaf] = text
        while node:
            self.chars[node] += more_chars
            self.tokens[node] += more_tokens
            node //= 2

    def edit(self, start: int, stop: int, replacement: str, count) -> None:
        total = self.chars[1]
        start = min(max(start, 0), total)
        stop = min(max(stop, start), total)
        first, at = self.find(start - 1) if start else (0, 0)
        last = self.find(stop)[0] if stop < total else self.width - 1
        self.leaves += [""] * (last + 1 - len(self.leaves))
        old = "".join(self.leaves[first:last + 1])
        new = old[:start - at] + replacement + old[stop - at:]
        room = last + 1 - first
        cuts = [*borders(new, -(-len(new) // room) or 1)[:room], len(new)]
        parts = [new[a:b] for a, b in zip(cuts, cuts[1:])]
        for i in range(room):
            part = parts[i] if i < len(parts) else ""
            self.set_leaf(first + i, part, count(part) if part else 0)
        self.encoded_segments += len(parts)
        self.encoded_chars += len(new)

    def text(self) -> str:
        return "".join(self.leaves)


def counter(tokenizer: str | None):
    encode = tokens.load(tokenizer)
    return lambda text: len(encode(text))


TREE_DDL = "chars array<int>, tokens array<int>"


def build_trees(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (),
                segment_chars: int = SEGMENT_CHARS, tokenizer: str | None = None) -> DataFrame:
    """One row per document: id, text, ``chars`` and ``tokens`` (the tree), and the ``carry`` columns."""
    def run(batches):
        count = counter(tokenizer)
        for batch in batches:
            trees = [TokenTree.build(t or "", count, segment_chars) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([t.chars for t in trees], pa.list_(pa.int32())),
                 pa.array([t.tokens for t in trees], pa.list_(pa.int32())), *batch.columns[2:]],
                ["id", "text", "chars", "tokens", *(f"c{i}" for i in range(len(carry)))])

    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                       *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)))
    kinds = dict(slim.dtypes)
    schema = f"id {kinds['id']}, text string, {TREE_DDL}"
    schema += "".join(f", c{i} {kinds[f'c{i}']}" for i in range(len(carry)))
    return map_arrow(slim, run, schema).toDF(id_col, "text", "chars", "tokens", *carry)


def apply_edits(trees: DataFrame, id_col: str = "doc_id", edits_col: str = "edits",
                tokenizer: str | None = None) -> DataFrame:
    """The trees after their edits, with the counts before and after and the work done.

    ``edits`` is an array of (start, stop, replacement) structs on the tree's row.
    """
    numbers = ["n_tokens_before", "n_tokens", "n_segments", "encoded_segments", "encoded_chars"]

    def run(batches):
        count = counter(tokenizer)
        for batch in batches:
            texts, chars, counts, rows, edits = [], [], [], [], batch.column(4).to_pylist()
            for text, c, n, todo in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), edits):
                tree = TokenTree.restore(text or "", c, n)
                before, leaves = tree.tokens[1], sum(1 for x in c[len(c) // 2:] if x)
                for e in todo or ():
                    if e is not None:
                        start = e["start"] or 0
                        tree.edit(start, start if e["stop"] is None else e["stop"], e["replacement"] or "", count)
                texts.append(tree.text())
                chars.append(tree.chars)
                counts.append(tree.tokens)
                rows.append((before, tree.tokens[1], leaves, tree.encoded_segments, tree.encoded_chars))
            table = np.array(rows, np.int64).reshape(-1, len(numbers))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(chars, pa.list_(pa.int32())),
                 pa.array(counts, pa.list_(pa.int32())), *(pa.array(table[:, i]) for i in range(len(numbers)))],
                ["id", "text", "chars", "tokens", *numbers])

    slim = trees.select(F.col(f"`{id_col}`").alias("id"), "text", "chars", "tokens",
                        F.col(f"`{edits_col}`").cast(
                            "array<struct<start: long, stop: long, replacement: string>>").alias("edits"))
    schema = (f"id {dict(slim.dtypes)['id']}, text string, {TREE_DDL}, "
              + ", ".join(f"{c} long" for c in numbers))
    return map_arrow(slim, run, schema).withColumnRenamed("id", id_col)
