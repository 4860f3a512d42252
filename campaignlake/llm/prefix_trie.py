"""The prefix trie of conversations, from vertical bitmaps.

A node is a distinct sequence of first turns (role and text); its members are
the conversations that start with it.  In a shard, an index maps (position,
turn) to the bitset of the conversations that have this turn there.  Children of
a node are found depth first: the parent's bitset is intersected with the
posting of the next turn of its smallest conversation not placed yet, until none
is left.  A child's population count, smallest member and end list (members that
end there) come from its bitset.  Shards are consecutive conversation ids, so a
node's end lists follow each other in the order of shards.

Nodes of several shards are one where their paths are equal.  A path has a
128-bit key, the running sum of hashes of (position, turn), so conversations
need not be whole: shards take a bounded number of turns, and a conversation
longer than ``segment`` turns is cut into pieces that start from the path before.
A third of all conversations may share turns, or be equal, or be one
conversation: no step gathers a group of them.

Subtree sums need no walk up the tree: a node's smallest member owns it, every
conversation's path holds all ancestors of the nodes it owns, so a running sum
along each conversation from its end gives what it adds to each of them.

Defined results: turns sort by number, then role, then text, nulls first, and
repeated turns stay; a null role or text is empty; rows without a conversation id
belong to none; a conversation of ``conversations`` without turns is a member of
the root; no conversations give no nodes.  ``ends_sha256`` hashes one stream of
ids a node, in one task; it reads them in pieces of a shard and holds none.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_PATTERN, cut, map_arrow
from .ordered import PART, in_order, running

SHARD_TURNS = 16_384
SEGMENT_TURNS = 512
KEY = ["k1", "k2"]


def numbered_turns(table: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """``(conv_id, place, a, b, words)``: turns by place (from 1), as 128-bit digests."""
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    turns = table.select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
                         text(role_col).alias("role"), text(text_col).alias("text")).where("conv_id is not null")
    placed = in_order(turns, ["conv_id"], ["turn", "role", "text"], [
        "conv_id", F.xxhash64(F.lit(1), "role", "text").alias("a"), F.xxhash64(F.lit(2), "role", "text").alias("b"),
        F.regexp_count("text", F.lit(WORD_PATTERN)).cast("long").alias("words")])
    return running(placed, ["conv_id"], count="place").drop(PART)


class Shard:
    """The bitmaps of one shard's turns: columns sorted by conversation and depth."""

    def __init__(self, conv, depth, a, b, ends, segment: int):
        self.conv, self.depth, self.turn = conv, depth, list(zip(depth, a, b))
        self.first: list[int] = []   # per member (a conversation's piece) its first row
        self.postings: dict[tuple, int] = {}
        self.present: dict[int, int] = {}
        self.ending: dict[int, int] = {}
        for i, (c, d) in enumerate(zip(conv, depth)):
            if not i or c != conv[i - 1] or (d - 1) % segment == 0:
                self.first.append(i)
            bit = 1 << (len(self.first) - 1)
            self.postings[self.turn[i]] = self.postings.get(self.turn[i], 0) | bit
            self.present[d] = self.present.get(d, 0) | bit
            if ends[i]:
                self.ending[d] = self.ending.get(d, 0) | bit

    def members(self, bits: int):
        while bits:
            low = bits & -bits
            yield low.bit_length() - 1
            bits ^= low

    def nodes(self, bits: int, depth: int, key):
        """``(row, parent key, bitset)`` of all nodes below one that the members of ``bits`` share;
        ``key`` gives the key of a row's path."""
        stack = [(bits, depth, None)]
        while stack:
            bits, depth, parent = stack.pop()
            left = bits & self.present.get(depth + 1, 0)
            while left:
                m = (left & -left).bit_length() - 1
                row = self.first[m] + depth + 1 - self.depth[self.first[m]]
                child = left & self.postings[self.turn[row]]
                left ^= child
                yield row, parent, child
                stack.append((child, depth + 1, key(row)))


LOCAL = "k1 long, k2 long, p1 long, p2 long, depth long, words long, n long, conv_id long, ends string"


def _walk(segment: int):
    def walk(table: pa.Table) -> pa.Table:
        t = table.sort_by([("conv_id", "ascending"), ("depth", "ascending")])
        cols = {n: t.column(n).to_pylist() for n in ("conv_id", "depth", "a", "b", "words", "k1", "k2", "h1", "h2",
                                                     "ends")}
        shard = Shard(cols["conv_id"], cols["depth"], cols["a"], cols["b"], cols["ends"], segment)
        key = lambda r: (cols["k1"][r], cols["k2"][r])
        wrap = lambda x: ((x + (1 << 63)) % (1 << 64)) - (1 << 63)
        starts: dict[tuple, int] = {}  # members by the depth and path before their first turn
        for m, r in enumerate(shard.first):
            k1, k2 = key(r)
            start = (cols["depth"][r] - 1, wrap(k1 - cols["h1"][r]), wrap(k2 - cols["h2"][r]))
            starts[start] = starts.get(start, 0) | (1 << m)
        out = []
        for (depth, *before), bits in starts.items():
            for row, parent, found in shard.nodes(bits, depth, key):
                ends = found & shard.ending.get(cols["depth"][row], 0)
                out.append((*key(row), *(parent or before), cols["depth"][row], cols["words"][row],
                            found.bit_count(), cols["conv_id"][shard.first[(found & -found).bit_length() - 1]],
                            ",".join(str(shard.conv[shard.first[m]]) for m in shard.members(ends)) or None))
        names = [f.split()[0] for f in LOCAL.split(", ")]
        kinds = [pa.string() if n == "ends" else pa.int64() for n in names]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
    return walk


def _sha(batches):
    """Streams sorted (k1, k2, ends) rows into one hash a key."""
    key, sha, out = None, None, []
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())])
    flush = lambda: pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema)
    for batch in batches:
        for k1, k2, ends in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if (k1, k2) != key:
                if key is not None:
                    out.append((*key, sha.hexdigest()))
                key, sha = (k1, k2), hashlib.sha256(ends.encode())
            else:
                sha.update(b"," + ends.encode())
        if len(out) >= 10_000:
            yield flush()
            out.clear()
    if key is not None:
        out.append((*key, sha.hexdigest()))
    yield flush()


def build(turns: DataFrame, conversations: DataFrame, shard_turns: int = SHARD_TURNS,
          segment: int = SEGMENT_TURNS) -> DataFrame:
    """A row per node of the trie.

    ``turns``: (conv_id, place, a, b, words) with any places that sort;
    ``conversations``: (conv_id), each once, also those without turns.
    """
    placed = in_order(turns.select("conv_id", "place", "a", "b", "words"), ["conv_id"], ["place"],
                      ["conv_id", "a", "b", "words"])
    deep = running(placed, ["conv_id"], count="depth", last="ends", row="row")
    deep = (deep.withColumn("h1", F.xxhash64(F.lit(11), "depth", "a", "b"))
            .withColumn("h2", F.xxhash64(F.lit(12), "depth", "a", "b")))
    paths = running(deep, ["conv_id"], sums={"k1": "h1", "k2": "h2"})

    # A piece of a conversation goes to a shard as a whole, by the number of its first row.
    shard = F.expr(f"(row - (depth - 1) % {segment}) div {shard_turns}").alias("shard")
    local = (paths.select(shard, "conv_id", "depth", "a", "b", "words", "k1", "k2", "h1", "h2", "ends")
             .groupBy("shard").applyInArrow(_walk(segment), LOCAL))
    local = cut(local)
    below = local.groupBy("k1", "k2", "p1", "p2", "depth", "words").agg(
        F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    zero = F.lit(0).cast("long")
    top = conversations.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    top = top.select(zero.alias("k1"), zero.alias("k2"), F.lit(None).cast("long").alias("p1"),
                     F.lit(None).cast("long").alias("p2"), zero.alias("depth"), zero.alias("words"),
                     "n_convs", "conv_id")
    nodes = below.unionByName(top)
    children = nodes.where("p1 is not null").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count("*").alias("n_children"))
    nodes = cut(nodes.join(children, KEY, "left").fillna(0, ["n_children"]))

    # What each node adds to itself and the nodes above: tokens saved, and one if it is a leaf.
    own = nodes.select("conv_id", "depth", zero.alias("k1"), zero.alias("k2"),
                       ((F.col("n_convs") - 1) * F.col("words")).alias("saves"),
                       (F.col("n_children") == 0).cast("long").alias("leaf"), F.lit(0).alias("kind"))
    own = own.where("saves <> 0 or leaf <> 0")
    on_path = paths.select("conv_id", "depth", "k1", "k2", zero.alias("saves"), zero.alias("leaf"),
                           F.lit(1).alias("kind"))
    on_path = on_path.unionByName(conversations.select(
        "conv_id", *(zero.alias(c) for c in ("depth", "k1", "k2", "saves", "leaf")), F.lit(1).alias("kind")))
    upward = in_order(own.unionByName(on_path), ["conv_id"], [F.col("depth").desc(), F.col("kind")])
    below_each = (running(upward, ["conv_id"], sums={"s": "saves", "l": "leaf"})
                  .where("kind = 1 and (s <> 0 or l <> 0)").groupBy(KEY)
                  .agg(F.sum("s").alias("saved_tokens"), F.sum("l").alias("n_leaves")))

    turnless = conversations.join(paths.where("depth = 1").select("conv_id"), "conv_id", "left_anti")
    lists = (local.where("ends is not null").select("k1", "k2", "ends", "conv_id")
             .unionByName(turnless.select(zero.alias("k1"), zero.alias("k2"),
                                          F.col("conv_id").cast("string").alias("ends"), "conv_id")))
    ends = map_arrow(lists.repartition(*KEY).sortWithinPartitions(*KEY, "conv_id").select("k1", "k2", "ends"),
                     _sha, "k1 long, k2 long, ends_sha256 string")

    full = nodes.join(below_each, KEY).join(ends, KEY, "left").fillna(
        hashlib.sha256(b"").hexdigest(), ["ends_sha256"])
    full = cut(full)
    # A parent's member stands before its children's rows and is carried along them.
    heads = full.select(F.col("k1").alias("g1"), F.col("k2").alias("g2"), F.lit(0).alias("kind"),
                        F.col("conv_id").alias("parent"), *(F.lit(None).cast(t).alias(c) for c, t in full.dtypes))
    rows = full.where("p1 is not null").select(F.col("p1").alias("g1"), F.col("p2").alias("g2"), F.lit(1).alias("kind"),
                                               zero.alias("parent"), "*")
    held = running(in_order(heads.unionByName(rows), ["g1", "g2"], ["kind"]), ["g1", "g2"],
                   sums={"parent_conv_id": "parent"}).where("kind = 1")
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    root = full.where("p1 is null").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return held.select(names).unionByName(root.select(names))
