import hashlib
import re
from collections import defaultdict

import pytest

from campaignlake.llm import ordered, prefix_trie, queries

from .util import SF, crc

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def conversations_of(rows):
    convs = defaultdict(list)
    for r in rows:
        if r["conv_id"] is not None:
            convs[r["conv_id"]].append((r["turn"] is not None, r["turn"] or 0, r["role"] or "", r["text"] or ""))
    return {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = crc(c) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + own[h:]
    return out


def brute(convs):
    """Rows of all nodes, from plain prefixes."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, cs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(cs) - 1) * len(WORD.findall(node[-1][1])) if node else 0
    out = []
    for node, cs in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in cs if len(convs[c]) == len(node)))
        out.append((min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), len(children[node]),
                    leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture()
def many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def build(table, **sizes):
    own = prefix_trie.numbered_turns(table)
    return prefix_trie.build(own, own.where("place = 1").select("conv_id"), **sizes)


def test_query_against_brute_force(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    assert result(queries.op11_conversation_prefix_trie(spark, SF)) == brute(
        rebuilt(conversations_of(table.collect())))


def odd_rows():
    rows = [(None, 1, "user", "nobody's"), (None, None, None, None)]
    for c in range(60):      # copies of one conversation, beside some that leave it early
        rows += [(c, t, "user" if t % 2 else "assistant", f"common turn {t}") for t in range(5 if c % 3 else 2 + c % 7)]
    rows += [(100, None, "user", "first"), (100, 2, None, "b a"), (100, 2, None, "a b"), (100, 2, None, "a b")]
    rows += [(101, 1, "", None), (102, 1, None, ""), (103, 1, "a", "b"), (104, 1, "ab", "")]
    rows += [(c, t, "user", "same word again" if t < 700 else f"turn {t} of {c % 2}") for c in (200, 201, 203)
             for t in range(760)]
    rows += [(300, 0, "user", "x y " * 60_000), (301, 0, "user", "x y " * 60_000), (-20, 3, "user", "négatif 🙂")]
    return rows


@pytest.mark.parametrize("sizes", [{}, {"shard_turns": 64, "segment": 7}])
def test_odd_input_shards_and_pieces(spark, many_partitions, sizes):
    rows = odd_rows()
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as place", "1 as k1", "'y' as ends").repartition(5)
    want = brute(conversations_of([dict(zip(("conv_id", "turn", "role", "text"), r)) for r in rows]))
    assert result(build(table, **sizes)) == want


def test_shared_heads_with_missing_short_and_turnless(spark):
    rows = [(c, t, "user", f"{c} {t}") for c in (0, 20, 21, 23, 25, 26, 28, 40, 41, 45, 61, 62, 65, 66, 67, 69)
            for t in range(1 if c in (20, 41, 62, 67) else 1 + c % 5)]
    got = queries.with_shared_heads(prefix_trie.numbered_turns(spark.createDataFrame(rows, SCHEMA)))
    own = prefix_trie.numbered_turns(spark.createDataFrame(rows, SCHEMA))
    convs = rebuilt(conversations_of([dict(zip(("conv_id", "turn", "role", "text"), r)) for r in rows]))
    assert min(map(len, convs.values())) == 0
    assert result(prefix_trie.build(got, own.where("place = 1").select("conv_id"))) == brute(convs)


def test_empty_table(spark):
    assert build(spark.createDataFrame([], SCHEMA)).collect() == []


def test_running_sums_over_partitions(spark, many_partitions):
    rows = [(k, i, (k * 7 + i * 13) % 11) for k, n in ((1, 3), (2, 500), (3, 1), (4, 90)) for i in range(n)]
    df = spark.createDataFrame(rows, "k long, i long, v long").repartition(7)
    placed = ordered.in_order(df, ["k"], ["i"])
    assert placed.groupBy(ordered.PART).count().count() > 3
    out = ordered.running(placed, ["k"], sums={"s": "v"}, count="n", last="end", row="row").collect()
    sums, seen = defaultdict(int), defaultdict(int)
    for at, r in enumerate(sorted(out, key=lambda r: (r["k"], r["i"]))):
        sums[r["k"]] += r["v"]
        seen[r["k"]] += 1
        size = {1: 3, 2: 500, 3: 1, 4: 90}[r["k"]]
        assert (r["s"], r["n"], r["row"], r["end"]) == (sums[r["k"]], seen[r["k"]], at, seen[r["k"]] == size)
