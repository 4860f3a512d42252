import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from campaignlake.llm import common, components, queries, simhash_dedup as sd

from .util import SF, WORD, empty_documents, lower, odd_documents


def plain_fingerprint(text):
    words = WORD.findall(lower(text or ""))
    if not words:
        return 0
    shingles = [words] if len(words) < 3 else [words[i:i + 3] for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, distance):
    """Root position of each fingerprint, all pairs compared."""
    a, parent = np.array(fps, dtype=np.uint64), list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(a)):
        for j in np.nonzero(np.bitwise_count(a[i + 1:] ^ a[i]) <= distance)[0] + i + 1:
            x, y = find(i), find(int(j))
            parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(a))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_query_equals_brute_force(spark):
    rows = sorted(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    fps = [plain_fingerprint(r["text"]) for r in rows]
    roots = plain_components(fps, 2)
    want = {r["doc_id"]: (f"{f:016x}", rows[root]["doc_id"]) for r, f, root in zip(rows, fps, roots)}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"])
           for r in queries.op7_simhash_near_dedup(spark, SF).collect()}
    assert got == want


def test_embedding_counts_segment_bits(spark):
    rng = random.Random(1)
    fps = [0, (1 << 64) - 1, 1 << 63, *(rng.getrandbits(64) for _ in range(200))]
    rows = spark.createDataFrame([(signed(f),) for f in fps], "fp long").select(
        "fp", sd.embedding(F.col("fp")).alias("c"), sd.grid_points(sd.embedding(F.col("fp"))).alias("g")).collect()
    for f, r in zip(fps, rows):
        counts = [(f >> 4 * i & 15).bit_count() for i in range(16)]
        assert r["c"] == sum(c << 4 * i for i, c in enumerate(counts))
        assert len([x for x in r["g"] if x is not None]) == 1 + sum((c < 4) + (c > 0) for c in counts)


@pytest.mark.parametrize("crowded", [64, 2])
@pytest.mark.parametrize("distance", [0, 1, 2])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, distance, crowded):
    """Chains, and a dense cloud around one fingerprint, on the usual and on the finest grid."""
    monkeypatch.setattr(sd, "CROWDED", crowded)
    rng, fps = random.Random(distance), set()
    for _ in range(40):
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 8)):
            fps.add(x)
            for _ in range(rng.randint(1, 3)):
                x ^= 1 << rng.randrange(64)
    centre = rng.getrandbits(64)
    for _ in range(400):
        x = centre
        for _ in range(rng.randint(0, 4)):
            x ^= 1 << rng.randrange(8)  # one corner of the grid
        fps.add(x)
    fps = sorted(fps)
    classes = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    found = components.connected_components(sd.links(classes, distance)).collect()
    at = {signed(f): i for i, f in enumerate(fps)}
    got = list(range(len(fps)))
    groups = {}
    for r in found:
        groups.setdefault(r["root"], []).append(at[r["node"]])
    for members in groups.values():
        for m in members:
            got[m] = min(members)
    assert got == plain_components(fps, distance)


def test_connected_components_of_long_chains(spark):
    ids = list(range(300))
    random.Random(2).shuffle(ids)
    edges = [(a, b) for a, b in zip(ids[:200], ids[1:200])] + [(a, b) for a, b in zip(ids[200:], ids[201:])]
    got = components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = {i: min(ids[:200]) for i in ids[:200]} | {i: min(ids[200:]) for i in ids[200:]}
    assert sorted((r["node"], r["root"]) for r in got) == sorted(want.items())


def test_a_hub_spreads_over_tasks(spark):
    """Edges to one node, and rows of one key, are dealt by key and salt; every link counts."""
    edges = spark.range(1, 5001).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"))
    got = components.connected_components(edges)
    assert got.groupBy("root").count().collect() == [(0, 5001)]
    joined, low = components._with_smallest(edges.select("a", "b"))
    assert joined.count() == 5000 and low.collect() == [(0, 1)]
    dealt = edges.withColumn("salt", common.salt(F.col("b"))).groupBy("a", "salt").count()
    assert dealt.count() == common.SALTS and dealt.agg(F.max("count")).first()[0] < 5000 / common.SALTS * 2


def test_spread_join_equals_a_plain_join(spark):
    rows = spark.range(2000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 40).alias("k"),
                                    F.col("id").alias("v"))
    values = spark.range(30).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    got = common.spread_join(rows, values, "k", common.salt(F.col("v")))
    assert sorted(got.collect()) == sorted(rows.join(values, "k").collect())
    assert common.spread_join(rows.where("false"), values, "k", common.salt(F.col("v"))).collect() == []


def test_odd_input(spark):
    docs = odd_documents(spark)
    got = sd.groups(docs).collect()
    assert len(got) == docs.count()
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert {by[i]["fingerprint"] for i in (1, 2, 3)} == {"0" * 16}
    assert {by[i]["component_id"] for i in (1, 2, 3)} == {1} and by[7]["component_id"] == 6
    assert all(r["fingerprint"] == f"{plain_fingerprint(d['text']):016x}"
               for d in docs.collect() for r in got if r["doc_id"] == d["doc_id"] and d["doc_id"] is not None)
    kept = sd.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [1, 4, 5, 6, 8, 9, 10]
    assert sd.groups(empty_documents(spark)).collect() == []
    assert sd.keep_first(empty_documents(spark)).collect() == []


def test_one_row_of_a_group_stays_even_with_equal_ids(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (2, "other words here now")],
                                 "doc_id long, text string")
    assert sorted(r["doc_id"] for r in sd.keep_first(docs).collect()) == [1, 2]
