import zlib
from collections import Counter

import numpy as np
import pytest

from campaignlake.llm import queries, sharding

from .util import SF, empty_documents, odd_documents


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4096, 4097, 100_003])
def test_permutation(n):
    p = sharding.Permutation(n, seed=3)
    there = p.forward(np.arange(n))
    assert sorted(there) == list(range(n))
    assert (p.backward(there) == np.arange(n)).all()


def test_shard_and_slot_are_computable_both_ways():
    rows = np.arange(12_345)
    shard, slot = sharding.locate(rows, 12_345, 16, seed=1)
    assert (sharding.row_at(shard, slot, 12_345, 16, seed=1) == rows).all()
    assert abs(np.corrcoef(rows, shard * 1000 + slot)[0, 1]) < 0.05
    with pytest.raises(ValueError):
        sharding.locate(np.array([12_345]), 12_345, 16)


def check(docs, out, shards):
    want = Counter((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode()))
                   for r in docs.select("doc_id", "text").collect())
    rows = out.collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(slots.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return rows


def test_query_and_layout_independence(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = check(docs, queries.op4_sharding(spark, SF), 16)
    assert {r["law"] for r in rows} == {"rows"} and {r["grown_shard"] for r in rows} == {None}
    again = sharding.shard_rows(docs.repartition(7).orderBy("n_chars"), 16).collect()
    assert {(r["doc_id"], r["shard"], r["slot"]) for r in rows} == {(r["doc_id"], r["shard"], r["slot"]) for r in again}
    other = sharding.shard_rows(docs, 16, seed=1).collect()
    assert {(r["doc_id"], r["shard"]) for r in rows} != {(r["doc_id"], r["shard"]) for r in other}


def test_odd_input(spark):
    docs = odd_documents(spark)
    check(docs, sharding.shard_rows(docs, 4), 4)
    check(docs, sharding.shard_rows(docs, 50), 50)
    assert sharding.shard_rows(empty_documents(spark), 4).collect() == []


def test_many_equal_rows_spread(spark):
    docs = spark.createDataFrame([(1, "same")] * 3000, "doc_id long, text string").repartition(8)
    check(docs, sharding.shard_rows(docs, 16), 16)


def test_shuffled_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = sharding.shuffled(docs, sharding.shard_rows(docs, 4))
    assert out.count() == docs.count() and set(docs.columns) < set(out.columns)


def plain_place(row, n, shards, seed):
    """Shard and slot of a row number by the book, on whole numbers."""
    mask64 = 2 ** 64 - 1

    def mix(x, key):
        x = (x + key) & mask64
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & mask64
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & mask64
        return x ^ (x >> 31)

    keys = [mix((seed * 0x9E3779B97F4A7C15 + r) & mask64, r + 1) for r in range(6)]
    half = 1
    while 4 ** half < n:
        half += 1
    while True:  # walk the cycle until the number lies in the table
        left, right = divmod(row, 2 ** half)
        for key in keys:
            left, right = right, left ^ (mix(right, key) % 2 ** half)
        row = left * 2 ** half + right
        if row < n:
            return row % shards, row // shards


@pytest.mark.parametrize("shards, seed", [(16, 0), (3, 5)])
def test_places_are_the_permuted_ranks_of_the_sorted_rows(spark, shards, seed):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.unionByName(docs.limit(20)).unionByName(odd_documents(spark, extra=False)).repartition(5)
    plain = [(r["doc_id"], zlib.crc32((r["text"] or "").encode()), len((r["text"] or "").encode()) + 1)
             for r in docs.select("doc_id", "text").collect()]
    plain.sort(key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))
    want = Counter((*r, *plain_place(i, len(plain), shards, seed)) for i, r in enumerate(plain))
    got = sharding.shard_rows(docs, shards, seed).collect()
    assert Counter((r["doc_id"], r["text_crc32"], r["size"], r["shard"], r["slot"]) for r in got) == want
