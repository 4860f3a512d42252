import random
from collections import Counter

import numpy as np
import pytest

from campaignlake.llm import decontaminate as dc

from .util import SF, WORD, empty_documents, lower, odd_documents


def shingles(words):
    return Counter([tuple(words)] if len(words) <= 5 else list(zip(*(words[i:] for i in range(5)))))


def similarity(a, b):
    a, b = shingles(a), shingles(b)
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def brute(docs, items):
    """Best window of every item in every document, all windows compared."""
    out = {}
    for doc_id, text in docs:
        words = WORD.findall(lower(text or ""))
        for item_id, item in items:
            want = WORD.findall(lower(item or ""))
            if not want or not words:
                continue
            if len(words) > 300 and shingles(words).keys().isdisjoint(shingles(want)) and len(want) >= 5:
                continue  # similarity 0 in every window
            starts = range(max(1, len(words) - len(want) + 1))
            best = max(similarity(words[i:i + len(want)], want) for i in starts)
            if best >= 0.8:
                out[doc_id, item_id] = best
    return out


def planted():
    rng = random.Random(5)
    vocabulary = [f"word{i}" for i in range(80)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, text(rng.choice([1, 3, 5, 6, 12, 30, 59]))) for i in range(40)]
    docs = []
    for d in range(120):
        words = text(rng.choice([0, 2, 10, 60, 300]))
        if d % 3:
            part = list(rng.choice(items)[1])
            for _ in range(d % 4):  # near copies: changed, dropped and added words
                at = rng.randrange(len(part)) if part else 0
                part[at:at + rng.randint(0, 1)] = text(rng.randint(0, 1))
            at = rng.randint(0, len(words))
            words[at:at] = part
        docs.append((d, rng.choice([" ", "\n", "  "]).join(w.upper() if rng.random() < .2 else w for w in words)))
    return docs, [(i, " ".join(w)) for i, w in items]


@pytest.mark.parametrize("block_bytes", [2_000_000, 900])
def test_every_similar_window_is_found(spark, block_bytes):
    docs, items = planted()
    got = dc.find(spark.createDataFrame(docs, "doc_id long, text string"),
                  spark.createDataFrame(items, "item_id long, text string"),
                  settings=dc.Settings(block_bytes=block_bytes)).collect()
    found = {(r["doc_id"], r["item_id"]): r["similarity"] for r in got}
    want = brute(docs, items)
    assert len(want) > 40 and found.keys() == want.keys()
    assert all(found[k] == pytest.approx(want[k]) for k in want)
    texts, lengths = dict(docs), dict(items)
    for r in got:
        words = WORD.findall(lower(texts[r["doc_id"]]))[r["start_word"]:][:r["n_words"]]
        assert similarity(words, WORD.findall(lower(lengths[r["item_id"]]))) == pytest.approx(r["similarity"])
    dirty = {d for d, _ in want}
    clean = dc.keep_clean(spark.createDataFrame(docs, "doc_id long, text string"),
                          spark.createDataFrame(items, "item_id long, text string"),
                          settings=dc.Settings(block_bytes=block_bytes))
    assert {r["doc_id"] for r in clean.collect()} == {d for d, _ in docs} - dirty


def test_real_tables_equal_brute_force_on_shared_passages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]) for r in dc.find(docs, bench).collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = set(brute(rows, [tuple(r) for r in bench.select("item_id", "text").collect()]))
    assert max(len(t) for _, t in rows) > 15_000 and want and got == want


def test_block_tables_miss_nothing_within_the_radius():
    rng = np.random.default_rng(1)
    prints = rng.random((130, dc.BITS)) < 0.5
    tables = dc.Tables(list(range(130)), prints, 40)
    windows = prints[rng.integers(0, 130, 600)].copy()
    for i, w in enumerate(windows):  # up to 50 bits flipped
        at = rng.permutation(dc.BITS)[:i % 51]
        w[at] = ~w[at]
    apart = (windows[:, None, :] != prints[None]).sum(2)
    window, item, distance = tables.candidates(windows)
    assert set(zip(window, item)) == set(zip(*np.nonzero(apart <= 40)))
    assert (distance == apart[window, item]).all()


def test_texts_at_the_edge_of_similarity_are_within_the_radius():
    rng = random.Random(9)
    lost = tried = 0
    while tried < 3000:
        words = [b"w%d" % rng.randrange(10_000) for _ in range(rng.randrange(12, 80))]
        other = list(words)
        for _ in range(rng.randrange(1, 4)):
            other[rng.randrange(len(other))] = b"x%d" % rng.randrange(10_000)
        a, b = dc.shingles(words, 5), dc.shingles(other, 5)
        common = sum((Counter(a) & Counter(b)).values())
        if 0.8 <= common / (2 * len(a) - common) < 0.9:
            tried += 1
            prints = [dc.packed(dc.simhash(dc.signed_bits(k).sum(0))[None])[0] for k in (a, b)]
            lost += np.bitwise_count(prints[0] ^ prints[1]).sum() > 40
    assert lost == 0


def test_a_repeated_item_does_not_grow_a_block(spark):
    bench = spark.createDataFrame([(1, "one and the same item text here")] * 500, "item_id long, text string")
    blocks = list(dc.item_blocks(bench, "item_id", "text", dc.Settings(block_bytes=20_000)))
    assert sum(len(b.ids) for b in blocks) == 500 and max(len(b.ids) for b in blocks) <= 101


def test_an_item_repeated_all_over_a_long_text():
    index = dc.Index([(1, b"a b c d e f g h"), (2, b"x y")], dc.Settings())
    found = index.search(b"a b c d e f g h " * 20_000 + b"x y " * 20_000)
    assert [(f["item_id"], f["start_word"], f["similarity"]) for f in found] == [(1, 0, 1.0), (2, 160_000, 1.0)]


def test_odd_input(spark):
    docs = odd_documents(spark)
    bench = spark.createDataFrame([(1, None), (2, ""), (None, "no id here"), (3, "One TWO three\nfour"), (4, "one")],
                                  "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in dc.find(docs, bench).collect()}
    assert got == {(None, None), (5, 3), (4, 4), (5, 4)}
    assert dc.keep_clean(docs, bench).columns == docs.columns
    assert dc.keep_clean(docs, bench).count() == docs.count() - 3
    assert dc.find(docs, bench.where("item_id = 1")).collect() == []
    assert dc.keep_clean(docs, bench.where("false")).count() == docs.count()
    assert dc.find(empty_documents(spark), bench).collect() == []
