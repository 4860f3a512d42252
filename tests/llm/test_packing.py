import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from campaignlake.llm import packing, tokens

from .util import SF, empty_documents, odd_documents


def engine():
    t = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    t.encode_special_tokens = True
    return t


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, g in enumerate(gaps) if g >= n]
        if fits:
            gaps[min(fits, key=lambda i: gaps[i])] -= n
        else:
            gaps.append(capacity - n)
    return len(gaps)


@pytest.mark.parametrize("seed", range(40))
def test_plan_places_everything_gapless(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 10, 30, 100, 2048])
    counts = {rng.randint(1, capacity): rng.randint(1, rng.choice([1, 3, 50])) for _ in range(rng.randint(0, 60))}
    plan = packing.Plan(counts, capacity)
    table, bins = plan.table(), {}
    for n, c in counts.items():
        for b, o in zip(*packing.place(table, np.full(c, n), np.arange(c))):
            bins.setdefault(int(b), []).append((int(o), n))
    assert sorted(bins) == list(range(plan.bins))
    for items in bins.values():
        at = 0
        for offset, n in sorted(items):
            assert offset == at
            at += n
        assert at <= capacity
        assert sum(3 * n > capacity for _, n in items) <= 2
    assert plan.bins <= best_fit_decreasing([n for n, c in counts.items() for _ in range(c)], capacity)


def test_lengths_outside_the_capacity_raise():
    with pytest.raises(ValueError):
        packing.Plan({11: 1}, 10)


def check(docs, packed, capacity):
    """Whole texts, cut only where needed, back to back in sequences."""
    hf, want = engine(), {}
    for r in docs.select("doc_id", "text").collect():
        ids = [*hf.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids), capacity), len(ids)]
        for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
            key = (r["doc_id"], p, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
            want[key] = want.get(key, 0) + 1
    got, bins = {}, {}
    for r in packed.collect():
        key = (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
        got[key] = got.get(key, 0) + 1
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert got == want
    for items in bins.values():
        at = 0
        for offset, n in sorted(items):
            assert offset == at
            at += n
        assert at <= capacity
    lengths = [k[3] for k, c in want.items() for _ in range(c)]
    assert len(bins) <= best_fit_decreasing(lengths, capacity)


@pytest.mark.parametrize("capacity", [2048, 64])
def test_pack_documents(spark, capacity):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(3)
    check(docs, packing.pack(docs, capacity=capacity), capacity)


def test_odd_input(spark):
    docs = odd_documents(spark)
    check(docs, packing.pack(docs), 2048)
    assert packing.pack(empty_documents(spark)).collect() == []


def test_sequences_hold_the_tokens(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    packed = packing.pack(docs, capacity=256, with_ids=True)
    seqs = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert seqs[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]] == r["ids"]


def test_fast_engine_gives_the_same_ids():
    encode, hf = tokens.load(), engine()
    rng = random.Random(1)
    alphabet = "abcXYZ  \n\t'.,!?|<>019éßñ日本🙂 \x1c"
    for _ in range(500):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80)))
        assert encode(text).tolist() == hf.encode(text, add_special_tokens=False).ids


def test_other_files_run_in_their_own_library():
    path = str(public_tokenizers.path("word_bpe_49k.json"))
    text = "Some words, and 12 more."
    assert tokens.load(path)(text).tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
