import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from campaignlake.llm import lm_scoring as lm
from campaignlake.llm import queries
from campaignlake.llm.common import crc_mod

from .util import SF, WORD, crc, empty_documents, lower, odd_documents


def brute(docs, weights_of=None):
    """Base and model scores with plain counters; ``weights_of``: level -> triple."""
    tokens = [(i, crc(i) % 5 == 1 if i is not None else None, [*WORD.findall(lower(t or "")), ""]) for i, t in docs]
    train = [t for _, held, t in tokens if held is False]
    c1 = Counter(w for t in train for w in t)
    c12 = Counter(p for t in train for p in zip([None, *t], t))
    n, v = sum(c1.values()), len(c1)
    context = Counter(c1)
    context[None] = len(train)
    out = []
    for i, held, t in tokens:
        base = sum(math.log10((c1[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        full = 0.0
        for a, b in zip([None, *t], t):
            w2, w1, w0 = weights_of[int(lm.level(np.array([context[a]]))[0])]
            p = w2 * c12[a, b] / max(context[a], 1) + w1 * c1[b] / max(n, 1) + w0 / (v + 1) if n else 1 / (v + 1)
            full += math.log10(p)
        out.append((i, held is True, len(t), sum(c1[w] > 0 for w in t), n, base, full))
    return out, train, c1, c12, context


def exact_em(train, c1, c12, context, rounds=200):
    """The weights from the deleted tokens themselves, without the ratio grid."""
    n, v = sum(c1.values()), len(c1)
    events = [(int(lm.level(np.array([context[a] - 1]))[0]), (k - 1) / max(context[a] - 1, 1),
               (c1[b] - 1) / max(n - 1, 1), 1 / (v + 1), k) for (a, b), k in c12.items()]
    lev, p, t = (np.array([e[0] for e in events]), np.array([e[1:4] for e in events]),
                 np.array([e[4] for e in events], float))
    w = np.full((lm.LEVELS, 3), 1 / 3)
    w[0] = (0, .5, .5)
    for _ in range(rounds):
        share = w[lev] * p
        share *= (t / share.sum(1))[:, None]
        mass = np.bincount(lev, weights=t, minlength=lm.LEVELS)
        new = np.stack([np.bincount(lev, weights=share[:, k], minlength=lm.LEVELS) for k in range(3)], 1)
        w = np.where(mass[:, None] > 0, new / np.maximum(mass, 1)[:, None], w)
    return w


@pytest.mark.parametrize("block_tokens, range_tokens", [(2_000_000, 4_000_000), (3_000, 7_000)])
def test_scores_equal_brute_force(spark, monkeypatch, block_tokens, range_tokens):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(3)
    learned = {}
    learn = lm.learn_weights
    monkeypatch.setattr(lm, "learn_weights", lambda *a: learned.setdefault("w", learn(*a)))
    got = {r["doc_id"]: tuple(r) for r in lm.score(docs, crc_mod(F.col("doc_id"), 5) == 1,
                                                   block_tokens=block_tokens, range_tokens=range_tokens).collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want, train, *counts = brute(rows, learned["w"])
    assert len(got) == len(want)
    for w in want:
        g = got[w[0]]
        assert g[1:5] == w[1:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)
    # The grid's weights are those of EM on the deleted tokens.
    exact = exact_em(train, *counts)
    seen = np.isfinite(exact).all(1)
    assert np.abs(exact - learned["w"])[seen].max() < 0.02
    # The mixture predicts held-out texts better than the unigram base does.
    held = [g for g in got.values() if g[1]]
    assert sum(g[6] for g in held) > sum(g[5] for g in held)


def test_probabilities_sum_to_one():
    w = lm.learn_weights(np.array([(5 << 24) + ((8 - lm.ZERO) << 12) + (4 - lm.ZERO)]), np.array([10]))
    assert np.allclose(w.sum(1), 1) and (w[:, 2] > 0).all()


def test_odd_input(spark):
    docs = odd_documents(spark)
    got = lm.score(docs, crc_mod(F.col("doc_id"), 5) == 1, block_tokens=1000).collect()
    assert len(got) == docs.count()
    by = {r["doc_id"]: r for r in got}
    assert by[1]["n_tokens"] == by[2]["n_tokens"] == by[3]["n_tokens"] == 1
    assert by[6]["n_tokens"] == 30_001 and by[6]["score"] == by[7]["score"]
    assert all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in got)


def test_empty_and_untrained(spark):
    assert lm.score(empty_documents(spark), crc_mod(F.col("doc_id"), 5) == 1).collect() == []
    docs = odd_documents(spark, extra=False).where("doc_id = 5")
    r = lm.score(docs, F.lit(True)).first()
    assert (r["train_tokens"], r["n_known"], r["base_score"], r["score"]) == (0, 0, 0.0, 0.0)
