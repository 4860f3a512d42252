import random

import pytest
from pyspark.sql import functions as F

from campaignlake.llm import queries, token_counts, tokens

from .util import SF, empty_documents, odd_documents


@pytest.fixture(scope="module")
def count():
    return token_counts.counter(None)


def plain_edit(text, start, stop, new):
    start = min(max(start, 0), len(text))
    stop = min(max(stop, start), len(text))
    return text[:start] + new + text[stop:]


@pytest.mark.parametrize("seed", range(30))
def test_counts_follow_edits(count, seed):
    rng = random.Random(seed)
    alphabet = "ab cd\n\n  \tEF.,'s 123 éß 日本 \x1c\x85 　🙂|"
    text = "".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 5, 400, 3000])))
    tree = token_counts.TokenTree.build(text, count, rng.choice([1, 7, 64]))
    assert "".join(tree.leaves) == text and tree.tokens[1] == count(text)
    for _ in range(25):
        a = rng.randint(-2, len(text) + 3)
        b = a + rng.choice([0, 0, 1, 5, 60, len(text)])
        new = "".join(rng.choice(alphabet) for _ in range(rng.choice([0, 0, 1, 3, 90])))
        text = plain_edit(text, a, b, new)
        tree.edit(a, b, new, count)
        assert tree.text() == text
        assert (tree.chars[1], tree.tokens[1]) == (len(text), count(text))
        for i in range(1, tree.width):
            assert tree.tokens[i] == tree.tokens[2 * i] + tree.tokens[2 * i + 1]
        tree = token_counts.TokenTree.restore(text, tree.chars, tree.tokens)


def test_a_small_edit_encodes_little(count):
    text = "some words in a sentence. " * 4000
    tree = token_counts.TokenTree.build(text, count, 256)
    tree.edit(50_000, 50_005, "others", count)
    assert tree.encoded_chars < 1200 and tree.tokens[1] == count(tree.text())


def test_query_equals_encoding_again(spark, count):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {}
    for r in docs.withColumn("e", queries.derived_edits(F.col("doc_id"), F.col("text"))).collect():
        text = r["text"]
        for e in r["e"]:
            text = plain_edit(text, e["start"], e["stop"], e["replacement"])
        want[r["doc_id"]] = (count(r["text"]), count(text))
    got = queries.op3_token_counts(spark, SF).collect()
    assert {r["doc_id"]: (r["n_tokens_before"], r["n_tokens"]) for r in got} == want
    assert sum(r["encoded_segments"] for r in got) < sum(r["n_segments"] for r in got)


def test_odd_input(spark, count):
    docs = odd_documents(spark).withColumn("edits", F.expr(
        "case when doc_id = 5 then array(named_struct('start', null, 'stop', 3, 'replacement', null), null) "
        "when doc_id = 8 then array(named_struct('start', 100, 'stop', 1, 'replacement', ' cut ')) end"))
    got = token_counts.apply_edits(token_counts.build_trees(docs, carry=("edits",))).collect()
    assert len(got) == docs.count()
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by[1]["n_tokens"] == by[2]["n_tokens"] == 0
    assert by[5]["text"] == " two three four" and by[5]["n_tokens"] == count(by[5]["text"])
    assert by[8]["n_tokens"] == count("x" * 100 + " cut " + "x" * 49_900)
    assert token_counts.build_trees(empty_documents(spark)).collect() == []


def test_no_documents_and_no_edits(spark, count):
    kind = "array<struct<start: long, stop: long, replacement: string>>"
    none = empty_documents(spark).selectExpr("*", f"cast(null as {kind}) as edits")
    out = token_counts.apply_edits(token_counts.build_trees(none, carry=("edits",)))
    assert out.collect() == [] and {"doc_id", "n_tokens", "n_tokens_before"} <= set(out.columns)
    docs = spark.createDataFrame([(1, "some words here"), (2, None), (3, "")], "doc_id long, text string")
    for edits in (f"cast(null as {kind})", f"cast(array() as {kind})"):
        rows = token_counts.apply_edits(token_counts.build_trees(docs.selectExpr("*", f"{edits} as edits"),
                                                                 carry=("edits",))).collect()
        assert {(r["doc_id"], r["n_tokens_before"], r["n_tokens"]) for r in rows} == {
            (i, n, n) for i, n in ((1, count("some words here")), (2, 0), (3, 0))}
        assert all(r["encoded_segments"] == 0 for r in rows)
