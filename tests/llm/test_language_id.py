import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from campaignlake.llm import language_id as li
from campaignlake.llm import queries

from .util import crc, empty_documents, odd_documents

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op10_language_id(spark, SF).collect()
    assert {r["doc_id"] for r in rows} == truth.keys()
    assert all(r["held_out"] == (crc(r["doc_id"]) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    held = [r["lang_pred"] == truth[r["doc_id"]] for r in rows if r["held_out"]]
    assert len(held) > 200 and sum(held) / len(held) > 0.98


def test_kernel_is_the_blended_presence_kernel():
    """The product of presence rows is the kernel over sets of n-grams (here without collisions)."""
    a, b = "abc abd", "abd xyz"

    def grams(text, n):
        data = (" " + text + " ").encode()
        return {data[i:i + n] for i in range(len(data) - n + 1)}

    want = sum(len(grams(a, n) & grams(b, n)) / math.sqrt(len(grams(a, n)) * len(grams(b, n)))
               for n in (1, 2, 3, 4)) / 4
    rows = li.presence_matrix([a, b])
    assert rows[0] @ rows[1] == pytest.approx(want, rel=1e-5)
    assert rows[0] @ rows[0] == pytest.approx(1, rel=1e-5)


def plain_ridge(texts, labels, marks, languages, per, settings):
    """Kernel rows, targets and the solution of the ridge problem, written out over sets of n-grams."""
    rows, mark_rows = li.presence_matrix(texts).astype(float), li.presence_matrix(marks).astype(float)
    k_nm, k_mm, n = rows @ mark_rows.T, mark_rows @ mark_rows.T, len(texts)
    w = np.diag([n / len(languages) / per[l] for l in labels])
    y = np.array([[float(l == a) for a in languages] for l in labels])
    left = k_nm.T @ w @ k_nm + settings.ridge * n * k_mm
    left += 1e-8 * np.trace(left) / len(left) * np.eye(len(left))
    return mark_rows, np.linalg.solve(left, k_nm.T @ w @ y)


def test_distributed_fit_scores_like_an_unfolded_ridge(spark):
    """Sums over tasks and weights folded into one matrix against kernel rows times one weight a landmark."""
    settings = li.Settings(per_language=30, landmarks=20)
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 400")
    model = li.fit(docs, settings=settings)
    sample = [(r["lang"], r["text"]) for r in li.training_sample(docs, "text", "lang", settings).collect()]

    def bits(text):
        return np.packbits(li.presence_matrix([text])[0] > 0).tobytes()

    hashed = spark.createDataFrame([(l, t, bits(t)) for l, t in sample], "lang string, text string, bits binary")
    by = {}
    for r in hashed.orderBy("lang", F.xxhash64("bits"), "bits").collect():
        by.setdefault(r["lang"], []).append(r["text"])
    by = {l: ts[:30] for l, ts in by.items()}
    languages, per = tuple(sorted(by)), {l: len(ts) for l, ts in by.items()}
    given = li.chosen_landmarks(languages, per, settings)
    assert sum(given.values()) == 8 * len(languages) and model.languages == languages
    texts, labels = zip(*((t, l) for l in languages for t in by[l]))
    marks, alpha = plain_ridge(list(texts), labels, [t for l in languages for t in by[l][:given[l]]], languages, per, settings)
    asked = [r["text"] for r in docs.collect() if li.has_letter(r["text"])][:150]
    plain = (li.presence_matrix(asked) @ marks.T) @ alpha
    names, scores = li.classify(asked, model, 7)
    assert np.allclose(scores, np.clip(plain.max(1), 0, 1), atol=2e-3)
    assert sum(n == languages[j] for n, j in zip(names, plain.argmax(1))) >= len(asked) - 1


def test_equal_scores_go_to_the_first_language():
    model = li.Model(("a", "b"), np.ones((li.WIDTH, 2), np.float32))
    assert li.classify(["text", None, "² ½ 10", "①", "\u0301"], model, 2)[0] == ["a"] + ["und"] * 4


def test_the_least_score_follows_from_the_number_of_languages(spark):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    weights = np.zeros((li.WIDTH, 20), np.float32)
    row = li.presence_matrix(["some text"])[0]
    weights[:, 3] = 0.1 * row / (row @ row)
    assert li.keep_identified(docs, li.Model(tuple("abcdefghijklmnopqrst"), weights)).count() == 1
    assert li.keep_identified(docs, li.Model(tuple("abcd"), weights[:, :4])).count() == 0


def test_odd_input(spark):
    docs = odd_documents(spark)
    model = li.fit(docs)
    assert model.languages == ("de", "en", "fr")
    rows = li.predict(docs, model).collect()
    assert len(rows) == docs.count()
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert all((by[i]["lang_pred"], by[i]["score"]) == ("und", 0.0) for i in (1, 2, 3))
    assert by[9]["lang_pred"] == "de"
    kept = li.keep_identified(docs, model)
    assert kept.columns == docs.columns and not {1, 2, 3} & {r["doc_id"] for r in kept.collect()}


def test_nothing_to_learn_from(spark):
    empty = empty_documents(spark)
    assert li.fit(empty) is None
    assert li.predict(empty, None).collect() == []
    docs = odd_documents(spark).withColumn("lang", F.lit(None).cast("string"))
    kept = li.keep_identified(docs, None)
    assert kept.columns == docs.columns and kept.count() == docs.where("text rlike '[a-zA-Zä]'").count()
    assert {r["lang_pred"] for r in li.predict(docs, li.fit(docs)).collect()} == {"und"}


def test_a_text_with_very_many_copies_counts_once(spark):
    docs = spark.range(5000).selectExpr("if(id < 4000, 'the same text', concat('words ', id)) as text", "'en' as lang")
    for seed_text in ("the same text", "another"):
        copies = docs.selectExpr(f"if(text = 'the same text', '{seed_text}', text) as text", "lang")
        sample = li.training_sample(copies, "text", "lang", li.Settings(per_language=100))
        assert sample.count() < 200


@pytest.mark.parametrize("copies, text", [(60_000, "'the same text'"), (60_000, "''"), (60_000, "concat('12 ', id)"), (0, "''")])
@pytest.mark.parametrize("distinct", [60, 150, 3000])
def test_copies_and_texts_without_a_letter_do_not_shrink_the_sample(spark, copies, text, distinct):
    def words(n):
        """A number in letters, so that each text has n-grams of its own."""
        return f"translate(conv({n}, 10, 10), '0123456789', 'abcdefghij')"

    docs = spark.range(copies).selectExpr(f"{text} as text", "'en' as lang").union(
        spark.range(distinct).selectExpr(f"concat('words ', {words('id')}) as text", "'en' as lang")).union(
        spark.range(20).selectExpr(f"concat('mots ', {words('id')}) as text", "'fr' as lang"))
    settings = li.Settings(per_language=100)
    got = {r["lang"]: r["count"] for r in li.training_sample(docs, "text", "lang", settings).groupBy("lang").count().collect()}
    extra = int(copies > 0 and "same" in text)
    assert got["fr"] == 20 and min(100, distinct + extra) <= got["en"] <= min(distinct + extra, 160)
    assert li.fit(docs, settings=settings).languages == ("en", "fr")


def test_letters_in_spark_are_letters_in_python(spark):
    rows = spark.createDataFrame([(c,) for c in ["a", "ä", "中", "ª", "²", "½", "Ⅷ", "٣", "7", "_", "-", "🙂", "\u0301", ""]], "c string")
    for r in rows.select("c", F.col("c").rlike(li.HAS_LETTER).alias("has")).collect():
        assert r["has"] == li.has_letter(r["c"]), r["c"]


def test_too_many_labels_raise(spark):
    docs = spark.range(20).selectExpr("'text' as text", "cast(id as string) as lang")
    with pytest.raises(ValueError):
        li.fit(docs, settings=li.Settings(max_languages=5))
