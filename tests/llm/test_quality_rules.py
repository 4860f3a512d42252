import pytest

from campaignlake.llm import quality_rules as qr

from .util import WORD, empty_documents, odd_documents

PROSE = "The quick brown fox jumps over it, again and again."


def plain_repeats(words):
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    return len({j for i, w in enumerate(windows) if windows.count(w) > 1 for j in (i, i + 1, i + 2)})


@pytest.mark.parametrize("line, fails", [
    (PROSE, False), ("Short heading", False), ("Home | Products | About | Contact", True),
    ("BUY!! NOW!! CHEAP!!", True), ("Good news!! the rest of this line is calm, long and ordinary.", False),
    ("word### other$$$ more%%% and&&& so*** on", True), ("a line of words without any mark", True),
    ("Please accept cookies to go on reading.", True), ("Costs rose 5 % in May, and 3 % in June, said the minister.", False),
    ("Either | or, she said, was all there is to choose from here.", False),
])
def test_line_rules(line, fails):
    assert qr.line_fails(line, WORD.findall(line), qr.Limits()) is fails


@pytest.mark.parametrize("width", [40, 72])
def test_wrapped_prose_is_judged_by_the_paragraph(width):
    import textwrap

    text = ("It was the sort of morning on which nobody who lived beside the harbour expected anything to happen at all, "
            "and yet the old ferry had come in early and people stood about on the quay. ") * 4
    for lines in (textwrap.wrap(text, width), [f"  {x}\r" for x in textwrap.wrap(text, width)]):
        whole = "\n".join([*lines, "", *lines])
        assert qr.clean_lines(whole, qr.Limits())[2] == 0
    # Without marks it is no prose, and lines of any length are not wrapped.
    assert qr.clean_lines("\n".join(textwrap.wrap(text.replace(",", "").replace(".", ""), width)), qr.Limits())[2] > 0
    menu = "one two three four five\nsix seven eight nine ten eleven twelve thirteen\na b c d e\n" + PROSE
    assert qr.clean_lines(menu, qr.Limits())[0] == PROSE


@pytest.mark.parametrize("mark", "। ॥ ؟ ۔ ։ ። ။ ។ ། 。 ｡".split())
def test_sentence_marks_of_all_scripts(mark):
    line = "word " * 8 + mark
    assert not qr.line_fails(line, WORD.findall(line), qr.Limits())


def test_repeats():
    for text in ("a b c a b c", "a a a a a", "a b c d", "", "x y z x y z x y z w", "a b a b a b q a b a"):
        assert qr.repeated_words(text.split()) == plain_repeats(text.split())


def test_figures_and_verdict():
    text = "\n".join([PROSE, PROSE, "", "Home | About | Contact", "Ünï 🙂 #1."])
    r = qr.judge(text, qr.Limits(min_words=5, max_repeat_percent=100))
    words = WORD.findall(text)
    assert (r["n_words"], r["word_chars"]) == (len(words), sum(map(len, words)))
    assert (r["n_symbols"], r["n_dup_lines"]) == (3, 1)
    assert r["n_repeat_words"] == plain_repeats(words)
    assert r["kept"] and "Home" not in r["cleaned"] and PROSE in r["cleaned"]
    assert not qr.judge("Home | About | Contact\n" * 9 + PROSE, qr.Limits(5, 100))["kept"]


def test_labelled_junk_is_rejected_and_clean_text_kept(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = qr.evaluate(spark.read.parquet(f"{sf}/documents.parquet")).join(labels, "doc_id").collect()
    assert not any(r["kept"] for r in rows if r["quality"] == 0)
    assert all(r["kept"] or r["base_failed"] for r in rows if r["quality"] == 1)


def test_odd_input(spark):
    docs = odd_documents(spark)
    rows = qr.evaluate(docs).collect()
    assert len(rows) == docs.count()
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by[1]["n_words"] == by[2]["n_words"] == by[3]["n_words"] == 0
    assert all(by[i]["base_failed"] and not by[i]["kept"] for i in (1, 2, 3, 4))
    assert by[8]["word_chars"] == 50_000 and by[9]["word_chars"] == 5
    kept = qr.keep_good(docs, limits=qr.Limits(min_words=2))
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} >= {5}
    assert qr.evaluate(empty_documents(spark)).collect() == []
    assert qr.keep_good(empty_documents(spark)).collect() == []


def test_cleaning_takes_effect(spark):
    prose = [" ".join(f"w{i}{j}" for j in range(10)) + ", so." for i in range(9)]
    text = "\n".join([*prose, "Home | About | Contact"])
    docs = spark.createDataFrame([(1, text, len(text))], "doc_id long, text string, n_chars long")
    r = qr.keep_good(docs).first()
    assert "Home" not in r["text"] and r["n_chars"] == len(r["text"])
    assert qr.keep_good(docs, clean=False).first()["text"] == text
