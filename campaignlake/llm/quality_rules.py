"""Line-first quality rules.

Every line of a text is judged on its own by three groups of rules; failing
lines are removed, and a document that loses too much of its text is rejected.

* punctuation: the line shouts (a fifth of its words or more carry a doubled
  ``!`` or ``?``), is strewn with symbols (a fifth of its words or more carry
  one of ``# * $ % & | < >``), or has five words or more and no sentence
  punctuation at all.  Wrapped prose is judged by the paragraph: where three
  lines or more follow each other, each but the last so long that the next line's
  first word would not have fitted in, a line without punctuation may stay if the
  paragraph has a mark for every 40 words;
* navigation: the line is a menu: two separators or more standing as words of
  their own, making up a fifth of its words or more;
* boilerplate: the line holds a stock phrase of web pages.

Base figures of the whole text (word count, symbols, duplicate lines, repeated
three-word windows) are computed beside it; a text below the base limits is
rejected whatever its lines look like.

Defined results: a null text counts as having no words; a text without words
is rejected by the base limits; a repeated row is judged like the first;
columns of the input are never read but the text, so clashing names do no harm.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_TEXT, fresh, map_arrow

# Stock phrases of web pages, lower case.
BOILERPLATE = (
    "all rights reserved",
    "accept cookies",
    "click here",
    "cookie policy",
    "enable javascript",
    "lorem ipsum",
    "privacy policy",
    "sign up for our newsletter",
    "skip to content",
    "subscribe to our",
    "terms of service",
    "terms of use",
)

SYMBOLS = r"[#*$%&|<>]"
SEPARATORS = r"(?:\||»|«|›|‹|•|·|>|>>|/)"
# Sentence marks by script: Latin, Greek and Cyrillic; Chinese and Japanese; Arabic and Urdu; Indic dandas; Armenian;
# Ethiopic; Myanmar and Khmer; Tibetan; Mongolian.
SENTENCE_MARKS = r"[.,;:!?…\u037E。、！？．，；：｡､،؛؟۔।॥։՞՝።፣፤፥፧၊။។៕།༎᠂᠃]"


@dataclass(frozen=True)
class Limits:
    min_words: int = 50
    max_repeat_percent: int = 50     # words in repeated three-word windows
    max_shout_percent: int = 20      # of a line's words
    max_symbol_percent: int = 20     # of a line's words
    max_separator_percent: int = 20  # of a line's words, from two separators on
    unpunctuated_words: int = 5      # a line this long needs a sentence mark
    wrapped_lines: int = 3           # a wrapped paragraph has so many lines at least
    words_a_mark: int = 40           # and at least one sentence mark for so many words
    max_removed_percent: int = 30    # of a text's characters in words


SPACE = " \t\n\v\f\r"
SYMBOL_RE = re.compile(SYMBOLS)
SHOUT_RE = re.compile(r"!!|\?\?")
SEPARATOR_RE = re.compile(SEPARATORS + r"\Z")
MARK_RE = re.compile(SENTENCE_MARKS)
BOILERPLATE_RE = re.compile("|".join(re.escape(x) for x in BOILERPLATE))


def unmarked(line: str, words: list[str], limits: Limits) -> bool:
    return len(words) >= limits.unpunctuated_words and not MARK_RE.search(line)


def wrapped_prose(paragraph: list[tuple[str, list[str]]], limits: Limits) -> bool:
    """Whether lines that follow each other are punctuated prose, wrapped at a width."""
    if len(paragraph) < limits.wrapped_lines:
        return False
    sizes = [len(line.strip(SPACE)) for line, _ in paragraph]
    width = max(sizes)
    if any(size + 1 + len(words[0]) <= width for size, (_, words) in zip(sizes, paragraph[1:])):
        return False
    marks = sum(len(MARK_RE.findall(line)) for line, _ in paragraph)
    return marks * limits.words_a_mark >= sum(len(words) for _, words in paragraph)


def line_fails(line: str, words: list[str], limits: Limits, in_prose: bool = False) -> bool:
    n = len(words)
    if ("!!" in line or "??" in line) and (
            100 * sum(1 for w in words if SHOUT_RE.search(w)) >= limits.max_shout_percent * n):
        return True
    if SYMBOL_RE.search(line) and (
            100 * sum(1 for w in words if SYMBOL_RE.search(w)) >= limits.max_symbol_percent * n):
        return True
    if not in_prose and unmarked(line, words, limits):
        return True
    separators = sum(1 for w in words if len(w) <= 2 and SEPARATOR_RE.match(w))
    if separators >= 2 and 100 * separators >= limits.max_separator_percent * n:
        return True
    return BOILERPLATE_RE.search(line.lower()) is not None


def clean_lines(text: str, limits: Limits) -> tuple[str, int, int, int]:
    """Kept lines, word characters of all lines and of failing ones, duplicate lines."""
    kept, chars, lost, seen, duplicates = [], 0, 0, set(), 0
    lines = [(line, WORD_TEXT.findall(line)) for line in text.split("\n")]
    prose, stop = False, 0  # of the paragraph that ends at ``stop``
    for at, (line, words) in enumerate(lines):
        if not words:
            kept.append(line)
            continue
        if at >= stop:
            stop = next((i for i in range(at, len(lines)) if not lines[i][1]), len(lines))
            part = lines[at:stop]
            prose = any(unmarked(*x, limits) for x in part) and wrapped_prose(part, limits)
        if line in seen:
            duplicates += 1
        else:
            seen.add(line)
        size = sum(map(len, words))
        chars += size
        if line_fails(line, words, limits, prose):
            lost += size
        else:
            kept.append(line)
    return "\n".join(kept), chars, lost, duplicates


def repeated_words(words: list[str]) -> int:
    """Words inside three-word windows that occur twice or more, the first included."""
    if len(words) < 3:
        return 0
    vocabulary: dict[str, int] = {}
    number = vocabulary.setdefault
    codes = np.array([number(w, len(vocabulary)) for w in words], np.int64)
    # Windows as numbers: the pair's number and the third word's, which also holds for very long texts.
    pairs = np.unique(codes[:-1] * len(vocabulary) + codes[1:], return_inverse=True)[1]
    _, window, times = np.unique(pairs[:-1] * len(vocabulary) + codes[2:], return_inverse=True, return_counts=True)
    often = times[window] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift:shift + len(often)] |= often
    return int(covered.sum())


def judge(text: str | None, limits: Limits) -> dict:
    text = text or ""
    words = WORD_TEXT.findall(text)
    cleaned, chars, lost, duplicates = clean_lines(text, limits)
    n, repeats = len(words), repeated_words(words)
    base_failed = n < limits.min_words or 100 * repeats > limits.max_repeat_percent * n
    return {
        "n_words": n, "word_chars": chars, "n_symbols": len(SYMBOL_RE.findall(text)),
        "n_dup_lines": duplicates, "n_repeat_words": repeats, "removed_chars": lost,
        "base_failed": base_failed,
        "kept": not base_failed and 100 * lost <= limits.max_removed_percent * chars,
        "cleaned": cleaned,
    }


FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "removed_chars",
           "base_failed", "kept")
SCHEMA = (", ".join(f"{c} long" for c in FIGURES[:6]) + ", base_failed boolean, kept boolean")


def evaluate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             limits: Limits = Limits(), with_text: bool = False) -> DataFrame:
    """One row per document: its id, the figures and the verdict; ``cleaned`` on request."""
    names = FIGURES + (("cleaned",) if with_text else ())

    def run(batches):
        for batch in batches:
            rows = [judge(t, limits) for t in batch.column(1).to_pylist()]
            columns = [pa.array([r[c] for r in rows],
                                pa.string() if c == "cleaned" else
                                pa.bool_() if c in ("base_failed", "kept") else pa.int64())
                       for c in names]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", *names])

    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = dict(slim.dtypes)["id"]
    out = map_arrow(slim, run, f"id {kind}, {SCHEMA}" + ", cleaned string" * with_text)
    return out.withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, text_col: str = "text", limits: Limits = Limits(),
              clean: bool = True) -> DataFrame:
    """The documents that pass, with failing lines taken out of the text if ``clean``.

    All columns come back in their order; ``n_chars``, where present, follows
    the cleaned text.
    """
    kind = pa.struct([("kept", pa.bool_()), ("text", pa.string())])

    @F.arrow_udf("struct<kept: boolean, text: string>")
    def verdict(texts: pa.Array) -> pa.Array:
        rows = [judge(t, limits) for t in texts.to_pylist()]
        return pa.array([{"kept": r["kept"], "text": r["cleaned"]} for r in rows], kind)

    mark = fresh(docs, "verdict")
    out = docs.withColumn(mark, verdict.asNondeterministic()(F.col(f"`{text_col}`").cast("string")))
    out = out.where(F.col(f"{mark}.kept"))
    if clean:
        out = out.withColumn(text_col, F.col(f"{mark}.text"))
        if "n_chars" in docs.columns:
            kind_of = dict(docs.dtypes)["n_chars"]
            out = out.withColumn("n_chars", F.length(F.col(f"`{text_col}`")).cast(kind_of))
    return out.select([F.col(f"`{c}`") for c in docs.columns])
