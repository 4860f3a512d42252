"""Language identification with a string kernel.

The kernel is a blended-spectrum presence kernel: a text stands for the sets of
its byte n-grams of one to four bytes (lower case, everything but letters read
as a space, n-grams of each order hashed into a fixed number of buckets), and

    k(x, y) = mean over orders of |G(x) & G(y)| / sqrt(|G(x)| |G(y)|).

A bounded, stratified sample of labelled rows is fitted: some of its texts are
Nyström landmarks, and kernel ridge regression, one language against the rest,
gives a weight per landmark and language (targets 0 and 1).  Tasks add up the
normal equations, matrices of landmarks by landmarks and by languages, and only
those and the landmarks' bits reach the driver.
Scoring is distributed and runs in batches: a batch's presence matrix P (one
row per text, each order scaled by 1/sqrt(|G(x)|)) times the landmarks'
presence matrix gives the batch's kernel rows, those times the weights the
scores.  The product of the two right-hand matrices is the same for all batches,
so it is formed once and P is multiplied by it.

Whole texts are read; only the training sample is bounded (``per_language``
distinct texts with a letter a language, or all it has, chosen by a hash of the text).

Defined results: null texts and texts without a letter give ``und`` with score
0, as does everything when no labelled row exists.  Labelled rows without a
letter are not learned from.  Ties go to the language that sorts first.  A null
id is never learned from and never held out.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, fresh, map_arrow

UNDETERMINED = "und"
# A letter, to Python and in Spark's expressions (no numerals like Ⅷ or ②, no marks).
HAS_LETTER = r"\p{L}"
LETTER = regex.compile(HAS_LETTER)
# Buckets per n-gram order 1, 2, 3 and 4 (powers of two).
BUCKETS = (1 << 8, 1 << 12, 1 << 14, 1 << 14)
WIDTH = sum(BUCKETS)
# Letters of any script stay (bytes from 0x80 are parts of them), the rest is a space.
LETTERS_ONLY = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
# Slots of the training sample: so many to a halving of the hash range, over 64 halvings.
OCTAVE = 8
SLOTS = 64 * OCTAVE + 1
SUMS = 8  # partial sums of the normal equations
MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], dtype=np.uint32)


@dataclass(frozen=True)
class Settings:
    per_language: int = 400   # bound of the training sample, texts a language
    landmarks: int = 256
    landmarks_a_language: int = 8  # at least so many, should there be many languages
    ridge: float = 1e-3
    max_languages: int = 256  # bound on distinct labels; beyond it fitting raises
    batch: int = 64           # texts per matrix product


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    weights: np.ndarray       # WIDTH x languages


def has_letter(text: str | None) -> bool:
    return text is not None and LETTER.search(text) is not None


def presence(text: str, row: np.ndarray) -> None:
    """Fill ``row`` (zeros, WIDTH) with the scaled presence vector of a text."""
    data = np.frombuffer((" " + text.lower() + " ").encode("utf-8", "replace").translate(LETTERS_ONLY),
                         np.uint8).astype(np.uint32)
    start, code = 0, np.zeros(len(data), np.uint32)
    for order, buckets in enumerate(BUCKETS):
        if order == 0:
            code = data
            slots = data
        else:
            # One byte more than the n-gram of the order below.
            code = code[:-1] * MULTIPLIERS[order - 1] + data[order:] * np.uint32(2654435769)
            code ^= code >> np.uint32(15)
            slots = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - buckets.bit_length() + 1)
        part = row[start:start + buckets]
        part[slots] = 1.0
        found = np.count_nonzero(part)
        if found:
            part *= np.float32(1.0 / math.sqrt(found * len(BUCKETS)))
        start += buckets


def presence_matrix(texts: list[str]) -> np.ndarray:
    out = np.zeros((len(texts), WIDTH), np.float32)
    for i, text in enumerate(texts):
        presence(text, out[i])
    return out


def unpacked(bits: list[bytes]) -> np.ndarray:
    """Scaled presence vectors from their packed bits."""
    rows = np.unpackbits(np.array([np.frombuffer(b, np.uint8) for b in bits]), axis=1)[:, :WIDTH].astype(np.float32)
    start = 0
    for buckets in BUCKETS:
        part = rows[:, start:start + buckets]
        part /= np.sqrt(np.maximum(part.sum(1, keepdims=True), 1) * len(BUCKETS))
        start += buckets
    return rows


def equations(features: np.ndarray, labels: list[str], marks: np.ndarray, languages: tuple[str, ...],
              per: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Both sides of the normal equations, summed over some texts; ``per`` says how many texts a language has in all."""
    k_nm = (features @ marks.T).astype(np.float64)
    targets = np.array([[float(a == l) for l in languages] for a in labels])
    # Languages weigh alike, however many texts each of them has.
    share = np.array([1.0 / per[a] for a in labels])[:, None] * sum(per.values()) / len(languages)
    return k_nm.T @ (share * k_nm), k_nm.T @ (share * targets)


def solve(left: np.ndarray, right: np.ndarray, marks: np.ndarray, languages: tuple[str, ...], n: int,
          settings: Settings) -> Model:
    """Nyström kernel ridge regression from its normal equations over ``n`` texts."""
    k_mm = (marks @ marks.T).astype(np.float64)
    left = left + settings.ridge * n * k_mm
    left += 1e-8 * np.trace(left) / len(left) * np.eye(len(left))
    alpha = np.linalg.solve(left, right)
    return Model(languages, np.ascontiguousarray(marks.T @ alpha.astype(np.float32)))


def chosen_landmarks(languages: tuple[str, ...], per: dict[str, int], settings: Settings) -> dict[str, int]:
    """How many landmarks each language gives: in turn one each, so that a rare one has its share."""
    want = max(settings.landmarks, settings.landmarks_a_language * len(languages))
    given = dict.fromkeys(languages, 0)
    while want and any(given[l] < per[l] for l in languages):
        for l in languages:
            if want and given[l] < per[l]:
                given[l] += 1
                want -= 1
    return given


def training_sample(labelled: DataFrame, text_col: str, lang_col: str, settings: Settings) -> DataFrame:
    """At least ``per_language`` distinct texts of each language, or all it has, and not many more.

    A text's hash gives its slot; a slot holds about 8 % of the distinct texts in
    it and the slots above.  The slots to pick follow from exact counts of distinct
    texts with a letter, so no language's rows meet in one task and copies of a
    text count once (they combine before they move); the exact bound is set
    afterwards on the few rows left.
    """
    text, lang = F.col(f"`{text_col}`"), F.col(f"`{lang_col}`")
    labelled = labelled.select(text.cast("string").alias("text"), lang.cast("string").alias("lang")).where(
        F.col("text").rlike(HAS_LETTER) & F.col("lang").isNotNull())
    place = F.greatest(F.col("hash") / F.lit(2.0 ** 64) + 0.5, F.lit(2.0 ** -64))
    slot = F.floor(F.log2(place) * F.lit(-float(OCTAVE))).cast("int")
    counts = (labelled.select("lang", F.xxhash64("text", F.lit(11)).alias("hash")).distinct()
              .groupBy("lang", slot.alias("slot")).count()
              .limit(settings.max_languages * SLOTS + 1).collect())
    languages = {r["lang"] for r in counts}
    if len(languages) > settings.max_languages:
        raise ValueError(f"more than {settings.max_languages} distinct labels")
    if not counts:
        return labelled
    # The lowest slot picked of each language.
    lowest, have = dict.fromkeys(languages, 0), dict.fromkeys(languages, 0)
    for r in sorted(counts, key=lambda r: -r["slot"]):
        if have[r["lang"]] < settings.per_language:
            have[r["lang"]] += r["count"]
            lowest[r["lang"]] = r["slot"]
    start = F.create_map([F.lit(x) for pair in sorted(lowest.items()) for x in pair])
    picked = labelled.withColumn("hash", F.xxhash64("text", F.lit(11))).where(slot >= start[F.col("lang")])
    return picked.select("text", "lang").dropDuplicates(["lang", "text"])


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang",
        settings: Settings = Settings()) -> Model | None:
    """A model from labelled rows, or None if there is nothing to learn from."""
    def pack(batches):
        for batch in batches:
            texts, langs = (c.to_pylist() for c in batch.columns)
            rows = [(l, np.packbits(presence_matrix([t])[0] > 0).tobytes())
                    for t, l in zip(texts, langs) if has_letter(t)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()),
                 pa.array([r[1] for r in rows], pa.binary())], ["lang", "bits"])

    sample = map_arrow(training_sample(labelled, text_col, lang_col, settings), pack, "lang string, bits binary")
    # The sample is bounded, a little above the documented size a language; here it is cut to that.
    turn = Window.partitionBy("lang").orderBy(F.xxhash64("bits"), "bits")
    sample = cut(sample.withColumn("turn", F.row_number().over(turn)).where(F.col("turn") <= settings.per_language))
    per = {r["lang"]: r["count"] for r in sample.groupBy("lang").count().orderBy("lang").collect()}
    if not per:
        return None
    languages = tuple(per)
    given = chosen_landmarks(languages, per, settings)
    top = F.create_map([F.lit(x) for pair in given.items() for x in pair])
    marks = unpacked([bytes(r["bits"]) for r in sample.where(F.col("turn") <= top[F.col("lang")])
                      .orderBy("lang", "turn").collect()])

    def add_up(batches):
        left, right = np.zeros((len(marks), len(marks))), np.zeros((len(marks), len(languages)))
        for batch in batches:
            langs, bits = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(langs), 256):
                a, b = equations(unpacked(bits[at:at + 256]), langs[at:at + 256], marks, languages, per)
                left, right = left + a, right + b
        yield pa.RecordBatch.from_arrays([pa.array([left.tobytes()], pa.binary()),
                                          pa.array([right.tobytes()], pa.binary())], ["left", "right"])

    # A few partial sums, whatever number of partitions the sample came from.
    parts = map_arrow(sample.select("lang", "bits").repartition(SUMS), add_up, "left binary, right binary").collect()
    left = sum(np.frombuffer(bytes(r["left"])).reshape(len(marks), -1) for r in parts)
    right = sum(np.frombuffer(bytes(r["right"])).reshape(len(marks), -1) for r in parts)
    return solve(left, right, marks, languages, sum(per.values()), settings)


def classify(texts: list[str | None], model: Model | None, batch: int) -> tuple[list[str], list[float]]:
    names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    if model is None:
        return names, scores
    todo = [i for i, t in enumerate(texts) if has_letter(t)]
    for at in range(0, len(todo), batch):
        part = todo[at:at + batch]
        result = presence_matrix([texts[i] for i in part]) @ model.weights
        best = result.argmax(1)
        for i, j, s in zip(part, best, result.max(1)):
            names[i], scores[i] = model.languages[j], float(min(1.0, max(0.0, s)))
    return names, scores


def predict_column(text: Column, model: Model | None, batch: int = Settings.batch) -> Column:
    """``struct<lang, score>`` of a text column, computed in Arrow batches."""
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("struct<lang: string, score: double>")
    def run(texts: pa.Array) -> pa.Array:
        names, scores = classify(texts.to_pylist(), model, batch)
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(scores, pa.float64())], fields=list(kind))

    return run.asNondeterministic()(text.cast("string"))


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text",
            batch: int = Settings.batch) -> DataFrame:
    """One row per document: the id, ``lang_pred`` and ``score``."""
    def run(batches):
        for b in batches:
            names, scores = classify(b.column(1).to_pylist(), model, batch)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["id", "lang_pred", "score"])

    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = dict(slim.dtypes)["id"]
    return map_arrow(slim, run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def keep_identified(docs: DataFrame, model: Model | None, text_col: str = "text",
                    min_score: float | None = None) -> DataFrame:
    """The documents whose language is determined with at least ``min_score``.

    Scores of languages that are as likely are one over their number; the
    default is that, and at most a quarter.  Without a model there is nothing to
    measure against: then only texts without a letter go.
    """
    if model is None:
        return docs.where(F.col(f"`{text_col}`").cast("string").rlike(HAS_LETTER))
    if min_score is None:
        min_score = 1 / max(4, len(model.languages))
    mark = fresh(docs, "language")
    out = docs.withColumn(mark, predict_column(F.col(f"`{text_col}`"), model))
    out = out.where((F.col(f"{mark}.lang") != UNDETERMINED) & (F.col(f"{mark}.score") >= min_score))
    return out.select([F.col(f"`{c}`") for c in docs.columns])
