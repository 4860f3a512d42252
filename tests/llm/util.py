"""Fixtures and brute-force helpers for the operators of the llm subpackage."""

import random
import re
import zlib

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def crc(value) -> int:
    return zlib.crc32(str(value).encode())


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def odd_documents(spark, extra: bool = True):
    """Nulls, empty and very long texts, repeated rows, and columns with clashing names."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    rows = [
        (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, "   \n\t ", None, "b", 5),
        (4, "one", "en", None, 3), (5, "One two three four", "fr", "b", 18),
        (6, long, "en", "c", len(long)), (7, long, "en", "c", len(long)), (7, long, "en", "c", len(long)),
        (8, "x" * 50_000, None, "c", 50_000), (9, "ä ö ü 🙂 ñ", "de", "d", 9), (None, "no id here", "en", "d", 10),
        (None, None, None, None, None), (10, " a b\x1cc", "en", "e", 6),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        for name in ("kept", "fp", "row", "id", "n_words", "score", "piece", "__verdict", "length"):
            df = df.selectExpr("*", f"'clash' as `{name}`")
    return df


def empty_documents(spark):
    return spark.createDataFrame([], SCHEMA)
