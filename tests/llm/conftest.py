from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use themselves.
CLASHING = ["simhash", "shard", "size", "hash", "row", "digest", "text_id", "segments", "ranges", "copies", "threshold", "sequence_id", "_id", "_text", "n_words"]


@pytest.fixture(scope="session")
def corpus(spark):
    """Nulls in every column, empty and long texts, repeated rows, equal texts, and clashing columns."""
    from pyspark.sql import functions as F

    long_text = " ".join(f"word{i % 977}" for i in range(60_000))
    passage = "".join(chr(97 + (i * i * 7 + i) % 26) for i in range(600))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog and runs away from it all day.", "en", "a", 74),
        (2, "The quick brown fox jumps over the lazy dog and runs away from it all day.", "en", "b", 74),
        (2, "The quick brown fox jumps over the lazy dog and runs away from it all day.", "en", "b", 74),
        (3, None, "en", "a", None), (4, "", None, None, 0), (5, " \t\n", "fr", "a", 3), (None, "a text without an id, but with words in it", "en", None, 40),
        (None, None, None, None, None), (6, long_text, "en", "a", len(long_text)), (7, "é" * 50 + passage + "ü" * 30, "de", "b", 680),
        (8, "x" + passage + "tail", "de", "a", 605), (9, "Straße ＡＢＣ", "de", "c", 10), (10, "strasse abc", "de", "c", 11), (11, "123 456", "fr", "c", 7),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.select("*", *(F.lit(k).alias(c) for k, c in enumerate(CLASHING)))


@pytest.fixture(scope="session")
def no_rows(spark):
    return spark.createDataFrame([], SCHEMA)
