import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Rows of (doc_id, text[, source]) as documents."""

    def make(*rows):
        return spark.createDataFrame([(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows], DOCS)

    return make


@pytest.fixture
def clashing(docs):
    """Odd rows: nulls, empty and long texts, repeats, and columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
    df = docs((1, None), (2, ""), (3, " \t\n "), (4, long, None), (5, "one"), (5, "one"), (None, "no id here at all"), (None, None, None), (6, "Ünï cödé 日本語 \U0001f600 text with more words"))
    for name in ("size", "n", "target", "copies", "length", "tie", "rate", "of", "source_size", "node", "component", "h", "v", "place", "bucket", "n_words", "kept", "score", "parts", "row", "start", "pii_kinds", "at", "x", "mix", "mix_", "exceptions", "digest", "listed", "__mix", "__copy", "__key", "__row", "__gone", "__own", "__digest", "__exceptions", "__id", "w", "number", "license", "lists", "kind", "role"):
        df = df.withColumn(name, F.lit(name))
    return df


@pytest.fixture
def none(docs):
    return docs().limit(0)
