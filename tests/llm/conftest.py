from __future__ import annotations

import pytest

# Rows that every text operator must take: null and empty texts, no letters, a long text, repeated
# rows, a null id, and columns named like those that operators add.
AWKWARD = [
    (1, None, "en", 7),
    (2, "", "en", 7),
    (3, " \n\t ", "fr", 7),
    (4, "12345 !!! ...", None, 7),
    (5, "The quick brown fox jumps over the lazy dog and runs far away. " * 3000, "en", 7),
    (6, "The quick brown fox jumps over the lazy dog.", "en", 7),
    (6, "The quick brown fox jumps over the lazy dog.", "en", 7),
    (None, "el perro corre por la calle con los otros perros", "es", 7),
    (7, "日本語のテキスト und Wörter 😀", "de", 7),
    (8, "x" * 5000, None, 7),
]
CLASHES = ("n_words", "score", "labels", "ids", "kept", "spans", "label", "id", "n", "hash")


@pytest.fixture(scope="session")
def awkward(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(AWKWARD, "doc_id long, text string, lang string, n_chars long")
    return docs.withColumns({c: F.lit("taken") for c in CLASHES})


@pytest.fixture(scope="session")
def no_docs(awkward):
    return awkward.limit(0)


@pytest.fixture(scope="session")
def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}
