from __future__ import annotations

import pytest

#: Rows of documents that every operator has to take: nulls, empties, ties, copies, long texts.
AWKWARD = [
    (1, "the cat sat on the mat and then it left", "en", "a", 39),
    (1, "the cat sat on the mat and then it left", "en", "a", 39),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, "   \n\t\n ", "de", None, 6),
    (5, "!!! 123 ???", None, "b", 11),
    (None, "der hund lief durch den wald und kam nicht mehr", "de", "b", 47),
    (None, None, None, None, None),
    (6, "wort " * 20_000, "de", "b", 100_000),
    (7, "x" * 30_000, "en", "c", 30_000),
    (8, "ça été là, 日本語 😀 ﬁn", "fr", "c", 20),
    (9, "the cat sat on the mat and then it left", "en", "z", 39),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def awkward(spark):
    """Awkward rows, with further columns that have names operators give."""
    df = spark.createDataFrame(AWKWARD, SCHEMA)
    return df.selectExpr("*", "'kept' AS score", "7 AS n_words", "'x' AS hits", "'y' AS samples", "doc_id AS n_lines", "'z' AS licenses")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    """The driver's documents at the smallest scale."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
