"""Shared fixtures: documents with every odd case, and the small given tables."""

import pytest
from odd_cases import SCHEMA, SF, prose

@pytest.fixture(scope="session")
def odd_rows():
    """Null and empty values, very long texts, ties, repeated rows."""
    long_text = prose(3, 20000)
    rows = [(1, None, "en"), (2, "", "en"), (3, "   \n\t ", None), (4, "12345 67890", "fr"), (5, "one", "en"),
            (6, "a b", "de"), (7, prose(1, 60), "en"), (7, prose(1, 60), "en"), (8, prose(1, 60), None),
            (9, long_text, "en"), (10, long_text + " tail", "en"), (11, "x" * 50000, "en"), (None, prose(2, 30), "fr"),
            (12, "Grüße aus Köln, <|endoftext|> 東京", "de"), (13, prose(4, 80) + " " + prose(1, 60), "en")]
    return [(i, t, g, "s", len(t or ""), "c", 5, 6) for i, t, g in rows]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The odd rows, with columns named like ones the operators make."""
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small_documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
