from __future__ import annotations

import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977}" for i in range(60_000))
#: NULLs in every column, empty, blank and very long texts, repeated rows and ids, odd characters.
ROWS = [
    (None, None, None, None, None),
    (None, "a text without an id", "en", "a", 20),
    (1, "", "en", "a", 0),
    (2, None, "en", None, None),
    (3, "one two three four five", "en", "a", 23),
    (3, "one two three four five", "en", "a", 23),
    (3, "another text of the same id", None, "b", 27),
    (4, LONG, "en", "b", len(LONG)),
    (5, " \n\t\r\x0b\x0c ", "de", "", 7),
    (6, "größe 漢字 😀 e\u0301 \u00a0x \x00y <|endoftext|>", "de", "b", 10),
    (7, "x" * 50_000, "fr", "c", 50_000),
]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(ROWS, DOCUMENT)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENT)


@pytest.fixture
def clashing(spark, edge):
    """The same rows with columns of names that operators use themselves."""

    def with_columns(*names):
        df = edge
        for name in names:
            df = df.withColumn(name, df["n_chars"])
        return df

    return with_columns


@pytest.fixture(scope="session")
def tables(spark):
    return lambda name, sf="sf0.001": spark.read.parquet(f"/root/testdata/{sf}/{name}.parquet")
