import pytest

LONG = "word " * 30_000


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, extra columns with clashing names."""
    rows = [
        (1, "the quick brown fox jumps over the lazy dog", "a", 1, "x"),
        (1, "the quick brown fox jumps over the lazy dog", "a", 1, "x"),
        (2, "", "a", 2, None),
        (3, None, None, 3, "x"),
        (None, "a text without an id", "b", None, "x"),
        (4, LONG, "b", 5, "x"),
        (5, "  \n\t ", "c", 6, "x"),
        (6, "Grüße <|endoftext|> it's 42 \U0001f600 日本語", "c", 7, "x"),
        (7, "the quick brown fox jumps over the lazy dog", None, 8, "x"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_words int, fp string")


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
