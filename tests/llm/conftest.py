import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, words string, digest string"


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, columns whose names clash."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    rows = [
        (1, None, "en", "a", None, "k", None, "x"),
        (2, "", None, "a", 0, None, "w", None),
        (3, "one", "en", None, 3, "k", "w", "x"),
        (3, "one", "en", None, 3, "k", "w", "x"),
        (4, " \t\n ", "en", "b", 4, "k", "w", "x"),
        (5, "Two words", "de", "b", 9, "k", "w", "x"),
        (6, "one", "en", "b", 3, "k", "w", "x"),
        (None, "one two three four five six", "en", "b", 3, "k", "w", "x"),
        (7, long, "en", "c", len(long), "k", "w", "x"),
        (8, long, "en", "c", len(long), "k", "w", "x"),
        (9, "Licensed under the MIT License. İK ▁ é\U0001f600 " + "a b c d e f g h " * 9, "fr", "c", 1, "k", "w", "x"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
