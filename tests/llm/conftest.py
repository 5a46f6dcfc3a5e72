import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, shared ids."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog and runs away from it", "en", "a", 10),
        (1, "The quick brown fox jumps over the lazy dog and runs away from it", "en", "a", 10),
        (2, "the QUICK brown fox jumps over the lazy dog and runs away from it", "en", None, 10),
        (3, None, "de", "b", None),
        (4, "", None, "b", 0),
        (5, "Wort", "de", "b", 4),
        (None, "une phrase sans identifiant", "fr", None, 5),
        (6, "\n\n \t", None, None, 4),
        (7, "12 34 !!", "en", "a", 8),
        (8, "long " * 60_000 + "end", "en", "b", 300_003),
        (9, "x" * 150_000, "en", "c", 150_000),
        (5, "Ein anderer Text mit derselben Nummer", "de", "b", 30),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
