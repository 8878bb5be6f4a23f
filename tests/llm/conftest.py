import duckdb
import pytest

FOLDER = "/root/testdata/sf0.001"

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_words string, `__new` int, node string"

#: Nulls, empty and blank texts, ties, repeated rows, and columns named as those the operators make.
EDGES = [
    (1, None, None, None, None, "x", 1, "y"),
    (2, "", "en", "a", 0, "x", 1, "y"),
    (3, " \n\t ", "en", "a", 4, "x", None, "y"),
    (4, "one two three four five six seven", "en", "a", 33, None, 1, None),
    (4, "one two three four five six seven", "en", "a", 33, None, 1, None),
    (5, "one two three four five six seven", "en", "b", 33, "x", 1, "y"),
    (None, "a text without an id", "en", "b", 20, "x", 1, "y"),
    (6, "short", None, "b", 5, "x", 1, "y"),
    (7, "wörter " * 40, "de", None, 280, "x", 1, "y"),
    (8, "x" * 50_000, "en", "a", 50_000, "x", 1, "y"),
]


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(EDGES, DOCS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def documents():
    """(doc_id, text) of the smallest table, by another reader."""
    return duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.fixture(scope="session")
def made(spark):
    """Documents of (doc_id, text)."""

    def build(rows):
        return spark.createDataFrame(rows, "doc_id long, text string")

    return build
