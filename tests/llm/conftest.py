import pytest

from featmart.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def rows(docs):
    return [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").orderBy("doc_id").collect()]


SCHEMA = "doc_id long, text string, lang string, source string, keep_id string, spans int, _fl_n int, score string"
LONG = "la mer est belle " * 4000


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns named like results and helpers."""
    data = [
        (1, "one two three four five six seven eight", "en", "b"),
        (2, "one two three four five six seven eight", "en", None),
        (2, "one two three four five six seven eight", "en", None),
        (3, None, None, None),
        (4, "", "en", ""),
        (5, " \t\n ", None, "a"),
        (None, "one two three four five six seven eight", "en", "a"),
        (None, None, "en", "b"),
        (6, LONG, "fr", "a"),
        (7, LONG + "fin", "fr", "a"),
        (8, "12 34 !!", "fr", "\U0001f600"),
        (9, "été à l'école, mail a.b@c.example.org and token = 'abcdef123'", "fr", "c"),
        (10, "x", "en", "c"),
        (10, "y", "en", "c"),
    ]
    return spark.createDataFrame([(*r, "k", 3, 4, "s") for r in data], SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def registered():
    return {q.name: q for q in queries.QUERIES}
