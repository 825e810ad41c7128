import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "".join(f"word{i % 977} " for i in range(40_000))

# Nulls in every column, empty and blank texts, a very long text, ties and repeated rows.
EDGES = [
    (1, "one two three four", "en", "a", 18),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, " \t\n ", "en", None, 4),
    (5, "one two three four", "en", "a", 18),
    (5, "one two three four", "en", "a", 18),
    (None, "one two three four", "en", "a", 18),
    (None, None, None, None, None),
    (7, LONG, "en", "b", len(LONG)),
    (7, "another text with the same id", "en", "b", 29),
    (8, "ÉÈ ß 日本語 \U0001f600 é <|endoftext|> don't\x1c\x85x", "fr", "c", 30),
]


@pytest.fixture()
def edges(spark):
    return spark.createDataFrame(EDGES, SCHEMA).repartition(3)


@pytest.fixture()
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture()
def make(spark):
    def docs(rows, schema="doc_id long, text string"):
        return spark.createDataFrame(rows, schema).repartition(3)

    return docs


def clashing(docs, *names):
    """The same documents with extra columns of the given names."""
    from pyspark.sql import functions as F

    return docs.withColumns({name: F.lit("taken") for name in names})


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)
