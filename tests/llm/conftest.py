import pytest

LONG = "long words in a row and again " * 4000
WORDS = "the quick brown fox jumps over a lazy dog near the river bank at dawn"

#: Null ids and texts, empty and blank texts, a very long one, copies, repeated rows, a repeated id.
ODD = [
    (None, WORDS), (None, None), (1, None), (2, ""), (3, " \t\n"), (4, WORDS), (5, WORDS), (5, WORDS),
    (6, LONG), (7, "a"), (7, "b and c"), (8, "ÀÉ ß İ ﬁ ² 😀 <|endoftext|> x"), (-9, WORDS + " today"),
]


def odd_schema(text="text"):
    names = "shard bigint, fp bigint, component_id string, score string, n_tokens string, slot string"
    return f"doc_id bigint, {text} string, lang string, source string, n_chars bigint, {names}"


@pytest.fixture(scope="session")
def odd(spark):
    """A documents table of awkward rows, with columns named like the operators' results."""
    rows = [(i, t, None, "s", None, 1, 2, "c", "d", "e", "f") for i, t in ODD]
    return spark.createDataFrame(rows, odd_schema()).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], odd_schema())


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").cache()
