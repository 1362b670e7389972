"""Tables that all tests of this folder use."""

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, n int, row string, label int"
LONG = " ".join(f"w{i % 977}" for i in range(30_000))


@pytest.fixture(scope="session")
def small(spark, sf_dir):
    return sf_dir.rsplit("/", 1)[0] + "/sf0.001"


@pytest.fixture(scope="session")
def table(spark, small):
    return lambda name: spark.read.parquet(f"{small}/{name}.parquet")


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, clashing names."""
    texts = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, LONG), (6, LONG), (6, LONG), (None, "no id here"),
             (None, None), (7, "ONE"), (8, "x" * 70_000), (9, "é ñ ß 梦 \U0001f600 <|im_end|> a\\b")]
    return spark.createDataFrame([(i, t, None, None, None, "c", 1, None, 2) for i, t in texts], DOCS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
