import pytest
from pyspark.sql import types as T

from seasonlens.session import share_package

AWKWARD = "a b c d e f g " * 3000


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    share_package(spark)


@pytest.fixture
def make(spark):
    """Documents of (id, text) rows, with columns whose names the operators use themselves."""

    def build(rows):
        schema = T.StructType(
            [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
            + [T.StructField(name, T.StringType()) for name in ("id", "key", "label", "score", "start", "n", "lang")]
        )
        return spark.createDataFrame([(i, text, *"abcdefg") for i, text in rows], schema)

    return build


@pytest.fixture
def awkward(make):
    """Nulls, empty, blank, very long and repeated texts, repeated and missing ids."""
    return make([
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, AWKWARD), (6, AWKWARD), (7, "one"), (7, "one"),
        (None, "one"), (None, None), (8, "Ünïcödé ﷽ 日本 \U0001f600 " * 30), (9, "x" * 5000),
    ])


@pytest.fixture
def empty(make):
    return make([])
