import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("score", T.StringType()),  # a name that results use as well
        T.StructField("row", T.StringType()),
    ]
)
LONG = " ".join(f"word{k}" for k in range(30_000))
ODD = [
    (1, None, "en", "x", "y"),
    (2, "", "en", None, "y"),
    (3, " \n\t", None, "x", None),
    (4, "!?", "en", "x", "y"),
    (5, "one", "en", "x", "y"),
    (6, "the cat sat on the mat with a hat and a bat today", "en", "x", "y"),
    (6, "the cat sat on the mat with a hat and a bat today", "en", "x", "y"),
    (7, "the cat sat on the mat with a hat and a bat today", "en", "x", "y"),
    (8, LONG, "en", "x", "y"),
    (None, "no id here", "de", "x", "y"),
    (9, "aé中\U0001f600 z\x00", "de", "x", "y"),
]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOCS)
