import pytest
from pyspark.sql import functions as F
from rows import EDGES

#: Extra columns that carry names the operators use inside.
CLASHES = ("node", "n", "text_hash", "kept", "hash", "start", "size", "target", "offset", "epochs", "chunk", "ids", "part",
           "kind", "n_words", "item_id", "site", "_cut", "found_id", "spans", "label")


@pytest.fixture(scope="session")
def edges(spark):
    rows = spark.createDataFrame(EDGES, "doc_id bigint, text string, source string").repartition(3)
    return rows.withColumns({c: F.lit(c) for c in CLASHES})


@pytest.fixture(scope="session")
def nothing(edges):
    return edges.where("false")


@pytest.fixture(scope="session")
def sample(spark):
    """Whole documents of the smallest table."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
