import pytest
from pyspark.sql import functions as F


@pytest.fixture
def texts(spark):
    """Documents from (id, text) pairs, with columns whose names the operators use inside."""

    def build(rows):
        df = spark.createDataFrame(list(rows), "doc_id bigint, text string")
        clash = ["id", "row", "key", "fp", "size", "kind", "spans", "after", "score", "label"]
        return df.withColumns({c: F.lit(7) for c in clash}).repartition(3)

    return build
