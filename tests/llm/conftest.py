import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def docs(spark):
    """Documents from ``(doc_id, text)`` or ``(doc_id, text, source)``, over a few partitions."""

    def build(rows, partitions=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(partitions)

    return build


@pytest.fixture
def space(spark):
    from ledgerline.workspace import Workspace

    return Workspace(spark, "test")
