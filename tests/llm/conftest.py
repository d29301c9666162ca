import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

TABLES = "/root/testdata/sf0.001"
TEXTS = StructType([StructField("doc_id", LongType()), StructField("text", StringType())])


@pytest.fixture
def frame(spark):
    """A table (doc_id, text) of the given rows or texts, over several partitions."""
    def make(rows, **more):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        df = spark.createDataFrame(rows, TEXTS)
        for name, value in more.items():
            df = df.withColumn(name, value)
        return df.repartition(3)

    return make
