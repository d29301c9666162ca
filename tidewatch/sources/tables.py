"""Tables at rest: labelled corpora and anything Spark has a reader for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.sentiment import LABELS


def read_table(spark: SparkSession, path: str | None = None, format: str = "parquet", **options):
    """A persisted table; ``format="jdbc"`` with its options reads one from a database."""
    reader = spark.read.format(format).options(**options)
    return reader.load(path) if path else reader.load()


def public_corpus(table: DataFrame, text: str = "text", label: str = "label") -> DataFrame:
    """A table labelled 0, 1, 2 as corpus rows; any splits it has are taken together."""
    names = F.array(*map(F.lit, LABELS))
    return table.withColumns({
        "text": F.col(text), "label": F.get(names, F.col(label).cast("int")),
        "source": F.lit("public")})
