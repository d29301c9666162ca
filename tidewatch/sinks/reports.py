"""Corpus splits with their statistics, and the quality baseline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.plans.corpus import split_stats

BASELINE = "accuracy double, f1_macro double, n bigint"


def write_corpus(corpus: DataFrame, path: str) -> None:
    """Splits as Parquet below ``splits``, statistics of what was written below ``stats``."""
    corpus.write.mode("overwrite").partitionBy("split").parquet(f"{path}/splits")
    written = corpus.sparkSession.read.parquet(f"{path}/splits")
    split_stats(written).coalesce(1).write.mode("overwrite").json(f"{path}/stats")


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """One split of a written corpus; the others are not read."""
    return spark.read.parquet(f"{path}/splits").where(f"split = '{split}'").drop("split")


def write_baseline(verdict: DataFrame, path: str) -> bool:
    """Store the metrics if the verdict says so; tells whether it did."""
    # The one row is fetched first: the verdict may itself read the baseline at this path.
    row = verdict.where("save").select("accuracy", "f1_macro", "n").collect()
    if row:
        spark = verdict.sparkSession
        spark.createDataFrame(row, BASELINE).coalesce(1).write.mode("overwrite").json(path)
    return bool(row)


def read_baseline(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BASELINE).json(path)
