"""Quality of a scorer on labelled texts, and the gate that compares it with a baseline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.scoring import Scorer

# Fixed value: how much macro-F1 may fall.
TOLERANCE = 0.01


def predict(texts: DataFrame, scorer: Scorer) -> DataFrame:
    """The texts with the scorer's label as ``predicted``."""
    columns = texts.columns
    scored = scorer(texts.withColumnRenamed("label", "_label"), "text")
    renamed = scored.withColumnRenamed("label", "predicted").withColumnRenamed("_label", "label")
    return renamed.select(*columns, "predicted")


def metrics(predictions: DataFrame, label: str = "label", predicted: str = "predicted") -> DataFrame:
    """One row: accuracy, unweighted mean of the F1 of all classes seen, and row count.

    One pass counts the pairs of label and prediction; the rest works on those few rows.
    """
    pairs = predictions.groupBy(
        F.col(label).alias("truth"), F.col(predicted).alias("guess")
    ).agg(F.count("*").alias("rows"))
    hit = F.when(F.col("truth") == F.col("guess"), F.col("rows")).otherwise(0)
    # A class has 2 * hits / (rows of that label + rows of that prediction); each pair adds to two.
    sides = pairs.select(
        F.explode(F.array("truth", "guess")).alias("class"), "rows", hit.alias("hits"))
    per_class = sides.groupBy("class").agg(
        (F.sum("hits") / F.sum("rows")).alias("f1"), F.sum("hits").alias("twice_hits"),
        F.sum("rows").alias("twice_rows"))
    return per_class.agg(
        (F.sum("twice_hits") / F.sum("twice_rows")).alias("accuracy"),
        F.avg("f1").alias("f1_macro"),
        (F.sum("twice_rows") / 2).cast("bigint").alias("n"),
    )


def gate(current: DataFrame, baseline: DataFrame | None, tolerance: float = TOLERANCE) -> DataFrame:
    """Verdict on ``current`` metrics: ``first``, ``improved``, ``kept`` or ``regression``.

    ``save`` says whether they become the baseline, ``exit_code`` is 2 for a regression.
    """
    before = F.lit(None).cast("double") if baseline is None else baseline.select("f1_macro").scalar()
    judged = current.withColumn("baseline_f1", before).withColumn(
        "delta", F.col("f1_macro") - F.col("baseline_f1"))
    verdict = (
        F.when(F.col("baseline_f1").isNull(), "first")
        .when(F.col("delta") < -tolerance, "regression")
        .when(F.col("delta") > 0, "improved").otherwise("kept")
    )
    return judged.withColumn("verdict", verdict).withColumns({
        "save": F.col("verdict").isin("first", "improved"),
        "exit_code": F.when(F.col("verdict") == "regression", 2).otherwise(0)})
