"""Fitting on a bounded sample of labelled rows, in one task; scoring a table in every task."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows a classifier is fitted on at most: those with the smallest hash of the id.
TRAIN_ROWS = 12_000


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column,
                    rows: int = TRAIN_ROWS) -> DataFrame:
    """Texts with a label 0 or 1 (columns ``text``, ``label``), at most ``rows`` ids and rows.

    ``docs`` has ``doc_id`` and ``text``, ``labels`` has ``doc_id`` and ``label``; ``usable``
    tells of a doc_id whether its label may be learnt from. Null and other labels are left out;
    of several labels of an id the largest counts.
    """
    ids = (labels.where(usable & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
           .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    # At most ``rows`` ids are broadcast. An id may have many rows: of equal ones one is taken, and
    # of all those with the smallest hash.
    own = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("print")).join(
        F.broadcast(ids), "doc_id").dropDuplicates(["doc_id", "print"])
    return own.orderBy("print", "doc_id").limit(rows).select("text", "label")


def fit_in_one_task(examples: DataFrame, fit: Callable[[pa.Table], object]) -> object:
    """``fit`` on all rows of a bounded table, run by one task.

    Its result must be small and of plain types and arrays; None if there are no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        table = pa.Table.from_batches(held) if held else None
        model = fit(table) if table is not None and table.num_rows else None
        yield pa.record_batch({"model": [pickle.dumps(model)]})

    found = examples.repartition(1).mapInArrow(run, "model binary").collect()
    models = [pickle.loads(bytes(r[0])) for r in found]
    return next((m for m in models if m is not None), None)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def append_column(df: DataFrame, name: str, kind: str,
                  values: Callable[[pa.RecordBatch], pa.Array], drop: str = "") -> DataFrame:
    """All columns of ``df`` but ``drop``, and a new one that a task computes from each batch.

    A column of the new one's name is replaced.
    """
    kept = [f for f in df.schema.fields if f.name not in (name, drop)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.select([f.name for f in kept]).append_column(name, values(batch))

    return df.select(*[df[f.name] for f in df.schema.fields if f.name != name]).mapInArrow(
        run, StructType(list(kept)).add(name, kind))
