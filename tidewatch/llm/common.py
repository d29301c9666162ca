"""Helpers shared by the operators: named columns, stage tables, sizes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import shared_dir

BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 64 << 20
SLICE_BYTES = 8 << 20


def read(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}.parquet")


def named(df: DataFrame, **columns: str) -> DataFrame:
    """The wanted columns alone, under fixed names; other columns cannot clash with new ones."""
    return df.select(*[df[source].alias(name) for name, source in columns.items()])


def stage_table(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table below the folder that all executors share, and read it back.

    The lineage ends there, a lost executor costs no recomputation, and the planner knows the
    size of what it reads. ``drop_stage_tables`` removes the tables of a session.
    """
    spark = df.sparkSession
    folder = shared_dir(spark, purpose)
    df.write.parquet(folder)
    _FOLDERS.setdefault(spark.sparkContext.applicationId, []).append(folder)
    table = spark.read.schema(df.schema).parquet(folder)
    table.__dict__["stage_folder"] = folder
    return table


#: Folders written so far, per application.
_FOLDERS: dict[str, list[str]] = {}


def drop_stage_tables(spark: SparkSession, keep: DataFrame | None = None) -> None:
    """Remove the stage tables that this session has written, but ``keep``, if it is one.

    Results that still read others must be stored before.
    """
    held = _FOLDERS.pop(spark.sparkContext.applicationId, [])
    kept = keep.__dict__.get("stage_folder") if keep is not None else None
    jvm = spark.sparkContext._jvm
    for folder in held:
        if folder == kept:
            _FOLDERS.setdefault(spark.sparkContext.applicationId, []).append(folder)
            continue
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fits(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether the table holds so many rows and bytes at most. ``df`` should be a stored table."""
    held = df.limit(rows + 1).select(F.octet_length(F.to_json(F.struct("*"))).alias("size")).agg(
        F.count("*"), F.sum("size")).first()
    return held[0] <= rows and (held[1] or 0) <= size


def small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """The table marked for broadcasting if it fits, else as it is.

    Both give the same join; beyond the bounds Spark shuffles. ``df`` should be a stored table.
    """
    return F.broadcast(df) if fits(df, rows, size) else df


def remainder(id_column: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null ids count as empty text."""
    text = F.coalesce(id_column.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % divisor


def text_slices(
    batch: pa.RecordBatch, text: str = "text", size: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a slice holds about ``size`` bytes of text, or one longer text."""
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch[text]), 0))
    start = 0
    while start < batch.num_rows:
        total = np.cumsum(sizes[start:])
        count = max(1, int(np.searchsorted(total, size, side="right")))
        yield batch.slice(start, count)
        start += count


def byte_texts(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes, nulls as empty ones."""
    return pa.compute.fill_null(column, "").cast(pa.binary()).to_pylist()
