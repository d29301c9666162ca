"""Duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: str, *order: Column | str) -> DataFrame:
    """For every value of ``key`` the row that is first by ``order``; rows without a key go.

    An aggregate and not a window: copies are reduced to one row before the shuffle, so a
    value that a third of all rows share costs no more than others.
    """
    columns = df.columns
    first = F.min(F.struct(*[F.col(o) if isinstance(o, str) else o for o in order],
                           F.struct(*[F.col(c) for c in columns if c != key]).alias("_row")))
    kept = df.where(F.col(key).isNotNull()).groupBy(key).agg(first.alias("_first"))
    return kept.select(key, "_first._row.*").select(*columns)
