"""Seeded sampling, shuffling and exact splitting, the same on every run and engine.

Rows are ordered by a hash of the seed and a unique id. Nothing sorts the table: the hash is
uniform, so a histogram over its first digits tells the one bucket that holds the row of a
given rank, only that bucket is looked at closely, and every other row is decided by
comparing its hash to the hash of that row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Five hex digits: at most 1,048,576 buckets, each holding about a millionth of the rows.
_DIGITS = 5
_KEY = "_random_key"


def random_key(seed: int, *ids: str | Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *ids))


def _cuts(keyed: DataFrame, ranks: dict[str, Column]) -> Column:
    """A struct of the keys at the given ranks, from ``_rows``; null where a rank is zero."""
    prefix = F.left(F.col(_KEY), F.lit(_DIGITS)).alias("_prefix")
    histogram = keyed.groupBy(prefix).agg(F.count("*").alias("_count"))
    # One row per bucket, so these windows without partitions stay small.
    upto = Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = histogram.withColumns({
        "_upto": F.sum("_count").over(upto),
        "_rows": F.sum("_count").over(Window.partitionBy())})
    wanted = F.inline(F.array(*[
        F.struct(F.lit(name).alias("_cut"), rank.alias("_rank")) for name, rank in ranks.items()]))
    holding = (
        counted.select("*", wanted)
        .where((F.col("_rank") <= F.col("_upto")) & (F.col("_rank") > F.col("_upto") - F.col("_count")))
        .select("_prefix", "_cut", (F.col("_rank") - F.col("_upto") + F.col("_count")).alias("_nth"))
    )
    # At most one bucket per cut is broadcast, and only its rows are ranked.
    within = Window.partitionBy("_cut").orderBy(_KEY)
    ranked = (
        keyed.select(_KEY, prefix).join(F.broadcast(holding), "_prefix")
        .withColumn("_place", F.row_number().over(within))
        .where(F.col("_place") == F.col("_nth"))
    )
    return ranked.agg(F.struct(*[
        F.max(F.when(F.col("_cut") == name, F.col(_KEY))).alias(name) for name in ranks
    ])).scalar()


def _keyed(df: DataFrame, seed: int, ids: tuple[str, ...]) -> DataFrame:
    return df.withColumn(_KEY, random_key(seed, *ids))


def sample_rows(df: DataFrame, n: int, *ids: str, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all, if there are fewer), drawn by seed; ``ids`` tell rows apart."""
    keyed = _keyed(df, seed, ids)
    cut = _cuts(keyed, {"last": F.least(F.lit(n), F.col("_rows"))})
    return keyed.where(F.col(_KEY) <= F.coalesce(cut["last"], F.lit(""))).drop(_KEY)


def shuffle_rows(df: DataFrame, *ids: str, seed: int = 42) -> DataFrame:
    """All rows in seeded random order."""
    return df.orderBy(random_key(seed, *ids))


def with_position(df: DataFrame, *ids: str, seed: int = 42, into: str = "position") -> DataFrame:
    """Add every row's place, from 1, in the seeded random order.

    Rows are ranked inside buckets of the hash (all about equally full) and shifted by the rows
    of the buckets before, of which there are 65,536 at most to broadcast.
    """
    keyed = _keyed(df, seed, ids).withColumn("_bucket", F.left(F.col(_KEY), F.lit(4)))
    upto = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = keyed.groupBy("_bucket").agg(F.count("*").alias("_count"))
    offsets = counts.select(
        "_bucket", F.coalesce(F.sum("_count").over(upto), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(_KEY))
    return (
        keyed.withColumn(into, inside).join(F.broadcast(offsets), "_bucket")
        .withColumn(into, F.col(into) + F.col("_offset")).drop(_KEY, "_bucket", "_offset")
    )


def exact_split(
    df: DataFrame, *ids: str, seed: int = 42, train: float = 0.8, val: float = 0.1
) -> DataFrame:
    """Add ``split``: the first ``int(train * n)`` rows by seed, the next ``int(val * n)``, the rest."""
    return split_by_key(_keyed(df, seed, ids), _KEY, train, val).drop(_KEY)


def split_by_key(df: DataFrame, key: str, train: float = 0.8, val: float = 0.1) -> DataFrame:
    """``exact_split`` of rows that hold their random key already; only this column is passed over."""
    keyed = df if key == _KEY else df.withColumn(_KEY, F.col(key))
    first = (F.col("_rows") * F.lit(train)).cast("bigint")
    second = (F.col("_rows") * F.lit(val)).cast("bigint")
    cuts = _cuts(keyed.select(_KEY), {"train": first, "val": first + second})
    own = F.col(_KEY)
    return keyed.withColumn(
        "split",
        F.when(own <= F.coalesce(cuts["train"], F.lit("")), "train")
        .when(own <= F.coalesce(cuts["val"], F.lit("")), "val").otherwise("test"),
    )


def hash_split(
    df: DataFrame, *ids: str, seed: int = 42, train: float = 0.8, val: float = 0.1
) -> DataFrame:
    """Add ``split`` by hash alone: no pass over the data, shares only about right."""
    digits = F.left(random_key(seed, *ids), F.lit(8))
    share = F.conv(digits, 16, 10).cast("double") / F.lit(float(16**8))
    return df.withColumn(
        "split", F.when(share < train, "train").when(share < train + val, "val").otherwise("test"))


def first_rows(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first ``n`` rows by ``order``; each task passes on its own first ``n`` only."""
    return df.orderBy(*order).limit(n)
