"""Connected components of an undirected graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.session import shared_dir


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One round of the star algorithm: neighbours of a node move to its smallest neighbour.

    ``large``: of each node the larger neighbours move; otherwise the smaller ones and itself.
    The smallest neighbour comes from a combined aggregate and a join, which can be split where
    a node has most of the edges; no node's neighbours are ever gathered.
    """
    if large:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        return (both.where("b > a").join(least, "a")
                .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct())
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from every node that has an edge: columns ``node``, ``root``.

    ``edges`` has columns ``a`` and ``b`` (long); loops and repeated edges do no harm, an empty
    table gives an empty result. Large and small stars alternate until nothing changes; every
    round is checkpointed in the shared folder.
    """
    shared_dir(edges.sparkSession, "components")  # names a checkpoint folder where none is set
    now = edges.where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().checkpoint()
    seen = None
    while True:
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select("b", "b")).distinct()
        seen = state
        now = _star(_star(now, large=True), large=False).checkpoint()
