"""Approximate nearest neighbours by shifted space-filling curves.

Every curve projects the vectors on a few random directions, shifts them and puts them in Hilbert
order. Spark deals the rows of all curves by range of (curve, key); within its partition a query
looks at a window of rows on either side. What the curves find is merged and ranked by the
exact distance of the original vectors.

Equal vectors are searched as one and expanded again at the end, so that one very common vector
costs no more than a rare one, and ties go to the smallest ids exactly. Ranges of values are
taken from a sample of at most ``SAMPLE`` vectors (those with the smallest hash); values beyond
are put at the edge. A window that would cross the edge of a partition is moved inwards.

On 64 random directions (no structure to use, the hardest case) recall depends on the share of the
rows that a query looks at over all curves, so the window grows with the table: it is ``WINDOW`` or
more, and all windows of a query make ``SHARE`` of the rows. The README has figures.

Edge cases: rows without an id, and vectors null, empty, zero or with null or non-finite
components take no part; only vectors of equal length are compared; repeated rows count once;
a query with fewer candidates gets all of them; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import stage_table

CURVES = 48
AXES = 8
BITS = 7
WINDOW = 768
SHARE = 0.45
SAMPLE = 4096
SLOT_BITS = 14
ROWS = 16_384
NEAREST = 10


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of cell numbers (below 2 ** bits), as integers.

    The transposed form of the curve: undo the excess rotations from the highest bit down, apply
    the Gray code, and interleave the bits of all axes.
    """
    x = cells.T.astype(np.int64).copy()
    axes = len(x)
    for bit in range(bits - 1, 0, -1):
        high, low = 1 << bit, (1 << bit) - 1
        for i in range(axes):
            turned = (x[i] & high) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swap)
            x[i] ^= swap
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> bit) & 1, (1 << bit) - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(axes):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


class Curves:
    """Directions, scales and shifts of all curves for vectors of one length."""

    def __init__(self, sample: np.ndarray, curves: int, seed: int = 11) -> None:
        rng = np.random.default_rng([seed, sample.shape[1]])
        axes = min(AXES, sample.shape[1])
        self.curves = []
        for _ in range(curves):
            directions = np.linalg.qr(rng.standard_normal((sample.shape[1], axes)))[0]
            seen = sample @ directions
            low, width = seen.min(0), max(float(np.ptp(seen, axis=0).max()), 1e-12)
            self.curves.append((directions, low - width * (0.05 + 0.25 * rng.random(axes)), 1.35 * width))

    def keys(self, curve: int, vectors: np.ndarray) -> np.ndarray:
        directions, low, width = self.curves[curve]
        cells = np.floor((vectors @ directions - low) / width * (1 << BITS))
        return hilbert_keys(np.clip(cells, 0, (1 << BITS) - 1))


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, length)


def usable(table: DataFrame) -> DataFrame:
    """Rows (id, v) that take part."""
    v = F.col("v")
    strange = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return table.where(F.col("id").isNotNull() & v.isNotNull() & ~F.coalesce(strange, F.lit(False))
                       & F.exists(v, lambda x: x != 0))


def window_for(rows: int, curves: int = CURVES) -> int:
    """Rows to look at on either side, for so many distinct vectors of one length."""
    return max(WINDOW, math.ceil(SHARE * rows / (2 * curves)))


def fit(vectors: DataFrame, curves: int) -> dict[int, Curves]:
    """Curves per length of vectors, from at most ``SAMPLE`` vectors of each length."""
    hashed = vectors.select("n", "v", "rep", F.xxhash64("v").alias("h")).withColumn(
        "slot", F.shiftright("h", 64 - SLOT_BITS))
    # Counts by the first bits of the hash tell up to which slot the sample reaches, so that the
    # window below orders little more than the sample.
    counts = hashed.groupBy("n", "slot").count()
    upto = F.sum("count").over(Window.partitionBy("n").orderBy("slot")) - F.col("count")
    slots = counts.withColumn("before", upto).where(F.col("before") < SAMPLE).select("n", "slot")
    by = Window.partitionBy("n").orderBy("h", "rep")
    sample = hashed.join(F.broadcast(slots), ["n", "slot"], "left_semi").withColumn(
        "k", F.row_number().over(by)).where(
        F.col("k") <= SAMPLE).groupBy("n").agg(F.flatten(F.collect_list("v")).alias("v"))
    return {r["n"]: Curves(np.array(r["v"], np.float64).reshape(-1, r["n"]), curves)
            for r in sample.orderBy("n").collect()}


def _windows(keyed: DataFrame, window: int, best: int) -> DataFrame:
    """Candidates (query, rep, score) of the queries within each sorted partition."""
    def search(rep: np.ndarray, asks: np.ndarray, v: np.ndarray) -> Iterator[tuple]:
        for at in np.flatnonzero(asks):
            low = int(np.clip(at - window, 0, max(0, len(rep) - 2 * window - 1)))
            near = slice(low, min(low + 2 * window + 1, len(rep)))
            score = np.sqrt(((v[near] - v[at]) ** 2).sum(axis=1))
            order = np.lexsort((rep[near], score))[:best]
            yield np.full(len(order), rep[at]), rep[near][order], score[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]  # a partition holds about ``ROWS`` rows, or 16 windows
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        n, curve, rep = (np.asarray(table[c]) for c in ("n", "curve", "rep"))
        asks = table["asks"].to_numpy()
        edges = np.flatnonzero(np.concatenate([[True], (np.diff(n) != 0) | (np.diff(curve) != 0), [True]]))
        for a, b in zip(edges, edges[1:], strict=False):
            if asks[a:b].any():
                v = _matrix(table["v"].slice(a, b - a).combine_chunks(), int(n[a]))
                found = list(search(rep[a:b], asks[a:b], v))
                query, near, score = (np.concatenate(x) for x in zip(*found, strict=True))
                yield pa.record_batch({"query": query, "rep": near, "score": score})

    return keyed.mapInArrow(run, "query bigint, rep bigint, score double")


def nearest(table: DataFrame, asks: Column, vec_id: str = "vec_id", vector: str = "embedding",
            k: int = NEAREST, curves: int = CURVES, window: int | None = None) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the ``k`` nearest rows of every query.

    ``asks`` is a condition on the column ``id``, true for the rows that are queries. Without a
    ``window`` it is that of ``window_for`` for the most frequent length of vectors.
    """
    rows = usable(table.select(table[vec_id].cast("bigint").alias("id"), table[vector].alias("v")))
    vectors = stage_table(
        rows.groupBy("v").agg(F.min("id").alias("rep"), F.max(asks).alias("asks"))
        .withColumn("n", F.size("v")), "hilbert-vectors")
    sizes = vectors.groupBy("n").count().agg(F.max("count"), F.sum("count")).first()
    window = window or window_for(sizes[0] or 0, curves)
    models = fit(vectors, curves)
    spark = table.sparkSession
    shared = spark.sparkContext.broadcast(models)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.asarray(batch["n"])
            for n in np.unique(lengths):
                part = batch.filter(pa.array(lengths == n))
                v = _matrix(part["v"], int(n))
                for curve in range(curves):
                    yield pa.record_batch({
                        "n": part["n"], "curve": np.full(len(v), curve, np.int32),
                        "key": shared.value[int(n)].keys(curve, v), "rep": part["rep"],
                        "asks": part["asks"], "v": part["v"]})

    kind = vectors.schema["v"].dataType.simpleString()
    keyed = vectors.mapInArrow(
        key, f"n int, curve int, key bigint, rep bigint, asks boolean, v {kind}")
    # Windows that reach beyond a partition are moved, so partitions hold many windows.
    parts = max(1, -(-(sizes[1] or 0) * curves // max(ROWS, 16 * window)))
    order = ["n", "curve", "key", "rep"]
    dealt = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # The query's own vector, k others, and one more for the row that is the query itself.
    best = k + 2
    merged = _windows(dealt, window, best).groupBy("query", "rep").agg(F.min("score").alias("score"))
    ranked = merged.withColumn("r", F.row_number().over(
        Window.partitionBy("query").orderBy("score", "rep"))).where(F.col("r") <= best)
    # Of equal vectors the k + 1 smallest ids are enough.
    firsts = Window.partitionBy("v").orderBy("id")
    ids = (rows.distinct().withColumn("r", F.row_number().over(firsts)).where(F.col("r") <= k + 1)
           .groupBy("v").agg(F.collect_list("id").alias("ids"))
           .select(F.array_min("ids").alias("rep"), "ids"))
    near = ranked.join(ids, "rep").select("query", "score", F.explode("ids").alias("vec_id"))
    queries = rows.where(asks).distinct().join(vectors.select("v", "rep"), "v").select(
        F.col("id").alias("query_id"), F.col("rep").alias("query"))
    pairs = queries.join(near, "query").where("vec_id != query_id").groupBy(
        "query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
