"""Text quality: random-indexing word vectors, pooled per document, and a small network.

A token (a run of word characters or of signs, case kept) falls into one of ``BUCKETS`` hash
buckets. Its vector is the sum of sparse random index vectors of the tokens around it, over
every document given. A document is described by mean, spread and neighbour products of its
tokens' vectors; a two-layer network, fitted with numpy on a bounded sample of labelled rows,
scores it, and a temperature fitted on rows kept back calibrates the probability.

Edge cases: null, empty and blank texts have all features zero and get the score the network
gives these; without labels of both classes the score is the smoothed share of label 1 (0.5
without any); repeated rows get equal scores; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import byte_texts, named, remainder, text_slices
from tidewatch.llm.learn import append_column, fit_in_one_task, labelled_sample, sigmoid

BUCKETS = 1 << 15
SIZE = 32
NONZERO = 4
REACH = 2
HIDDEN = 32
EPOCHS = 60
BLOCK = 1 << 17
SLICE = 1 << 20
KEEP = 0.7
TOKEN = re.compile(rb"[0-9A-Za-z_\x80-\xff]+|[^0-9A-Za-z_\x80-\xff\s]+")


def token_buckets(data: bytes) -> np.ndarray:
    found = TOKEN.findall(data)
    return np.fromiter(map(zlib.crc32, found), np.int64, len(found)) & (BUCKETS - 1)


def index_vectors(seed: int = 7) -> np.ndarray:
    """A sparse random vector of -1, 0, 1 per bucket, and a zero one for the gap between texts."""
    rng = np.random.default_rng(seed)
    out = np.zeros((BUCKETS + 1, SIZE), np.float32)
    places = np.argsort(rng.random((BUCKETS, SIZE)), axis=1)[:, :NONZERO]
    np.put_along_axis(out[:-1], places, rng.choice([-1.0, 1.0], (BUCKETS, NONZERO)).astype(np.float32), 1)
    return out


def _add_contexts(total: np.ndarray, buckets: np.ndarray, index: np.ndarray) -> None:
    """Add to each bucket's row the index vectors of the tokens around its tokens."""
    gap = np.full(REACH, BUCKETS)
    padded = np.concatenate([gap, buckets, gap])
    for at in range(0, len(buckets), BLOCK):
        here = padded[at:at + BLOCK + 2 * REACH]
        n = len(here) - 2 * REACH
        around = sum(index[here[REACH + o:REACH + o + n]]
                     for o in range(-REACH, REACH + 1) if o)
        mine = here[REACH:REACH + n]
        for d in range(SIZE):
            total[:, d] += np.bincount(mine, weights=around[:, d], minlength=BUCKETS + 1)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit vectors per bucket from all texts (column ``text``); 4 MB at any size of the input."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, total = index_vectors(), np.zeros((BUCKETS + 1, SIZE))
        for batch in batches:
            for part in text_slices(batch, size=SLICE):
                pieces = []
                for data in byte_texts(part["text"]):
                    pieces += [token_buckets(data), np.full(REACH, BUCKETS)]
                _add_contexts(total, np.concatenate(pieces), index)
        used = np.flatnonzero(total[:-1].any(axis=1))
        yield pa.record_batch({
            "bucket": pa.array(used.astype(np.int32)),
            "v": pa.FixedSizeListArray.from_arrays(
                total[used].ravel().astype(np.float32), SIZE).cast(pa.list_(pa.float32()))})

    sums = docs.select("text").mapInArrow(run, "bucket int, v array<float>").groupBy("bucket").agg(
        F.array(*[F.sum(F.col("v")[d]) for d in range(SIZE)]).alias("v"))
    out = np.zeros((BUCKETS + 1, SIZE), np.float32)
    rows = sums.toArrow()
    out[np.asarray(rows["bucket"])] = np.asarray(
        rows["v"].combine_chunks().flatten(), np.float32).reshape(-1, SIZE)
    # Frequent tokens lie in every context: without the mean direction vectors tell more.
    out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)
    used = out.any(axis=1)
    if used.any():
        out[used] -= out[used].mean(axis=0)
        out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)
    return out


FEATURES = 3 * SIZE + 1


def pooled(data: bytes, vectors: np.ndarray) -> np.ndarray:
    """Mean, spread and mean neighbour product of the vectors of a text, and its log length."""
    buckets = token_buckets(data)
    n = len(buckets)
    out = np.zeros(FEATURES, np.float32)
    if not n:
        return out
    total, square, beside = np.zeros((3, SIZE))
    for at in range(0, n, BLOCK):
        v = vectors[buckets[at:at + BLOCK + 1]]
        own = v[:BLOCK]
        total += own.sum(0)
        square += np.einsum("ij,ij->j", own, own)
        beside += np.einsum("ij,ij->j", v[:-1], v[1:])
    mean = total / n
    out[:SIZE], out[SIZE:2 * SIZE] = mean, np.sqrt(np.maximum(square / n - mean * mean, 0))
    out[2 * SIZE:-1], out[-1] = beside / max(n - 1, 1) * 4, 0.1 * np.log1p(n)
    return out


@dataclass(frozen=True)
class Network:
    """tanh layer, linear layer; probability after division by the temperature."""

    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.centre) / self.scale @ self.w1 + self.b1)
        return sigmoid((hidden @ self.w2 + self.b2) / self.temperature)


def fit_network(x: np.ndarray, y: np.ndarray, seed: int = 3) -> Network | float:
    """Fit by Adam on four fifths of the rows, the temperature on the rest."""
    if len(np.unique(y)) < 2:
        return float((y.sum() + 1) / (len(y) + 2)) if len(y) else 0.5
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    kept, rows = order[: len(y) // 5], order[len(y) // 5:]
    centre, scale = x[rows].mean(0), x[rows].std(0) + 1e-3
    z = (x - centre) / scale
    p = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
         rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    first, second, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for _ in range(EPOCHS):
        for batch in np.array_split(rng.permutation(rows), max(1, len(rows) // 256)):
            h = np.tanh(z[batch] @ p[0] + p[1])
            wrong = (sigmoid(h @ p[2] + p[3]) - y[batch]) / len(batch)
            back = np.outer(wrong, p[2]) * (1 - h * h)
            grads = [z[batch].T @ back + 1e-4 * p[0], back.sum(0), h.T @ wrong + 1e-4 * p[2],
                     wrong.sum(keepdims=True)]
            step += 1
            for a, g, m, v in zip(p, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                a -= 0.003 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    logits = np.tanh(z[kept] @ p[0] + p[1]) @ p[2] + p[3]
    # Not below 0.5, so that no wrong side becomes certain from a few rows kept back.
    grid = np.geomspace(0.5, 8, 41)
    loss = [np.logaddexp(0, np.where(y[kept] == 1, -logits, logits) / t).sum() for t in grid]
    return Network(centre, scale, p[0], p[1], p[2], float(p[3][0]), float(grid[int(np.argmin(loss))]))


@dataclass(frozen=True)
class Model:
    vectors: np.ndarray
    network: Network | float

    def scores(self, texts: pa.Array) -> pa.Array:
        x = np.stack([pooled(t, self.vectors) for t in byte_texts(texts)])
        if isinstance(self.network, float):
            return pa.array(np.full(len(x), self.network))
        return pa.array(self.network.probability(x).astype(np.float64))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Vectors from all ``docs``; the network from labels whose crc32(doc_id) mod 4 is not 2."""
    docs = named(docs, doc_id="doc_id", text="text")
    vectors = word_vectors(docs)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    sample = labelled_sample(docs, labels, "quality", remainder(F.col("doc_id"), 4) != 2)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [pooled(t, shared.value).astype("<f4").tobytes() for t in byte_texts(batch["text"])]
            yield pa.record_batch({"x": pa.array(x, pa.binary()), "label": batch["label"]})

    def train(table: pa.Table) -> tuple | float:
        x = np.frombuffer(b"".join(table["x"].to_pylist()), "<f4").reshape(-1, FEATURES)
        order = np.lexsort(x.T)  # the rows come in any order; the fit must not depend on it
        found = fit_network(x[order].astype(np.float64), np.asarray(table["label"])[order])
        return found if isinstance(found, float) else astuple(found)

    found = fit_in_one_task(sample.mapInArrow(describe, "x binary, label int"), train)
    return Model(vectors, Network(*found) if isinstance(found, tuple) else found or 0.5)


def with_scores(docs: DataFrame, model: Model, text: str = "text", name: str = "quality_score",
                drop: str = "") -> DataFrame:
    """All columns of ``docs`` but ``drop``, and the probability of good quality."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return append_column(docs, name, "double", lambda batch: shared.value.scores(batch[text]), drop)


def keep_good(docs: DataFrame, labels: DataFrame, least: float = KEEP) -> DataFrame:
    """The rows and columns of ``docs`` with a score of ``least`` or more."""
    scored = with_scores(docs, fit(docs, labels))
    return scored.where(F.col("quality_score") >= least).select(*docs.columns)


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every document."""
    plain = named(docs, doc_id="doc_id", text="text")
    scored = with_scores(plain, fit(plain, labels), name="score", drop="text")
    return scored.select(
        "doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
        F.when(F.col("score") >= KEEP, 1).otherwise(0).alias("predicted"))
