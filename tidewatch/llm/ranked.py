"""Ranked lexical search by pipelined term partitioning.

Terms belong to owners: the rare ones to the first, the most frequent ones to the last. Documents
are taken in blocks of a few thousand; a block's postings are one row per term. A bundle of items
sets out for every block with empty accumulators, the scores of the documents so far, and passes
the owners one after the other: a stage cogroups what the bundle carries with the owner's postings
of the block and adds their contributions, in 64-bit integers. Between stages only the
accumulators above zero travel, as sorted arrays; as rare terms come first, they are few, and the
many that frequent terms add come in the last stage and go no further than its task, which passes
on the highest of the block for every item. The final selection takes the highest of all blocks.
Nothing is pruned, so scores and ranks are exact.

Which rows form a block follows from the scan; the postings are stored before they are counted, so
a repeated task cannot mix two divisions. Items are handled in bundles of bounded text, each with
one pass over the documents; a bundle's terms, their owners and weights travel with the tasks.

Edge cases: null and empty texts have no terms; such documents count for nothing, such items give
no row; rows of one item_id are one item of all their terms; every row of ``docs`` is a document,
also if its id repeats; equal scores are ordered by doc_id, null ids last, then alike rows in any
order; empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import byte_texts, stage_table, text_slices

TOP = 10
#: Documents of a block at most; their numbers take 16 bits.
BLOCK = 4096
#: Bytes of distinct terms and number of items in a bundle, on average.
BUNDLE_BYTES, BUNDLE_ITEMS = 4 << 20, 1000
#: The owners after the first take terms from these parts of the documents on.
OWNERS = (0.02, 0.2)
_TERMS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
POSTINGS = ("block bigint, term int, docs binary, freqs binary, size bigint, "
            "n_docs bigint, n_terms bigint, ids array<bigint>")
CARRIED = "block bigint, ids array<bigint>, lengths binary, items binary, docs binary, scores binary"


def item_terms(items: DataFrame) -> DataFrame:
    """The distinct terms of every item: item_id, term."""
    lowered = F.translate(items["text"], _CAPITALS, _CAPITALS.lower())
    return items.select(
        items["item_id"].cast("bigint").alias("item_id"),
        F.explode(F.regexp_extract_all(lowered, F.lit(_TERM), 0)).alias("term")).distinct()


def postings(docs: DataFrame, numbers: dict[bytes, int], block: int = BLOCK) -> DataFrame:
    """Postings of the numbered terms, a row per block and term, and one of term -1 per block.

    The latter has the ids and lengths (``docs``: 64-bit integers) of the block's documents.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for batch in batches:
            for slice_ in text_slices(batch):
                for at in range(0, slice_.num_rows, block):
                    part = slice_.slice(at, block)
                    found, lengths = [], []
                    for text in byte_texts(part["text"]):
                        words = text.translate(_TERMS).split()
                        lengths.append(len(words))
                        found.append(np.array([n for n in map(numbers.get, words) if n is not None], np.int64))
                    own = np.repeat(np.arange(len(found)), [len(f) for f in found])
                    keys, freqs = np.unique(
                        np.concatenate([*found, np.zeros(0, np.int64)]) << 16 | own, return_counts=True)
                    terms, starts = np.unique(keys >> 16, return_index=True)
                    cuts = [*starts.tolist(), len(keys)]
                    spans = list(zip(cuts, cuts[1:], strict=False))
                    where, freqs = (keys & 0xFFFF).astype("<u2"), freqs.astype("<u4")
                    size = np.array(lengths, "<i8")
                    yield pa.record_batch({
                        "block": pa.array([first] * (len(terms) + 1), pa.int64()),
                        "term": pa.array([-1, *terms.tolist()], pa.int32()),
                        "docs": pa.array([size.tobytes(), *(
                            where[a:b].tobytes() for a, b in spans)], pa.binary()),
                        "freqs": pa.array([b"", *(
                            freqs[a:b].tobytes() for a, b in spans)], pa.binary()),
                        "size": pa.array([0, *(b - a for a, b in spans)], pa.int64()),
                        "n_docs": pa.array([int((size > 0).sum())] + [0] * len(terms), pa.int64()),
                        "n_terms": pa.array([int(size.sum())] + [0] * len(terms), pa.int64()),
                        "ids": pa.array([part["doc_id"].to_pylist()] + [None] * len(terms),
                                        pa.list_(pa.int64()))})
                    first += 1

    plain = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"])
    return plain.mapInArrow(run, POSTINGS)


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def contributions(freqs: np.ndarray, lengths: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """What a term adds to documents, before its weight."""
    m = 10 + 90 * lengths * documents // terms
    return 1_000_000_000 * freqs // (1000 * freqs + 8 * m)


def _stage(carried: pa.Table, owned: pa.Table, last: bool, weights: dict[int, int],
           holders: dict[int, np.ndarray], documents: int, terms: int, items: list, top: int) -> pa.Table:
    """What a bundle carries for a block after an owner; after the last one the highest scores."""
    row = carried.slice(0, 1).to_pylist()[0]
    lengths = np.frombuffer(row["lengths"], "<i8")
    scores = np.zeros((len(items), len(lengths)), np.int64)
    scores[np.frombuffer(row["items"], "<i4"), np.frombuffer(row["docs"], "<u2")] = np.frombuffer(
        row["scores"], "<i8")
    for term, docs, freqs in zip(owned["term"].to_pylist(), owned["docs"].to_pylist(),
                                 owned["freqs"].to_pylist(), strict=True):
        at = np.frombuffer(docs, "<u2")
        adds = weights[term] * contributions(
            np.frombuffer(freqs, "<u4").astype(np.int64), lengths[at], documents, terms)
        scores[np.ix_(holders[term], at)] += adds
    if not last:
        who, where = np.nonzero(scores)
        return pa.table({
            "block": carried["block"], "ids": carried["ids"], "lengths": carried["lengths"],
            "items": pa.array([who.astype("<i4").tobytes()], pa.binary()),
            "docs": pa.array([where.astype("<u2").tobytes()], pa.binary()),
            "scores": pa.array([scores[who, where].astype("<i8").tobytes()], pa.binary())})
    ids = row["ids"]
    # Ties: the smaller doc_id first, null ids last.
    order = np.array(sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0)), np.int64)
    ranked = scores[:, order]
    best = np.argsort(-ranked, axis=1, kind="stable")[:, :top]
    high = np.take_along_axis(ranked, best, axis=1)
    who, place = np.nonzero(high > 0)
    where = order[best[who, place]]
    return pa.table({
        "item_id": pa.array([items[i] for i in who], pa.int64()),
        "doc_id": pa.array([ids[i] for i in where], pa.int64()),
        "score": pa.array(high[who, place], pa.int64())})


def _bundle(docs: DataFrame, own: DataFrame, top: int, block: int) -> DataFrame:
    """The highest of every block for the items of one bundle."""
    rows = own.collect()  # the terms of a bundle of bounded text
    items = list({r["item_id"]: None for r in rows})
    number_of = {item: n for n, item in enumerate(items)}
    numbers: dict[str, int] = {}
    holding: dict[int, list[int]] = {}
    for r in rows:
        holding.setdefault(numbers.setdefault(r["term"], len(numbers)), []).append(number_of[r["item_id"]])
    holders = {term: np.array(sorted(h), np.int64) for term, h in holding.items()}
    found = stage_table(
        postings(docs, {t.encode(): n for t, n in numbers.items()}, block), "ranked-postings")
    # At most one row per term of the bundle.
    sums = found.groupBy("term").agg(*[F.sum(c) for c in ("size", "n_docs", "n_terms")]).collect()
    documents, terms = next((r[2:] for r in sums if r[0] == -1), (0, 0))
    weights = {r[0]: weight(documents, r[1]) for r in sums if r[0] >= 0}
    bounds = [documents * part for part in OWNERS]
    owner = {r[0]: sum(r[1] >= b for b in bounds) for r in sums if r[0] >= 0}
    spark = docs.sparkSession
    owners = F.broadcast(spark.createDataFrame(list(owner.items()), "term int, owner int"))
    owned = found.where("term >= 0").join(owners, "term").select(
        F.col("block").alias("block"), "owner", "term", "docs", "freqs")
    nothing = F.lit(b"")
    carried = found.where("term = -1").select(
        "block", "ids", F.col("docs").alias("lengths"), nothing.alias("items"), nothing.alias("docs"),
        nothing.alias("scores"))
    for stage in range(len(OWNERS) + 1):
        last = stage == len(OWNERS)
        step = partial(_stage, last=last, weights=weights, holders=holders, documents=documents,
                       terms=terms, items=items, top=top)
        carried = carried.groupBy("block").cogroup(
            owned.where(F.col("owner") == stage).groupBy("block")).applyInArrow(
            step, "item_id bigint, doc_id bigint, score bigint" if last else CARRIED)
    return carried


def search(docs: DataFrame, items: DataFrame, top: int = TOP, bundle_bytes: int = BUNDLE_BYTES,
           bundle_items: int = BUNDLE_ITEMS, block: int = BLOCK) -> DataFrame:
    """Of each item the ``top`` highest-scoring documents: item_id, rank, doc_id, score."""
    terms = stage_table(item_terms(items), "ranked-items")
    total, count = terms.agg(F.sum(F.octet_length("term") + 8), F.count_distinct("item_id")).first()
    bundles = max(1, -(-(total or 0) // bundle_bytes), -(-count // bundle_items))
    parts = [_bundle(docs, terms.where(F.pmod(F.xxhash64("item_id"), F.lit(bundles)) == n), top, block)
             for n in range(bundles)]
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return reduce(DataFrame.unionByName, parts).withColumn("rank", F.row_number().over(best)).where(
        F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")
