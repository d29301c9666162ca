"""How filters interact: what every order of them removes, by wide packed counters.

A document is known by its mask, the filters it fails, and by its labels. All orders of the five
filters have 600 steps in total. A mask is mapped to one integer of 2,401 fields of 64 bits: a
field for the document itself, and for every step whether it is removed there, fails there though
removed before, and is of quality or toxic and removed there. Adding up these integers counts all
steps of all orders at once; a field holds more rows than a table can have, so none overflows into
the next. Every task adds up the integers of its rows per part, sums meet in two rounds, salted
first, so that neither a large part nor many tasks gather in one task, and are then unpacked.

Edge cases: null texts count as empty; a null part is the empty string; a null doc_id is neither
smaller nor larger than another, has no labels and fails ``E`` never; rows of equal doc_id are
documents of their own and not copies of each other; of several labels of an id the largest
counts; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import byte_texts, stage_table, text_slices

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = len(ORDERS) * len(FILTERS)
#: Counters of a step, in the order of their fields.
COUNTERS = ("removed", "redundant", "good_lost", "toxic_lost")
FIELD_BYTES = 8
BYTES = FIELD_BYTES * (1 + STEPS * len(COUNTERS))
#: Parts whose sums a task holds at once, and tasks whose sums meet in the first round.
HELD_PARTS = 1000
LANES = 64
MIN_WORDS = 200
_SIGNS, _CAPITALS = b"#$%&*|", bytes(range(0x41, 0x5B))
_FOLLOWING = bytes(range(0x80, 0xC0))  # bytes that begin no code point


def own_failures(text: bytes) -> int:
    """The filters A to D that a text fails, as bits 0 to 3."""
    words = text.split()
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    points = len(text) - len(text.translate(None, _FOLLOWING)) if not text.isascii() else 0
    signs = len(text) != len(text.translate(None, _SIGNS))
    return ((len(words) < MIN_WORDS) | (100 * len(set(words)) < 50 * len(words)) << 1
            | (100 * capitals > 2 * (len(text) - points)) << 2 | signs << 3)


@cache
def packed(code: int) -> int:
    """The integer of a document: bits 0 to 4 the filters it fails, 5 quality, 6 toxic."""
    mask, good, toxic = code & 31, code >> 5 & 1, code >> 6 & 1
    fields = np.zeros(BYTES // FIELD_BYTES, "<u8")
    fields[0] = 1
    steps = fields[1:].reshape(STEPS, len(COUNTERS))
    for number, order in enumerate(ORDERS):
        failed = [k for k, letter in enumerate(order) if mask >> FILTERS.index(letter) & 1]
        for k in failed:
            gone = k == failed[0]
            steps[number * len(FILTERS) + k] = gone, not gone, gone and good, gone and toxic
    return int.from_bytes(fields.tobytes(), "little")


def unpacked(total: int) -> tuple[int, np.ndarray]:
    """Documents, and counts by step and counter."""
    fields = np.frombuffer(total.to_bytes(BYTES, "little"), "<u8").astype(np.int64)
    return int(fields[0]), fields[1:].reshape(STEPS, len(COUNTERS))


def masks(docs: DataFrame, part: str = "source") -> DataFrame:
    """doc_id, part, the mask of filters A to D, and the digest of the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in text_slices(batch):
                texts = byte_texts(rows["text"])
                yield pa.record_batch({
                    "doc_id": rows["doc_id"], "part": rows["part"],
                    "mask": pa.array([own_failures(t) for t in texts], pa.int32()),
                    "digest": pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())})

    plain = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"], F.coalesce(
        docs[part].cast("string"), F.lit("")).alias("part"))
    return plain.mapInArrow(run, "doc_id bigint, part string, mask int, digest binary")


def codes(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """part and code of every document; ``E`` compares with all documents of the table."""
    found = stage_table(masks(docs, part), "audit-masks")
    # Stored before they are joined: Spark splits a hot key only where both sides come straight
    # from a shuffle.
    copied = stage_table(found.groupBy("digest").agg(
        F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "audit-copied")
    flags = stage_table(labels.where(labels["doc_id"].isNotNull()).groupBy(
        labels["doc_id"].cast("bigint").alias("doc_id")).agg(
        F.max((labels["quality"] == 1).cast("int")).alias("good"),
        F.max((labels["toxic"] == 1).cast("int")).alias("toxic")), "audit-labels")

    def bit(place: int, holds: Column) -> Column:
        return F.when(holds, 1 << place).otherwise(0)

    return found.join(copied, "digest", "left").join(flags, "doc_id", "left").select("part", (
        F.col("mask") + bit(4, F.col("doc_id") > F.col("first")) + bit(5, F.col("good") == 1)
        + bit(6, F.col("toxic") == 1)).alias("code"))


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the integers of a task's rows, per part."""
    sums: dict[str, int] = {}
    lane = TaskContext.get().partitionId() % LANES

    def flushed() -> pa.RecordBatch:
        rows = pa.record_batch({
            "part": pa.array(list(sums), pa.string()),
            "lane": pa.array([lane] * len(sums), pa.int32()),
            "total": pa.array([s.to_bytes(BYTES, "little") for s in sums.values()], pa.binary())})
        sums.clear()
        return rows

    for batch in batches:
        parts = batch["part"].dictionary_encode()
        both = np.asarray(parts.indices, np.int64) << 7 | np.asarray(batch["code"])
        names = parts.dictionary.to_pylist()
        for key, count in zip(*np.unique(both, return_counts=True), strict=True):
            name = names[key >> 7]
            if name not in sums and len(sums) >= HELD_PARTS:
                yield flushed()
            sums[name] = sums.get(name, 0) + packed(int(key & 127)) * int(count)
    yield flushed()


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part to one row per part, one sum held at a time."""
    name, lane, total, rows = None, None, 0, []

    def row(values: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch({
            "part": pa.array([v[0] for v in values], pa.string()),
            "lane": pa.array([v[1] for v in values], pa.int32()),
            "total": pa.array([v[2].to_bytes(BYTES, "little") for v in values], pa.binary())})

    for batch in batches:
        for key, place, value in zip(batch["part"].to_pylist(), batch["lane"].to_pylist(),
                                     batch["total"], strict=True):
            if key != name and name is not None:
                rows.append((name, lane, total))
                total = 0
                if len(rows) >= HELD_PARTS:
                    yield row(rows)
                    rows = []
            name, lane = key, place
            total += int.from_bytes(value.as_buffer(), "little")
    yield row(rows + ([(name, lane, total)] if name is not None else []))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The 600 steps of every part."""
    letters = np.array([FILTERS.index(x) for order in ORDERS for x in order])
    step = np.tile(np.arange(len(FILTERS)), len(ORDERS))
    for batch in batches:
        for part, total in zip(batch["part"].to_pylist(), batch["total"], strict=True):
            n, counts = unpacked(int.from_bytes(total.as_buffer(), "little"))
            by = dict(zip(COUNTERS, counts.T, strict=True))
            gone = by["removed"].reshape(len(ORDERS), len(FILTERS)).cumsum(axis=1).ravel()
            # Removed by the last filter of an order: failing that filter alone.
            alone = np.zeros(len(FILTERS), np.int64)
            alone[letters[step == len(FILTERS) - 1]] = by["removed"][step == len(FILTERS) - 1]
            share = np.zeros(len(FILTERS), np.int64)
            np.add.at(share, letters, by["removed"])
            yield pa.record_batch({
                "part": pa.array([part] * STEPS, pa.string()),
                "filter_order": pa.array(np.repeat(ORDERS, len(FILTERS)).tolist(), pa.string()),
                "step": pa.array(step + 1, pa.int32()),
                "kept": pa.array(n - gone, pa.int64()),
                "removed": pa.array(by["removed"], pa.int64()),
                "redundant": pa.array(by["redundant"], pa.int64()),
                "unique_fails": pa.array(alone[letters], pa.int64()),
                "good_lost": pa.array(by["good_lost"], pa.int64()),
                "toxic_lost": pa.array(by["toxic_lost"], pa.int64()),
                "shapley": pa.array(share[letters], pa.int64())})


STEP_ROWS = ("part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
             "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint")


def audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """One row per part, order of the filters and step.

    ``kept`` after the step, ``removed`` here, ``redundant`` (failing here, removed before),
    ``unique_fails`` (failing this filter alone), ``good_lost`` and ``toxic_lost`` (removed here
    and labelled so), ``shapley`` (removed by this filter, summed over all orders).
    """
    form = "part string, lane int, total binary"
    sums = codes(docs, labels, part).mapInArrow(_summed, form)
    first = sums.repartition("part", "lane").sortWithinPartitions("part", "lane").mapInArrow(_met, form)
    whole = first.repartition("part").sortWithinPartitions("part").mapInArrow(_met, form)
    return whole.mapInArrow(_rows, STEP_ROWS)
