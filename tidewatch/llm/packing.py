"""Packing of token sequences by Karmarkar-Karp multiway differencing.

A document's ids are cut into whole windows and a rest; rests are cut into pieces of at most
``PIECE`` ids. Pieces are dealt into groups of bounded size by a hash, and each group is divided
by differencing: the two partial partitions with the largest imbalance are merged, the largest
windows of one with the smallest of the other, until one partition is left. Its windows are
nearly equal. If one exceeds the capacity the group is divided again into one window more.

Edge cases: null and empty texts are documents of the end id alone; rows of equal or null doc_id
are packed apart; repeated rows are all packed; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import tokens
from tidewatch.llm.common import byte_texts, text_slices

CAPACITY = 2048
PIECE = 512
END_ID = 1
#: Bytes of text whose pieces make up a group, on average.
GROUP_BYTES = 1 << 20
PIECES = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary"


def difference(lengths: np.ndarray, windows: int) -> list[list[int]]:
    """Divide items into so many windows of near-equal sums; returns the items of each window.

    A partial partition holds only its windows that are not empty, by falling sum. Windows are
    trees of items, so that merging two takes no time in their sizes.
    """
    order, heap = count(), []
    for i in np.argsort(-lengths, kind="stable"):
        heap.append((-int(lengths[i]), next(order), np.array([lengths[i]], np.int64), [int(i)]))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, _, a, left = heapq.heappop(heap)
        _, _, b, right = heapq.heappop(heap)
        over = max(0, len(a) + len(b) - windows)
        # The smallest of one meet the smallest of the other only where no window is empty.
        sums = np.concatenate([a[:len(a) - over], a[len(a) - over:] + b[::-1][:over], b[:len(b) - over]])
        trees = (left[:len(a) - over]
                 + [(x, y) for x, y in zip(left[len(a) - over:], right[::-1][:over], strict=True)]
                 + right[:len(b) - over])
        by = np.argsort(-sums, kind="stable")
        sums, trees = sums[by], [trees[i] for i in by]
        low = int(sums[-1]) if len(sums) == windows else 0
        heapq.heappush(heap, (low - int(sums[0]), next(order), sums, trees))
    out: list[list[int]] = []
    for tree in heap[0][3] if heap else []:
        items, stack = [], [tree]
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack += node
            else:
                items.append(node)
        out.append(sorted(items))
    return out


def balanced(lengths: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Near-equal windows within the capacity, of as few as differencing manages."""
    windows = max(1, -(-int(lengths.sum()) // capacity))
    while len(lengths):
        found = difference(lengths, windows)
        if max(int(lengths[w].sum()) for w in found) <= capacity:
            return found
        windows += 1
    return []


def pieces(docs: DataFrame, path: str | None = None, end_id: int = END_ID, capacity: int = CAPACITY,
           piece: int = PIECE) -> DataFrame:
    """Whole windows and pieces of rests of every document, ids as 16-bit integers, with a salt."""
    path = path or tokens.default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end, row = np.array([end_id], "<u2").tobytes(), 0
        for batch in batches:
            for part in text_slices(batch, size=tokens.SLICE):
                names: dict[str, list] = {k: [] for k in (
                    "doc_id", "start", "length", "doc_tokens", "ids", "salt")}
                found = tokens.encoder(path).encode(byte_texts(part["text"]))
                for doc_id, ids in zip(part["doc_id"].to_pylist(), found, strict=True):
                    ids += end
                    n = len(ids) // 2
                    whole = n - n % capacity
                    rest = -(-(n - whole) // piece)
                    # Pieces of a rest are of one length but for one id.
                    cuts = [*range(0, whole, capacity), *(
                        whole + (n - whole) * k // rest for k in range(rest)), n]
                    for a, b in zip(cuts, cuts[1:], strict=False):
                        for k, v in zip(names, (doc_id, a, b - a, n, ids[2 * a:2 * b], row), strict=True):
                            names[k].append(v)
                        row += 1
                yield pa.record_batch({
                    k: pa.array(v, pa.binary() if k == "ids" else pa.int64()) for k, v in names.items()})

    plain = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"])
    return plain.mapInArrow(run, PIECES + ", salt bigint")


def pack(docs: DataFrame, path: str | None = None, end_id: int = END_ID, capacity: int = CAPACITY,
         piece: int = PIECE, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, ids (little-endian 32-bit integers),
    sequence_id and offset (place in the sequence, without gaps)."""
    total = docs.agg(F.sum(F.coalesce(F.octet_length(docs["text"]), F.lit(0)) + 1)).first()[0] or 0
    groups = max(1, -(-total // group_bytes))
    dealt = pieces(docs, path, end_id, capacity, piece).withColumn(
        "group", F.pmod(F.xxhash64("doc_id", "start", "salt"), F.lit(groups)))

    def run(table: pa.Table) -> pa.Table:
        # In a fixed order, so that a repeated task gives the same sequences.
        table = table.sort_by([(c, "ascending") for c in ("doc_id", "start", "ids", "salt")])
        lengths = np.asarray(table["length"])
        full = np.flatnonzero(lengths == capacity)
        rest = np.flatnonzero(lengths < capacity)
        sequences = [[i] for i in full] + [rest[w].tolist() for w in balanced(lengths[rest], capacity)]
        order = np.array([i for s in sequences for i in s], np.int64)
        number = np.repeat(np.arange(len(sequences)), [len(s) for s in sequences])
        offset = np.concatenate([np.cumsum(lengths[s]) - lengths[s] for s in sequences])
        first = table["group"][0].as_py() << 24
        out = table.take(order)
        wide = [np.frombuffer(x, "<u2").astype("<u4").tobytes() for x in out["ids"].to_pylist()]
        return pa.table({
            "doc_id": out["doc_id"], "start": out["start"], "length": out["length"],
            "doc_tokens": out["doc_tokens"], "ids": pa.array(wide, pa.binary()),
            "sequence_id": pa.array(first + number, pa.int64()), "offset": pa.array(offset, pa.int64())})

    return dealt.groupBy("group").applyInArrow(run, PIECES + ", sequence_id bigint, offset bigint")


def sequences(packed: DataFrame, pad_id: int, capacity: int = CAPACITY) -> DataFrame:
    """Whole sequences: sequence_id, ``ids`` (binary) and ``length`` before padding.

    A sequence is padded to the capacity unless its length is a power of two.
    """
    pad = F.unhex(F.lit(int(pad_id).to_bytes(4, "little").hex()))
    joined = packed.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"),
        F.sum("length").alias("length"))
    power = F.bit_count("length") == 1
    padding = F.when(power, F.lit(0)).otherwise(capacity - F.col("length")).cast("int")
    return joined.select("sequence_id", "length", F.concat(
        F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["ids"])), "")),
        F.unhex(F.repeat(F.hex(pad), padding))).alias("ids"))


def crc(packed: DataFrame) -> DataFrame:
    """The pieces with the checksum of their ids in place of the ids."""
    return packed.withColumn("ids_crc32", F.crc32("ids")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
