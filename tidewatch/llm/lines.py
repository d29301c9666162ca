"""Line de-duplication over documents that come and go: sharded cuckoo filters, exact counts.

A line's key is the line stripped of white space at both ends, A to Z in lower case. A key of at
least ``MIN_POINTS`` code points that ``MIN_DOCUMENTS`` documents hold is common: it stays in the
largest doc_id that holds it, with all its lines there, and goes from all other documents.

``Store`` remembers the documents taken in, as tables in the shared folder:

* ``refs``: one row per document and distinct key, by digests;
* ``counts``: one row per key: its documents and the largest doc_id, exact;
* ``filters``: one row per shard of keys: a cuckoo filter of the common keys of the shard.

``insert`` adds references and counts, and puts the keys that become common into the filters;
``delete`` takes the references of documents out, counts their keys anew and takes the keys that
are no longer common out of the filters, so that all is as if these documents had never come. A
filter that cannot take a key is built anew from the exact counts of its shard. ``clean`` asks the
filter of a line's shard first. What passes is looked up in the exact counts, so false positives
of a filter change nothing, and keys in a filter are never missed.

A shard that holds a hot key has most references. They are dealt to as many lanes as they need,
each with a copy of the shard's filter.

Edge cases: null and empty texts are one empty line; a row is a document, so repeated rows count
as often as they occur, and rows of equal doc_id stay or go alike; null doc_ids are smaller than
all others; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import byte_texts, stage_table, text_slices

MIN_POINTS = 20
MIN_DOCUMENTS = 3
SHARDS = 128
#: References that meet a filter at once, at most.
LANE_ROWS = 200_000
SLOTS = 4
LOAD = 0.8
KICKS = 200
_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_FOLLOWING = bytes(range(0x80, 0xC0))  # bytes that begin no code point
REFS = "row binary, doc_id bigint, key binary, shard int"
FILTERS = "shard int, slots binary, full boolean"


# Keys


def line_key(line: bytes) -> bytes:
    """The key of a line, empty if it is too short to be common."""
    key = line.strip(_SPACE)
    if len(key) < MIN_POINTS or len(key.translate(None, _FOLLOWING)) < MIN_POINTS:
        return b""
    return key.translate(_LOWER)


def _digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _row_id(docs: DataFrame) -> Column:
    """Rows of one id and text share their fate, so a digest of both names a row."""
    text = F.coalesce(docs["text"], F.lit(""))
    return F.unhex(F.md5(F.concat_ws(":", docs["doc_id"].cast("string"), text).cast("binary")))


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"],
                       _row_id(docs).alias("row"))


def references(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The distinct keys of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                at, keys = [], []
                for place, text in enumerate(byte_texts(part["text"])):
                    own = {k for k in map(line_key, text.split(b"\n")) if k}
                    keys += map(_digest, own)
                    at += [place] * len(own)
                where = pa.array(at, pa.int32())
                first = np.frombuffer(b"".join(keys), "<u4")[::4]
                yield pa.record_batch({
                    "row": part["row"].take(where), "doc_id": part["doc_id"].take(where),
                    "key": pa.array(keys, pa.binary()),
                    "shard": pa.array((first % shards).astype(np.int32))})

    return _plain(docs).mapInArrow(run, REFS)


# Filters


class CuckooFilter:
    """Fingerprints of 16 bits in buckets of four slots; a key has two buckets to lie in.

    0 marks a free slot. The second bucket follows from the first and the fingerprint, so a
    fingerprint can be moved without its key. A key put in twice lies there twice.
    """

    def __init__(self, slots: np.ndarray):
        self.slots = slots.reshape(-1, SLOTS)

    @classmethod
    def of_size(cls, keys: int) -> CuckooFilter:
        buckets = 1 << max(1, int(np.ceil(np.log2(max(1, keys) / (SLOTS * LOAD)))))
        return cls(np.zeros(buckets * SLOTS, np.uint16))

    def places(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint and both buckets of digests."""
        words = np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)
        print_ = (words[:, 1] & 0xFFFF).astype(np.uint16)
        print_[print_ == 0] = 1
        first = (words[:, 1] >> 16).astype(np.int64) & (len(self.slots) - 1)
        return print_, first, self._other(first, print_)

    def _other(self, bucket, print_):
        return bucket ^ ((np.int64(print_) if np.isscalar(print_) else print_.astype(np.int64))
                         * 0x5BD1E995 & (len(self.slots) - 1))

    def insert(self, keys: list[bytes]) -> bool:
        """False if a key found no place; the filter must then be built anew."""
        slots, random = self.slots, np.random.default_rng(len(keys))
        for print_, a, b in zip(*self.places(keys), strict=True):
            for bucket in (a, b):
                free = np.flatnonzero(slots[bucket] == 0)
                if len(free):
                    slots[bucket, free[0]] = print_
                    break
            else:
                bucket = b
                for _ in range(KICKS):
                    slot = random.integers(SLOTS)
                    print_, slots[bucket, slot] = slots[bucket, slot], print_
                    bucket = self._other(bucket, print_)
                    free = np.flatnonzero(slots[bucket] == 0)
                    if len(free):
                        slots[bucket, free[0]] = print_
                        break
                else:
                    return False
        return True

    def delete(self, keys: list[bytes]) -> None:
        """Take out keys that were put in."""
        for print_, a, b in zip(*self.places(keys), strict=True):
            for bucket in (a, b):
                held = np.flatnonzero(self.slots[bucket] == print_)
                if len(held):
                    self.slots[bucket, held[0]] = 0
                    break

    def holds(self, keys: list[bytes]) -> np.ndarray:
        """Whether a key may be among those put in; never wrong about those that are."""
        if not keys:
            return np.zeros(0, bool)
        print_, a, b = self.places(keys)
        own = print_[:, None]
        return (self.slots[a] == own).any(axis=1) | (self.slots[b] == own).any(axis=1)


def built(keys: list[bytes]) -> CuckooFilter:
    size = len(keys)
    while True:
        made = CuckooFilter.of_size(size)
        if made.insert(keys):
            return made
        size *= 2


def _read(column: pa.ChunkedArray) -> CuckooFilter:
    return CuckooFilter(np.frombuffer(column[0].as_buffer(), np.uint16).copy())


def _row(shard: int, made: CuckooFilter, full: bool = False) -> pa.Table:
    return pa.table({"shard": pa.array([shard], pa.int32()),
                     "slots": pa.array([made.slots.tobytes()], pa.binary()), "full": [full]})


def _from_counts(table: pa.Table) -> pa.Table:
    return _row(table["shard"][0].as_py(), built(sorted(table["key"].to_pylist())))


def _changed(key: tuple, old: pa.Table, moves: pa.Table) -> pa.Table:
    """A shard's filter after keys that become common (``enters``) and cease to be."""
    enters = np.asarray(moves["enters"]) if moves.num_rows else np.zeros(0, bool)
    new = sorted(moves["key"].filter(pa.array(enters)).to_pylist())
    gone = sorted(moves["key"].filter(pa.array(~enters)).to_pylist())
    if not old.num_rows:
        return _row(key[0].as_py(), built(new))
    made = _read(old["slots"])
    made.delete(gone)
    return _row(key[0].as_py(), made, not made.insert(new))


# The store


@dataclass(frozen=True)
class Store:
    """The documents taken in so far; operations give a new store and leave the old one whole."""

    spark: SparkSession
    refs: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int = SHARDS

    @classmethod
    def empty(cls, spark: SparkSession, shards: int = SHARDS) -> Store:
        def none(form: str) -> DataFrame:
            return spark.createDataFrame([], form)

        return cls(spark, none(REFS), none("key binary, shard int, n bigint, keeper bigint"),
                   none(FILTERS), shards)

    def insert(self, docs: DataFrame) -> Store:
        """The store with these documents, too."""
        fresh = stage_table(references(docs, self.shards), "lines-refs")
        changes = _counted(fresh)
        if self._is_empty():
            counts = stage_table(changes, "lines-counts")
            moves = _common(counts).select("key", "shard", F.lit(True).alias("enters"))
            return replace(self, refs=fresh, counts=counts, filters=self._filters(counts, moves))
        both = self.counts.select("*", F.lit(0).cast("bigint").alias("more")).unionByName(
            changes.select("key", "shard", "n", "keeper", F.col("n").alias("more")))
        counts = stage_table(both.groupBy("key", "shard").agg(
            F.sum("n").alias("n"), F.max("keeper").alias("keeper"), F.sum("more").alias("more")),
            "lines-counts")
        moves = _common(counts).where(F.col("n") - F.col("more") < MIN_DOCUMENTS).select(
            "key", "shard", F.lit(True).alias("enters"))
        counts = counts.drop("more")
        return replace(self, refs=stage_table(self.refs.unionByName(fresh), "lines-refs"),
                       counts=counts, filters=self._filters(counts, moves))

    def delete(self, ids: DataFrame) -> Store:
        """The store without the documents whose ``doc_id`` stands in ``ids``."""
        ids = ids.select(ids["doc_id"].cast("bigint").alias("gone_id")).distinct()
        match = F.col("doc_id").eqNullSafe(F.col("gone_id"))
        touched = stage_table(
            self.refs.join(ids, match, "left_semi").select("key").distinct(), "lines-touched")
        refs = stage_table(self.refs.join(ids, match, "left_anti"), "lines-refs")
        before = self.counts.join(touched, "key", "left_semi")
        anew = stage_table(_counted(refs.join(touched, "key", "left_semi")), "lines-anew")
        moves = stage_table(_common(before).join(_common(anew), "key", "left_anti").select(
            "key", "shard", F.lit(False).alias("enters")), "lines-moves")
        counts = stage_table(
            self.counts.join(touched, "key", "left_anti").unionByName(anew), "lines-counts")
        return replace(self, refs=refs, counts=counts, filters=self._filters(counts, moves))

    def _is_empty(self) -> bool:
        return not self.refs.take(1)

    def _filters(self, counts: DataFrame, moves: DataFrame) -> DataFrame:
        changed = stage_table(self.filters.groupBy("shard").cogroup(moves.groupBy("shard")).applyInArrow(
            _changed, FILTERS), "lines-filters")
        full = changed.where("full").select("shard")
        if not full.take(1):
            return changed
        anew = _common(counts).join(F.broadcast(full), "shard", "left_semi").groupBy(
            "shard").applyInArrow(_from_counts, FILTERS)
        return stage_table(changed.where("not full").unionByName(anew), "lines-filters")

    def dropped(self, refs: DataFrame) -> DataFrame:
        """Of the given references those whose lines go: ``row`` and ``key``."""
        sizes = refs.groupBy("shard").agg(F.count("*").alias("rows"))
        total = refs.count()
        target = max(1, min(LANE_ROWS, total // (4 * self.shards)))
        # One row per shard.
        lanes = stage_table(sizes.select("shard", F.ceil(F.col("rows") / target).alias("lanes")),
                            "lines-lanes")
        dealt = refs.join(F.broadcast(lanes), "shard").withColumn(
            "lane", F.pmod(F.xxhash64("row", "key"), F.col("lanes")).cast("int")).drop("lanes")
        copies = self.filters.join(F.broadcast(lanes), "shard").select(
            "shard", "slots", F.explode(F.sequence(F.lit(0), F.col("lanes").cast("int") - 1)).alias("lane"))

        def probe(own: pa.Table, made: pa.Table) -> pa.Table:
            if own.num_rows and made.num_rows:
                own = own.filter(pa.array(_read(made["slots"]).holds(own["key"].to_pylist())))
            else:
                own = own.slice(0, 0)
            return own.select(["row", "doc_id", "key"])

        found = dealt.groupBy("shard", "lane").cogroup(copies.groupBy("shard", "lane")).applyInArrow(
            probe, "row binary, doc_id bigint, key binary")
        sure = found.join(_common(self.counts).select("key", "keeper"), "key")
        return sure.where(~F.col("doc_id").eqNullSafe(F.col("keeper"))).select("row", "key")

    def clean(self, docs: DataFrame, refs: DataFrame | None = None) -> DataFrame:
        """doc_id, ``kept`` (the lines that stay, joined), n_lines and n_dropped of documents.

        ``refs`` are the references of these documents, if they are stored already.
        """
        if refs is None:
            refs = stage_table(references(docs, self.shards), "lines-refs")
        # A document's keys are no more than its own lines. Stored, so that Spark can split the
        # join where one row is repeated many times.
        drops = stage_table(self.dropped(refs).groupBy("row").agg(
            F.collect_set("key").alias("drops")), "lines-drops")
        joined = _plain(docs).join(drops, "row", "left").select("doc_id", "text", "drops")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in text_slices(batch):
                    kept, lines, dropped = [], [], []
                    for text, drops in zip(byte_texts(part["text"]), part["drops"].to_pylist(), strict=True):
                        all_ = text.split(b"\n")
                        stay = all_
                        if drops:
                            go = set(drops)
                            stay = [x for x in all_ if not (k := line_key(x)) or _digest(k) not in go]
                        lines.append(len(all_))
                        dropped.append(len(all_) - len(stay))
                        kept.append(b"\n".join(stay))
                    yield pa.record_batch({
                        "doc_id": part["doc_id"], "kept": pa.array(kept, pa.binary()).cast(pa.string()),
                        "n_lines": pa.array(lines, pa.int64()), "n_dropped": pa.array(dropped, pa.int64())})

        return joined.mapInArrow(run, "doc_id bigint, kept string, n_lines bigint, n_dropped bigint")


def _counted(refs: DataFrame) -> DataFrame:
    return refs.groupBy("key", "shard").agg(
        F.count("*").alias("n"), F.max("doc_id").alias("keeper"))


def _common(counts: DataFrame) -> DataFrame:
    return counts.where(F.col("n") >= MIN_DOCUMENTS)


def deduplicated(docs: DataFrame) -> DataFrame:
    """Documents of a table without the lines common in it."""
    store = Store.empty(docs.sparkSession).insert(docs)
    return store.clean(docs, store.refs)
