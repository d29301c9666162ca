"""Token ids in length-delimited binary records, with an offset index for shuffled reads.

A shard is one file of records in ascending order of doc_id, shards are in order of their names.
All numbers are little-endian:

    u64 length of the payload | u32 masked CRC-32 of these 8 bytes
    payload: u8 flags (1: the id is null) | i64 doc_id | the ids, 16 bits each
    u32 masked CRC-32 of the payload | one closing byte 0x0A

A mask (rotation and a constant) keeps a checksum of data that holds checksums from being weak.
Spark's text writer writes the frames byte by byte, with its commit protocol: a lost or repeated
task leaves no partial shard, and any file system that Spark reaches will do. The index is a
Parquet table beside the shards, made by reading them back.

Edge cases: null and empty texts hold the end id alone; null ids come first; rows of equal id are
ordered by a hash of the text and the text, repeated rows are all kept and may lie in several
shards; an empty table gives no records. A damaged record raises ``ValueError``.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.llm import tokens
from tidewatch.llm.common import byte_texts, text_slices

SHARD_BYTES = 24 << 20  # of text
END_ID = 2
HEAD, OWN, FOOT = "<QI", "<Bq", "<I"
CLOSE = b"\n"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes) -> bytes:
    """A record without its closing byte, which the writer adds."""
    payload = struct.pack(OWN, doc_id is None, doc_id or 0) + ids
    size = struct.pack("<Q", len(payload))
    return size + struct.pack(FOOT, masked(size)) + payload + struct.pack(FOOT, masked(payload))


def unframe(data: bytes | memoryview, at: int) -> tuple[int | None, np.ndarray, int]:
    """The record at an offset: id, token ids, offset of the next record."""
    head = bytes(data[at:at + struct.calcsize(HEAD)])
    if len(head) < struct.calcsize(HEAD) or masked(head[:8]) != struct.unpack(HEAD, head)[1]:
        raise ValueError(f"damaged length at byte {at}")
    size, start = struct.unpack(HEAD, head)[0], at + struct.calcsize(HEAD)
    payload, end = bytes(data[start:start + size]), start + size + struct.calcsize(FOOT)
    if (len(payload) < size or bytes(data[start + size:end]) != struct.pack(FOOT, masked(payload))
            or bytes(data[end:end + 1]) != CLOSE):
        raise ValueError(f"damaged record at byte {at}")
    null, doc_id = struct.unpack_from(OWN, payload)
    return None if null else doc_id, np.frombuffer(payload, "<u2", offset=struct.calcsize(OWN)), end + 1


def write(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID,
          shard_bytes: int = SHARD_BYTES) -> None:
    """Encode ``text`` of each row, write shards to ``folder``/shards and the index beside them."""
    path = path or tokens.default_path()
    plain = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"),
                        F.coalesce(docs["text"], F.lit("")).alias("text"))
    total = plain.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    # Texts are dealt out, not ids: dealing by range looks at its input twice.
    # The salt parts equal rows, of which there may be more than a shard can hold.
    keys = ["doc_id", F.xxhash64("text")]
    ordered = plain.withColumn("salt", F.monotonically_increasing_id()).repartitionByRange(
        max(1, -(-total // shard_bytes)), *keys, "salt").sortWithinPartitions(*keys, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u2").tobytes()
        for batch in batches:
            for part in text_slices(batch, size=tokens.SLICE):
                found = tokens.encoder(path).encode(byte_texts(part["text"]))
                yield pa.record_batch({"frame": pa.array(
                    [frame(i, ids + end) for i, ids in zip(
                        part["doc_id"].to_pylist(), found, strict=True)], pa.binary())})

    frames = ordered.mapInArrow(run, "frame binary")
    frames.select(F.col("frame").cast("string")).write.option("lineSep", CLOSE.decode()).option(
        "compression", "none").text(f"{folder}/shards")
    _index(docs.sparkSession, folder).write.parquet(f"{folder}/index")


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """Shards as (shard, content); a task holds one shard or several small ones."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(
        f"{folder}/shards").select(
        F.element_at(F.split("path", "/"), -1).alias("shard"), "content")


def _index(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record: shard, offset, doc_id, tokens, checksum, tokens before it in the shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                data, at, before = memoryview(batch["content"][row].as_buffer()), 0, 0
                rows: list[tuple] = []
                while at < len(data):
                    doc_id, ids, after = unframe(data, at)
                    rows.append((at, doc_id, len(ids), before, zlib.crc32(ids.astype("<u4").tobytes())))
                    at, before = after, before + len(ids)
                columns = list(zip(*rows, strict=True)) or [()] * 5
                yield pa.record_batch({
                    "shard": pa.array([batch["shard"][row].as_py()] * len(rows), pa.string())} | {
                    name: pa.array(column, pa.int64()) for name, column in zip(
                        ("offset", "doc_id", "n_tokens", "before", "ids_crc32"), columns, strict=True)})

    return _files(spark, folder).mapInArrow(
        run, "shard string, offset bigint, doc_id bigint, n_tokens bigint, before bigint, ids_crc32 bigint")


def index(spark: SparkSession, folder: str) -> DataFrame:
    """The index with ``start``: the ids of all records before, over all shards."""
    rows = spark.read.parquet(f"{folder}/index")
    sums = rows.groupBy("shard").agg(F.sum("n_tokens").alias("size"))  # a row per shard
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sums.select("shard", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("first"))
    return rows.join(firsts, "shard").select(
        "doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32",
        "shard", "offset")


def shuffled(spark: SparkSession, folder: str, seed: int = 0) -> DataFrame:
    """Records in a seeded order: ``place`` (hash of shard, offset and seed), ``doc_id``, ``ids``.

    A task gets a shard and its index rows, reads each record at its offset and checks it; the
    records are then dealt out and sorted by place.
    """
    places = spark.read.parquet(f"{folder}/index").select(
        "shard", "offset", F.xxhash64("shard", "offset", F.lit(seed)).alias("place"))

    def pick(files: pa.Table, rows: pa.Table) -> pa.Table:
        data = memoryview(files["content"][0].as_buffer())
        found = [unframe(data, at)[:2] for at in rows["offset"].to_pylist()]
        return pa.table({
            "place": rows["place"], "doc_id": pa.array([i for i, _ in found], pa.int64()),
            "ids": pa.array([ids.astype(np.int32) for _, ids in found], pa.list_(pa.int32()))})

    picked = _files(spark, folder).groupBy("shard").cogroup(places.groupBy("shard")).applyInArrow(
        pick, "place bigint, doc_id bigint, ids array<int>")
    return picked.repartitionByRange("place").sortWithinPartitions("place")
