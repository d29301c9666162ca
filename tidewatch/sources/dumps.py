"""Dump files: JSON lines, zstd-compressed JSON lines and CSV, alone or in a folder."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewatch.functions.text import strip_space
from tidewatch.operators.messages import decode
from tidewatch.schemas import DUMP
from tidewatch.session import stored

# File kinds and folders of a dump, largest zstd window, and the first of the marks
# of zstd frames that are skipped.
DUMP_KINDS = ("zst", "ndjson", "jsonl", "csv")
DUMP_FOLDERS = ("submissions", "comments")
ZSTD_WINDOW = 2**31
_SKIPPABLE = 0x184D2A50

# The largest header of a frame, and what is read of a file at once.
_HEADER_BYTES = 18
_BLOCK_BYTES = 1 << 18
# Tasks per core that the frames of zstd files are dealt to, at most.
_FRAME_TASKS = 16


def _listed(spark: SparkSession, paths: str | Sequence[str], pattern: str = "*") -> DataFrame:
    """The files at ``paths`` (files, folders or globs) that match: ``path``, and ``file`` as scans name it."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(paths).select(
        "path", F.col("_metadata.file_path").alias("file"))


def _open(path: str, seek: bool = False):
    """Open a file on any file system pyarrow knows, to read on or also to ``seek``; runs in tasks."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = re.sub("^file:/+", "/", path)
    if "://" not in path:
        local = fs.LocalFileSystem()
        return local.open_input_file(path) if seek else local.open_input_stream(path, compression=None)
    store, name = fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", path))
    return store.open_input_file(name) if seek else store.open_input_stream(name, compression=None)


def _frames(files: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The frames of zstd files: where each begins and how long it is, without unpacking any.

    Only the headers of frames and of their blocks are looked at. What the format says of them:
    a frame header's length follows from its descriptor, a block header is three bytes (last
    block, kind, size; of a repeated byte one byte is stored), a checksum is four bytes.
    """
    import zstandard

    for batch in files:
        for path in batch["path"].to_pylist():
            rows: list[tuple[int, int]] = []
            with _open(path, seek=True) as raw:
                at, end = 0, raw.size()
                while at < end:
                    raw.seek(at)
                    head = raw.read(min(_HEADER_BYTES, end - at))
                    magic = int.from_bytes(head[:4], "little")
                    if magic & ~15 == _SKIPPABLE:
                        at += 8 + int.from_bytes(head[4:8], "little")
                        continue
                    told = zstandard.get_frame_parameters(head)
                    place = at + zstandard.frame_header_size(head)
                    last = False
                    while not last:
                        raw.seek(place)
                        block = int.from_bytes(raw.read(3), "little")
                        last, kind, size = block & 1, block >> 1 & 3, block >> 3
                        place += 3 + (1 if kind == 1 else size)
                        if place > end:
                            raise ValueError(f"{path} ends within a frame")
                    place += 4 if told.has_checksum else 0
                    rows.append((at, place - at))
                    at = place
            yield pa.record_batch({
                "path": pa.array([path] * len(rows), pa.string()),
                "number": pa.array(range(len(rows)), pa.int64()),
                "offset": pa.array([r[0] for r in rows], pa.int64()),
                "size": pa.array([r[1] for r in rows], pa.int64())})


def _unpacked(raw, offset: int, size: int | None) -> Iterator[bytes]:
    """Unpacked blocks from an offset on: of ``size`` packed bytes, or of all that follows."""
    import zstandard

    unpacking = zstandard.ZstdDecompressor(max_window_size=ZSTD_WINDOW).decompressobj(
        read_across_frames=True)
    raw.seek(offset)
    while size is None or size > 0:
        block = raw.read(_BLOCK_BYTES if size is None else min(_BLOCK_BYTES, size))
        if not block:
            return
        if size is not None:
            size -= len(block)
        yield unpacking.decompress(block)


def _frame_lines(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines that begin in a frame, or right at its end; the last one is read to its end.

    A line break in a frame begins a line. So the bytes before the first one belong to the frame
    before, and what follows the last one is completed from the frames after.
    """
    for batch in frames:
        for path, number, offset, size in zip(*[batch[c].to_pylist() for c in ("path", "number", "offset", "size")]):
            with _open(path, seek=True) as raw:
                carried, begun = b"", number == 0
                for data in _unpacked(raw, offset, size):
                    *whole, carried = (carried + data).split(b"\n")
                    if whole and not begun:
                        whole, begun = whole[1:], True
                    elif not begun:
                        carried = b""
                    yield pa.record_batch({"value": pa.array(whole, pa.binary())})
                if not begun:
                    continue
                rest = [carried]
                for data in _unpacked(raw, offset + size, None):
                    head, found, _ = data.partition(b"\n")
                    rest.append(head)
                    if found:
                        break
                line = b"".join(rest)
                yield pa.record_batch({"value": pa.array([line] if line else [], pa.binary())})


def zstd_lines(spark: SparkSession, paths: str | Sequence[str], pattern: str = "*") -> DataFrame:
    """Lines of zstd files with windows of any size, as column ``value``; broken bytes are replaced.

    An index of the files' frames is made first, by a task per file that reads headers only. The
    frames are then dealt out, so a file of many frames is read by many tasks; a file of one
    frame by one, which streams.
    """
    index = stored(_listed(spark, paths, pattern).select("path").mapInArrow(
        _frames, "path string, number bigint, offset bigint, size bigint"), "frames")
    count = index.count()
    tasks = max(1, min(count, _FRAME_TASKS * spark.sparkContext.defaultParallelism))
    lines = index.repartition(tasks, "path", "number").mapInArrow(_frame_lines, "value binary")
    return lines.select(F.make_valid_utf8(F.col("value").cast("string")).alias("value"))


def _records(lines: DataFrame, schema: StructType, strict: bool) -> DataFrame:
    filled = lines.where(strip_space(F.col("value")) != "")
    if not strict:
        return decode(filled, "value", schema)
    record = F.from_json("value", schema, {"mode": "FAILFAST"})
    return filled.select(record.alias("_record")).select("_record.*")


def _named(reader, pattern: str):
    return reader.option("pathGlobFilter", pattern)


def read_json_lines(
    spark: SparkSession, paths: str | Sequence[str], schema: StructType = DUMP,
    strict: bool = False, pattern: str = "*",
) -> DataFrame:
    """JSON lines (plain or in a codec Spark reads); blank lines are skipped.

    Lines that are no JSON object are skipped too, or fail the job if ``strict``.
    """
    return _records(_named(spark.read, pattern).text(paths), schema, strict)


def read_zstd(
    spark: SparkSession, paths: str | Sequence[str], schema: StructType = DUMP,
    strict: bool = False, spread_to: int | None = None, pattern: str = "*",
) -> DataFrame:
    """JSON lines in zstd files; ``spread_to`` shares the lines out for the work that follows."""
    lines = zstd_lines(spark, paths, pattern)
    return _records(lines.repartition(spread_to) if spread_to else lines, schema, strict)


def _first_lines(paths: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in paths:
        headers = []
        for path in batch["path"]:
            with _open(path) as raw:
                line = io.TextIOWrapper(raw, encoding="utf-8-sig", newline="").readline()
                headers.append(next(csv.reader([line.rstrip("\r\n")]), []))
        yield pd.DataFrame({"file": batch["file"], "header": headers})


def read_csv(
    spark: SparkSession, paths: str | Sequence[str], multi_line: bool = True, pattern: str = "*"
) -> DataFrame:
    """CSV with a header; values may hold quoted line breaks; all-empty rows are skipped.

    Columns go by name, and files may order them differently: all files are scanned at once, by
    place, and a table of every file's header, joined to the scan, tells which place is which
    column. A row that repeats its file's header is no record. ``multi_line=False`` lets large
    files without line breaks in values be split.
    """
    headers = stored(_listed(spark, paths, pattern).mapInPandas(
        _first_lines, "file string, header array<string>"), "headers")
    width = headers.agg(F.max(F.size("header"))).first()[0] or 0
    if not width:
        return spark.createDataFrame([], DUMP)
    places = [f"place{i}" for i in range(width)]
    scan = _named(spark.read, pattern).schema(", ".join(f"{p} string" for p in places)).options(
        header=False, multiLine=multi_line, escape='"', enforceSchema=True).csv(paths)
    rows = scan.select(F.array(*places).alias("cells"), F.col("_metadata.file_path").alias("file")).join(
        headers, "file")
    own = F.slice("cells", F.lit(1), F.size("header"))
    filled = rows.where(F.exists(own, lambda c: c.isNotNull()) & ~own.eqNullSafe(F.col("header")))

    def cell(name: str) -> Column:
        return F.try_element_at("cells", F.nullif(F.array_position("header", name), F.lit(0)).cast("int"))

    return filled.select(*[cell(f.name).alias(f.name) for f in DUMP.fields])


def read_dump(spark: SparkSession, path: str, spread_to: int | None = None) -> DataFrame:
    """One dump file; its suffix tells the format, anything unknown is JSON lines."""
    suffix = path.lower().rsplit(".", 1)[-1]
    if suffix == "zst":
        return read_zstd(spark, path, spread_to=spread_to)
    return read_csv(spark, path) if suffix == "csv" else read_json_lines(spark, path)


def read_dump_folder(
    spark: SparkSession, root: str, spread_to: int | None = None,
    kinds: Sequence[str] = DUMP_KINDS,
) -> DataFrame:
    """All files of the given kinds in ``submissions`` and ``comments``, which must both hold some.

    The folder a record comes from is column ``folder``.
    """
    parts = []
    lines = [k for k in kinds if k not in ("zst", "csv")]
    for folder in DUMP_FOLDERS:
        path = f"{root}/{folder}"
        try:
            missing = _listed(spark, path, "*.{" + ",".join(kinds) + "}").isEmpty()
        except AnalysisException:
            missing = True
        if missing:
            raise FileNotFoundError(f"no dump files in {path}")
        frames = [read_json_lines(spark, path, pattern="*.{" + ",".join(lines) + "}")] if lines else []
        if "zst" in kinds:
            frames.append(read_zstd(spark, path, spread_to=spread_to, pattern="*.zst"))
        if "csv" in kinds:
            frames.append(read_csv(spark, path, pattern="*.csv"))
        parts += [f.withColumn("folder", F.lit(folder)) for f in frames]
    return reduce(DataFrame.unionByName, parts)
