"""Dump files, folders, labelled tables."""

import gzip
import json
import os

import pytest
import zstandard
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.sources import dumps, tables, topics

RECORDS = [{"id": f"r{i}", "body": f"text {i} é", "score": i, "created_utc": 100.5 + i} for i in range(20)]


def lines(records, broken=True):
    texts = [json.dumps(r, ensure_ascii=False) for r in records]
    if broken:
        texts = texts[:3] + ["", "   ", "{broken", "[1, 2]", "null"] + texts[3:]
    return ("\n".join(texts) + "\n").encode()


def pack(path, data, window_log):
    parameters = zstandard.ZstdCompressionParameters.from_level(1, window_log=window_log, enable_ldm=True)
    with open(path, "wb") as file, zstandard.ZstdCompressor(compression_params=parameters).stream_writer(file) as out:
        out.write(data)


def ids(df):
    return sorted((r["id"] for r in df.select("id").collect()), key=lambda i: int(i[1:]))


ALL = [r["id"] for r in RECORDS]


def test_json_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_bytes(lines(RECORDS))
    (tmp_path / "b.jsonl.gz").write_bytes(gzip.compress(lines(RECORDS)))
    for name in ("a.jsonl", "b.jsonl.gz"):
        df = dumps.read_json_lines(spark, str(tmp_path / name))
        assert ids(df) == ALL
    row = df.where("id = 'r3'").first()
    assert (row["body"], float(row["score"]), float(row["created_utc"])) == ("text 3 é", 3.0, 103.5)


def test_strict_lines_fail(spark, tmp_path):
    (tmp_path / "good.ndjson").write_bytes(lines(RECORDS, broken=False) + b"\n\n")
    assert ids(dumps.read_json_lines(spark, str(tmp_path / "good.ndjson"), strict=True)) == ALL
    (tmp_path / "bad.ndjson").write_bytes(lines(RECORDS))
    with pytest.raises(Exception, match="Malformed records"):
        dumps.read_json_lines(spark, str(tmp_path / "bad.ndjson"), strict=True).collect()


@pytest.mark.parametrize("window_log", [20, 27, 30])
def test_zstd_with_any_window(spark, tmp_path, window_log):
    path = tmp_path / "dump.ndjson.zst"
    pack(path, lines(RECORDS) + b'{"id": "r77", "body": "bad \xff byte"}\n', window_log)
    df = dumps.read_dump(spark, str(path), spread_to=3)
    assert ids(df) == [*ALL, "r77"]
    assert df.where("id = 'r77'").first()["body"] == "bad � byte"


def test_csv_by_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,body,score\nr1,"two\nlines, ""quoted""",5\n,,\nr2, padded ,\n')
    (tmp_path / "b.csv").write_text("score,extra,id\n7,x,r3\n\n")
    df = dumps.read_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    got = {r["id"]: (r["body"], r["score"]) for r in df.collect()}
    assert got == {"r1": ('two\nlines, "quoted"', "5"), "r2": (" padded ", None), "r3": (None, "7")}


def test_folder(spark, tmp_path):
    root = tmp_path / "dump set"
    for folder in ("submissions", "comments"):
        (root / folder).mkdir(parents=True)
    pack(root / "submissions" / "x.zst", lines(RECORDS[:5]), 28)
    (root / "submissions" / "y.jsonl").write_bytes(lines(RECORDS[5:10]))
    (root / "submissions" / "ignored.txt").write_text("{}")
    with pytest.raises(FileNotFoundError):
        dumps.read_dump_folder(spark, str(root))
    (root / "comments" / "z.csv").write_text("id,body\nr10,b\n")
    (root / "comments" / "w.ndjson").write_bytes(lines(RECORDS[11:]))
    df = dumps.read_dump_folder(spark, str(root))
    assert ids(df) == ALL
    assert df.groupBy("folder").count().orderBy("folder").collect() == [("comments", 10), ("submissions", 10)]


def test_public_corpus(spark, tmp_path):
    spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "text string, label int").write.parquet(
        str(tmp_path / "t"))
    got = tables.public_corpus(tables.read_table(spark, str(tmp_path / "t"))).orderBy("text").collect()
    assert [tuple(r) for r in got] == [("a", "neg", "public"), ("b", "neu", "public"), ("c", "pos", "public")]


def test_kafka_needs_its_connector(spark):
    with pytest.raises(PySparkException, match="(?i)kafka"):
        topics.kafka_stream(spark, "localhost:1", ["a"])


@pytest.mark.parametrize("size", [1, 7, 100, 10**6])
@pytest.mark.parametrize("end", ["", "\n"])
def test_frames_that_end_anywhere(spark, tmp_path, size, end):
    """Every line once, whatever frames cut it into; some frames hold no line break, some are skipped."""
    lines = [f"line {n} " + "x" * (n * 37 % 90) for n in range(25)] + ["", "é" * 40, "last"]
    data = ("\n".join(lines) + end).encode()
    packing = zstandard.ZstdCompressor(write_checksum=size % 2 == 1, write_content_size=size != 7)
    frames = [packing.compress(data[i:i + size]) for i in range(0, len(data), size)]
    frames.insert(len(frames) // 2, b"\x53\x2a\x4d\x18\x03\x00\x00\x00abc")
    (tmp_path / "a b.zst").write_bytes(b"".join(frames))
    (tmp_path / "b.zst").write_bytes(packing.compress(b"other\nfile"))
    (tmp_path / "empty.zst").write_bytes(b"")
    got = [r["value"] for r in dumps.zstd_lines(spark, str(tmp_path)).collect()]
    assert sorted(x for x in got if x) == sorted([*filter(None, lines), "other", "file"])


def test_a_file_of_many_frames_is_read_by_several_tasks(spark, tmp_path):
    packing = zstandard.ZstdCompressor()
    (tmp_path / "a.zst").write_bytes(b"".join(packing.compress(b"one line\n" * 50) for _ in range(40)))
    lines = dumps.zstd_lines(spark, str(tmp_path))
    counts = [r["n"] for r in lines.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(counts) == 2000 and len(counts) > 10


def test_a_file_that_ends_within_a_frame_fails(spark, tmp_path):
    (tmp_path / "cut.zst").write_bytes(zstandard.ZstdCompressor().compress(os.urandom(5000))[:-100])
    with pytest.raises(Exception, match="ends within a frame"):
        dumps.zstd_lines(spark, str(tmp_path)).collect()


def test_no_path_is_collected(spark, tmp_path, monkeypatch):
    for folder in dumps.DUMP_FOLDERS:
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "a b%20c.csv").write_text('id,body\n1,"two\nlines"\nid,body\n')
        (tmp_path / folder / "d.csv").write_text('body,extra,id\nx,y,2\n,,\n')
        (tmp_path / folder / "e.jsonl").write_text('{"id": "3", "body": "z"}\n')
    monkeypatch.setattr(DataFrame, "inputFiles", None)
    df = dumps.read_dump_folder(spark, str(tmp_path))
    monkeypatch.setattr(DataFrame, "collect", None)
    rows = df.select("folder", "id", "body").toLocalIterator()
    assert sorted(map(tuple, rows)) == sorted(
        (f, i, b) for f in dumps.DUMP_FOLDERS for i, b in (("1", "two\nlines"), ("2", "x"), ("3", "z")))
