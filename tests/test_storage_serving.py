"""Stored tables, routing, serving queries."""

import datetime
import json
import time

import pytest
from pyspark.sql import functions as F

from tidewatch.plans import serving
from tidewatch.schemas import AGGREGATE, ALERT, AGGREGATE_TABLE, ALERT_TABLE
from tidewatch.sinks import tables, topics
from tidewatch.sources.topics import folder_stream
from tidewatch.streaming import monitor

DAY = 86400.0


def aggregate(brand, start, volume, **more):
    row = {"brand": brand, "window_start": start, "window_end": start + 120, "volume": volume, "neg_count": 1,
           "neg_ratio": 0.1, "avg_neg_prob": 0.2, "unique_authors": 1, "influencer_neg": None, "sample_text": "x"}
    return {**row, **more}


def alert(brand, end, **more):
    row = {"brand": brand, "triggered_at": end, "window_start": end - 120, "window_end": end, "z_score": 3.126,
           "neg_ratio": 0.5, "volume": 30, "severity": "medium", "sample_text": None}
    return {**row, **more}


def aggregates(spark, *rows):
    return spark.createDataFrame(list(rows), AGGREGATE)


def alerts(spark, *rows):
    return spark.createDataFrame(list(rows), ALERT)


def test_upsert_last_write_wins(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_aggregates(aggregates(spark, aggregate("a", 0.0, 1), aggregate("b", DAY, 2)), path, 0)
    tables.write_aggregates(aggregates(spark, aggregate("a", 0.0, 5), aggregate("a", 60.0, 6)), path, 1)
    for _ in range(2):  # the same batch again changes nothing
        tables.write_aggregates(aggregates(spark, aggregate("a", 60.0, 7)), path, 2)
    got = tables.read_aggregates(spark, path)
    assert got.drop("window_date").schema.simpleString() == AGGREGATE_TABLE.simpleString()
    assert sorted((r["brand"], r["window_start"].timestamp(), r["volume"]) for r in got.collect()) == [
        ("a", 0.0, 5), ("a", 60.0, 7), ("b", DAY, 2)]
    assert got.where("influencer_neg = 0").count() == 3
    compact = str(tmp_path / "compact")
    tables.compact_aggregates(spark, path, compact)
    assert tables.read_aggregates(spark, compact).exceptAll(got).isEmpty()
    assert spark.read.parquet(compact).count() == 3


def test_writers_leave_each_other_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_aggregates(aggregates(spark, aggregate("a", 0.0, 1), aggregate("c", 0.0, 4)), path, 0, writer="x")
    tables.write_aggregates(aggregates(spark, aggregate("b", 0.0, 2), aggregate("c", 0.0, 3)), path, 0, writer="y")
    got = tables.read_aggregates(spark, path).collect()
    assert sorted((r["brand"], r["volume"]) for r in got) == [("a", 1), ("b", 2), ("c", 3)]
    big = aggregates(spark, aggregate("a", 0.0, 5_000_000_000))
    tables.write_aggregates(big, path, 1, writer="y")
    assert tables.read_aggregates(spark, path).where("brand = 'a'").first()["volume"] == 5_000_000_000
    tables.write_alerts(alerts(spark, alert("a", 1000.0)), path + "a", 0, "x")
    tables.write_alerts(alerts(spark, alert("b", 1000.0)), path + "a", 0, "y")
    assert tables.read_alerts(spark, path + "a").count() == 2


def test_every_record_ends_in_one_place(spark, tmp_path):
    root = str(tmp_path / "out")
    lines = [json.dumps(aggregate("a", 0.0, 9)), json.dumps(aggregate("a", 0.0, 3)),
             json.dumps(aggregate("b", 0.0, "abc")), json.dumps(aggregate("c", 0.0, "7")),
             "not json", "[1]", "null",
             json.dumps(aggregate("d", 0.0, 1, window_start="soon")), json.dumps(aggregate("e", 0.0, 2.0)), '{"brand": "f"}']
    records = spark.createDataFrame([("agg", v) for v in lines], "topic string, value string").coalesce(1)
    tables.persist_batch(records, "agg", root, 0)
    stored = {r["brand"]: r["volume"] for r in tables.read_aggregates(spark, f"{root}/aggregates").collect()}
    rejected = [r["record"] for r in spark.read.json(f"{root}/rejected").collect()]
    assert stored == {"a": 3, "c": 7, "e": 2}  # of two revisions in a file the last one counts
    assert sorted(rejected) == sorted(lines[i] for i in (2, 4, 5, 6, 7, 9))


def test_revisions_inside_a_batch(spark, tmp_path):
    rows = [aggregate("a", 0.0, v) for v in (3, 9, 4)]
    df = aggregates(spark, *rows).withColumn("offset", F.col("volume") % 8)
    tables.write_aggregates(df, str(tmp_path / "t"), 0, "offset")
    assert tables.read_aggregates(spark, str(tmp_path / "t")).first()["volume"] == 4


def test_day_and_brand_reach_the_files(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_aggregates(aggregates(spark, *[aggregate("a", d * DAY, 1) for d in range(5)]), path, 0)
    got = serving.series(tables.read_aggregates(spark, path), "a", 60, datetime.datetime(1970, 1, 4))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(window_date" in plan and "EqualTo(brand,a)" in plan


def test_alerts_are_appended_once(spark, tmp_path):
    path = str(tmp_path / "t")
    both = alerts(spark, alert("a", 1000.0), alert("a", 2000.0, sample_text="s"))
    for batch in (0, 0, 1):
        tables.write_alerts(both, path, batch)
    got = tables.read_alerts(spark, path)
    assert got.drop("triggered_date").schema.simpleString() == ALERT_TABLE.simpleString()
    assert got.count() == 2 and got.select("id").distinct().count() == 2


def test_routing(spark):
    records = spark.createDataFrame([("agg", 1), ("alert", 2), ("other", 3)], "topic string, n int")
    first, rest = tables.route(records, "agg")
    assert [r["n"] for r in first.collect()] == [1] and [r["n"] for r in rest.collect()] == [2, 3]


def test_persister_with_dead_letters(spark, tmp_path):
    def lines(folder, name, *records):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_text(
            "\n".join(r if isinstance(r, str) else json.dumps(r) for r in records) + "\n")

    def drain():
        raw = folder_stream(spark, {"agg": str(tmp_path / "agg"), "alerts": str(tmp_path / "alert")})
        monitor.start_persister(raw, "agg", root, drain=True).awaitTermination()

    root = str(tmp_path / "out")
    lines("agg", "0.jsonl", aggregate("a", 0.0, 1), aggregate("a", 60.0, None), aggregate("b", 60.0, 0), "{oops")
    lines("alert", "0.jsonl", alert("a", 1000.0), alert("a", 2000.0, severity="huge"), "[1]")
    time.sleep(0.02)
    lines("agg", "1.jsonl", aggregate("a", 0.0, 8, influencer_neg=1.5))
    drain()
    lines("agg", "2.jsonl", aggregate("a", 120.0, 3))
    lines("alert", "2.jsonl", alert("a", 1000.0))
    drain()
    rejected = {(r["topic"], tuple(r["violations"])) for r in spark.read.json(f"{root}/rejected").collect()}
    assert rejected == {
        ("agg", ("volume is required",)), ("agg", ("volume is at least 1",)),
        ("agg", ("record is a JSON object",)), ("alerts", ("record is a JSON object",)),
        ("alerts", ("severity is one of low, medium, high, critical",))}
    assert tables.read_alerts(spark, f"{root}/alerts").count() == 1
    writers = {r["writer"] for r in spark.read.parquet(f"{root}/aggregates").select("writer").collect()}
    assert len(writers) == 1 and "batch" not in writers  # the id of the query, also after a restart
    stored = tables.read_aggregates(spark, f"{root}/aggregates")
    assert sorted((r["window_start"].timestamp(), r["volume"], r["influencer_neg"]) for r in stored.collect()) == [
        (0.0, 8, 1.5), (120.0, 3, 0.0)]


def test_routed_messages(spark, tmp_path):
    df = spark.createDataFrame(
        [("1", "submission", "a", None), ("2", "comment", "b", 5)], "id string, type string, brand string, score int")
    sent = topics.routed(df, "posts", "turns")
    assert [(r["topic"], r["key"], json.loads(r["value"])) for r in sent.orderBy("key").collect()] == [
        ("posts", "a", {"id": "1", "type": "submission", "brand": "a", "score": None}),
        ("turns", "b", {"id": "2", "type": "comment", "brand": "b", "score": 5})]
    topics.write_routed(sent, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).groupBy("topic").count().count() == 2
    assert json.loads(topics.as_values(df.where("id = '2'")).first()["value"])["score"] == 5
    options = topics.kafka_options("h:1", "t")
    assert options["topic"] == "t" and options["kafka.compression.type"] == "lz4"


def test_serving(spark):
    stored = tables.aggregate_rows(aggregates(
        spark, *[aggregate(b, m * 60.0, m + 1) for b in "ba" for m in range(10)]))
    assert [r[0] for r in serving.brands(stored).collect()] == ["a", "b"]
    as_of = datetime.datetime(1970, 1, 1, 0, 9)
    got = serving.series(stored, "a", 3, as_of)
    assert got.columns == list(serving.SERIES) and [r["volume"] for r in got.collect()] == [7, 8, 9, 10]
    assert serving.window_count(got).first()[0] == 4
    assert serving.trend(got).where("measure = 'neg_count' and chart = 'counts'").count() == 4
    assert serving.series(stored, "a").isEmpty()  # now is long after
    assert serving.series(stored, "a", 100_000, as_of).count() == 10
    with pytest.raises(ValueError):
        serving.series(stored, "a", 0)


def test_alert_queries(spark):
    stored = tables.alert_rows(alerts(spark, *[
        alert("a", 3600.0 + i, severity=s, z_score=z) for i, (s, z) in enumerate(
            [("low", 1.125), ("critical", 7.0), ("odd", 2.675), ("high", 5.0), ("medium", 3.126)] * 3)]))
    as_of = datetime.datetime(1970, 1, 1, 2, 0, 4)
    assert serving.alerts(stored, limit=4).count() == 4
    active = serving.alerts(stored, active=True, as_of=as_of)
    assert [r["triggered_at"].timestamp() for r in active.collect()] == [3600.0 + i for i in range(14, 3, -1)]
    lines = [r["headline"] for r in serving.headlines(active).collect()]
    assert len(lines) == 10
    assert lines[0] == "🟠 **a** — z=3.13, neg_ratio=0.50, volume=30"
    assert lines[2].startswith("⚠️ ") and "z=2.67" in lines[2]  # the 32-bit value lies below the tie
    assert lines[4].startswith("🟡 ") and "z=1.12" in lines[4]  # an exact tie goes to the even digit
    assert serving.recent_alerts(active).columns == list(serving.RECENT)
    many = stored.crossJoin(spark.range(200).select(F.col("id").alias("n"))).drop("n")
    assert serving.alerts(many, active=True, as_of=as_of).count() == 11 * 200
    with pytest.raises(ValueError):
        serving.alerts(stored, limit=0)


def test_serving_reads_few_days_of_the_stored_table(spark, tmp_path):
    """Filters on the day reach the files, below the choice of the last write."""
    rows = spark.range(40).select(
        F.lit("ferry").alias("brand"), F.timestamp_seconds(F.col("id") * 43200).alias("window_start"),
        F.timestamp_seconds(F.col("id") * 43200 + 300).alias("window_end"), F.col("id").alias("volume"),
        F.lit(1).alias("neg_count"), F.lit(0.5).alias("neg_ratio"), F.lit(0.5).alias("avg_neg_prob"),
        F.lit(1).alias("unique_authors"), F.lit(0.0).alias("influencer_neg"))
    tables.write_aggregates(rows, str(tmp_path), 0)
    found = serving.series(tables.read_aggregates(spark, str(tmp_path)), "ferry", minutes=1440, as_of="1970-01-10 00:00:00")
    plan = found._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("PartitionFilters"):]
    assert "window_date" in scan.split("]")[0] and "EqualTo(brand,ferry)" in scan
    assert found.count() == 24 and "window_date" not in found.columns
