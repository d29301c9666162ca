"""Work that must not grow with messages: calls to the state, passes over the texts, reads of a feed."""

import datetime

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewatch.catalog import inputs, queries
from tidewatch.functions import sentiment, text, words
from tidewatch.sources import topics
from tidewatch.streaming import monitor, windows

HOUR = 3_600_000


class Calls:
    """A state that counts the calls made to it, whichever variable they go to."""

    def __init__(self):
        self.count, self.timers = 0, set()

    def variable(self, *_):
        return Variable(self)

    getMapState = getListState = getValueState = variable

    def listTimers(self):
        self.count += 1
        return iter(self.timers)

    def registerTimer(self, at):
        self.count += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.count += 1
        self.timers.discard(at)


class Variable:
    def __init__(self, calls):
        self.calls, self.map, self.list, self.value = calls, {}, [], None

    def called(self):
        self.calls.count += 1

    def iterator(self):
        self.called()
        return iter([((k,), v) for k, v in self.map.items()])

    def getValue(self, key):
        self.called()
        return self.map.get(key[0])

    def updateValue(self, key, value):
        self.called()
        self.map[key[0]] = value

    def removeKey(self, key):
        self.called()
        del self.map[key[0]]

    def get(self):
        self.called()
        return self.value if self.value is not None else iter(self.list)

    def update(self, value):
        self.called()
        self.value = value

    def appendList(self, values):
        self.called()
        self.list += values

    def clear(self):
        self.called()
        self.map, self.list, self.value = {}, [], None


class Counts(Variable):
    def get(self):
        self.called()
        return self.value


class Now:
    def __init__(self, at):
        self.at = at

    def getCurrentWatermarkInMs(self):
        return self.at

    getExpiryTimeInMs = getCurrentWatermarkInMs


def processor():
    calls = Calls()
    calls.getValueState = lambda *_: Counts(calls)
    made = windows.WindowProcessor(4 * HOUR, HOUR)
    made.init(calls)
    return made, calls


def frame(authors, panes):
    n = len(authors)
    return pd.DataFrame({
        "pane": np.array(panes, dtype="int64"), "author": authors, "volume": 1, "neg": 0, "prob": 0, "reach": 0,
        "worst": pd.Series([np.nan] * n), "at": pd.Series([np.nan] * n), "id": None, "text": None})


def calls_with(authors):
    made, calls = processor()
    names = [f"u{n}" for n in range(authors)]
    for hour in range(3):
        list(made.handleInputRows(("b", 0), iter([frame(names, [(100 + hour) * HOUR] * authors)]), Now(0)))
    list(made.handleExpiredTimer(("b", 0), Now(200 * HOUR), Now(200 * HOUR)))
    return calls.count


def test_calls_to_the_state_do_not_grow_with_authors():
    assert calls_with(500) == calls_with(5)


def test_many_windows_close_in_one_call_and_leave_nothing():
    made, calls = processor()
    rows = frame(["a", "b", "a", ""], [100 * HOUR, 101 * HOUR, 103 * HOUR, 109 * HOUR])
    assert list(made.handleInputRows(("b", 0), iter([rows]), Now(0))) == [] and calls.timers == {101 * HOUR}
    closed = pd.concat(made.handleExpiredTimer(("b", 0), Now(106 * HOUR), Now(101 * HOUR)))
    assert closed["volume"].tolist() == [1, 2, 2, 3, 2, 1] and closed["authors"].tolist() == [1, 2, 2, 2, 2, 1]
    assert calls.timers == {107 * HOUR}
    # One window of these two has ended; the others get the message, and "a" counts once in them.
    late = pd.concat(made.handleInputRows(("b", 0), iter([frame(["a"], [104 * HOUR])]), Now(107 * HOUR)))
    assert late["volume"].tolist() == [1] and late["authors"].tolist() == [1]
    rest = pd.concat(made.handleExpiredTimer(("b", 0), Now(200 * HOUR), Now(108 * HOUR)))
    assert rest["volume"].tolist() == [1, 1, 1, 1, 1] and rest["authors"].tolist() == [1, 0, 0, 0, 0]
    assert not calls.timers and not made._panes.map and not made._authors.list and made._counts.value is None


def messages_of(spark):
    return spark.createDataFrame(
        [("1", "b", "u", "fine text", 3, "neg", 0.5, datetime.datetime(2024, 1, 1))],
        "id string, brand string, author string, text string, score int, label string, neg_prob double,"
        " event_time timestamp")


def test_late_rows_are_found_without_texts_and_scores(spark):
    found = windows.late_rows(messages_of(spark), 120, 60)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    rows = plan[plan.index("TransformWithState"):plan.index("LogicalRDD") if "LogicalRDD" in plan else None]
    assert "neg_prob" not in rows and "text" not in rows.replace("TransformWithState", "")


@pytest.fixture
def tables(spark, tmp_path):
    """Events over twelve days, one without a time, and documents; a few rows each."""
    begin = datetime.datetime(2024, 1, 14)
    events = [(n, begin + datetime.timedelta(hours=n) if n else None, n % 7, ("view", "click")[n % 2], float(n), "{}")
              for n in range(288)]
    spark.createDataFrame(
        events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    ).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    texts = [(n, ("the idiot erin la thon", "la thon is very erin", "not stupid at all")[n % 3]) for n in range(6)]
    spark.createDataFrame(texts, "doc_id long, text string").coalesce(1).write.parquet(
        str(tmp_path / "documents.parquet"))
    return str(tmp_path)


@pytest.mark.parametrize("name", ["upsert_aggregates", "persisted_records"])
def test_texts_are_scored_once(spark, tables, monkeypatch, name):
    plain, passes = inputs.score_messages, []
    monkeypatch.setattr(inputs, "score_messages", lambda *a: passes.append(1) or plain(*a))
    assert queries.queries()[name](spark, tables).count() > 0 and len(passes) == 1


def test_a_part_of_a_feed_is_read_without_the_others(spark, tables, tmp_path):
    delivered, parts = inputs.feed_parts(spark, tables)
    stored = inputs.by_part(spark, delivered)
    inputs.feed(spark, stored, str(tmp_path / "feed"), range(parts))
    fed = spark.read.parquet(*[str(tmp_path / f"feed/{part:06d}") for part in range(parts)])
    assert parts == 4 and fed.count() == 287 and fed.schema == inputs.table(spark, tables, "events").schema
    plan = stored.where("part = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan


def raw_records(spark):
    return spark.createDataFrame([("t", "{}", 1)], "topic string, value string, version long").withColumn(
        "timestamp", F.lit("2024-01-01").cast("timestamp"))


@pytest.mark.parametrize("read", [lambda raw: topics.message_stream(raw, inputs.DETECTION), topics.rejected_messages])
def test_a_record_is_parsed_once(spark, read):
    plan = read(raw_records(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_the_monitor_aggregates_windows_once(spark, tmp_path, monkeypatch):
    plain, made, started = monitor.aggregate_stream, [], []
    monkeypatch.setattr(monitor, "aggregate_stream", lambda *a: made.append(1) or plain(*a))
    monkeypatch.setattr(monitor, "run", lambda stream, checkpoint, **_: started.append(checkpoint.rsplit("/")[-1]))
    for folder in ("raw", "out/scored", "out/windows"):
        (tmp_path / folder).mkdir(parents=True)
    raw = topics.folder_stream(spark, {"raw": str(tmp_path / "raw")})
    monitor.start_monitor(spark, raw, str(tmp_path / "out"), inputs.DETECTION, inputs.SCORER)
    assert len(made) == 1 and started == ["scored", "rejected", "windows", "aggregates", "alerts"]


def test_words_are_split_and_looked_up_in_arrow(spark):
    df = sentiment.with_polarity(spark.createDataFrame([("fine",)], "text string"), "text", inputs.LEXICON)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "split(" not in plan


def plainly(texts, scored, whole, turns, marks):
    """What ``look_at`` gives, word by word."""
    out = []
    for value in texts:
        own = [w for w in value.split() if len(w) > 1]
        low = [w.lower() for w in own]
        hits = [{"at": i, "word": own[i]} | {n: own[i + d] if 0 <= i + d < len(own) else None
                                            for n, d in words.AROUND.items()}
                for i, w in enumerate(low) if w.strip(marks) in scored or w in whole]
        out.append({"words": len(own), "loud": sum(w == w.upper() and w != w.lower() for w in own),
                    "turn": next((i + 1 for i, w in enumerate(low) if w in turns), 0), "found": hits})
    return out


ODD = [
    "", " ", "x", "BAD", "so BAD!! but 'bad' x ok But!! \u3000bad\xa0:-( the end.", "\u0130YI \u039b\u039f\u0393\u039f\u03a3 \u03bb\u03cc\u03b3\u03bf\u03c2", "STRASSE O\ufb01CE A\xdf STRA\xdfE \u0149A \U0001f600 12 A1",
    "bad\x1cbad\x85bad\u2028bad " * 5, "but bad", "worse bad"]


@pytest.mark.parametrize("size", [1, 40, 4 << 20])
def test_words_found_in_slices_are_those_found_one_by_one(monkeypatch, size):
    monkeypatch.setattr(words, "SLICE_BYTES", size)
    looked = {"bad", "i\u0307yi", "\u03bb\u03bf\u03b3\u03bf\u03c2"}, {":-("}, {"but", "but!!"}, "!':-(."
    parts = list(words._slices(pa.array(ODD)))
    got = [row for part in parts for row in words.look_at(part, *looked).to_pylist()]
    assert got == plainly(ODD, *looked) and (len(parts) > 3) == (size < 100)
    assert words.look_at(pa.array([], pa.string()), *looked).to_pylist() == []


def test_scores_of_odd_texts(spark):
    """Nulls, invalid UTF-8 and texts without words are scored too."""
    rows = spark.createDataFrame([(None,), ("",), ("a b",), ("idiot",)], "text string").unionByName(
        spark.sql("SELECT CAST(X'69646F7420FF2069646F74' AS STRING) AS text"))
    got = [r[0] for r in sentiment.with_polarity(rows, "text", inputs.LEXICON).select("polarity.compound").collect()]
    assert got[:3] == [0.0, 0.0, 0.0] and got[3] < 0 and len(got) == 5


def test_cleaning_in_one_pass_gives_what_its_steps_give(one):
    odd = [" **  _ a\u3000b http://x_y*z **http://q  > ~` \tx   _ * ", "a b", "a  b", "*", " ", "", None, "a*b_c", "a\x85 b",
           "https:// x", "ahttp://b c", "http*://x", "end ", "\n", "~a~", "x\xa0y", "a \u2003 b*"]
    steps = one(lambda c: text.collapse_space(text.drop_markdown(F.regexp_replace(c, text.LINK, " "))), odd)
    assert one(text.clean, odd) == steps


def test_records_are_kept_compressed_in_bounded_files(spark, tmp_path, monkeypatch):
    """Whole texts go to disk twice, as raw and as scored records."""
    import pyarrow.parquet as pq

    from tidewatch.sinks import topics
    from tidewatch.sources.topics import folder_stream

    monkeypatch.setattr(topics, "FILE_RECORDS", 40, raising=False)
    sent = spark.range(100).selectExpr(
        "CASE id % 2 WHEN 0 THEN 'a' ELSE 'b' END AS topic", "concat(id, repeat(' some words', 200)) AS value")
    topics.write_routed(sent.coalesce(1), str(tmp_path / "raw"))
    files = list(tmp_path.glob("raw/topic=*/part-*"))
    assert len(files) == 4 and sum(f.stat().st_size for f in files) < 100 * 2200 / 5
    read = folder_stream(spark, {t: str(tmp_path / f"raw/topic={t}") for t in "ab"}).select("topic", "value")
    monitor.run(read, str(tmp_path / "checkpoint"), path=str(tmp_path / "rows"), drain=True).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "rows")).exceptAll(sent).count() == 0
    assert spark.read.parquet(str(tmp_path / "rows")).count() == 100
    codecs = {pq.ParquetFile(f).metadata.row_group(0).column(1).compression for f in tmp_path.glob("rows/*.parquet")}
    assert codecs == {"ZSTD"}


def test_states_have_one_partition_per_core_at_most(spark, tmp_path):
    """Every partition of a state is loaded and committed in each micro-batch, however few keys there are."""
    wanted = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "30")
    try:
        rows = spark.range(20).selectExpr(
            "'b' AS brand", "CAST(id AS STRING) AS id", "concat('u', id) AS author", "1L AS score", "'neg' AS label",
            "0.9D AS neg_prob", "'some text' AS text", "timestamp_seconds(id * 60) AS event_time")
        rows.write.parquet(str(tmp_path / "in"))
        scored = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")).withWatermark("event_time", "1 second")
        stream = windows.aggregate_stream(scored, 120, 60)
        query = monitor.run(stream, str(tmp_path / "checkpoint"), path=str(tmp_path / "rows"), drain=True)
        query.awaitTermination()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "30"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", wanted)
    made = {o["numShufflePartitions"] for p in query.recentProgress for o in p["stateOperators"]}
    assert made and max(made) <= max(spark.sparkContext.defaultParallelism, 8)
    assert spark.read.parquet(str(tmp_path / "rows")).count() > 15
