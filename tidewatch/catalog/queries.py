"""One query per operator. Each takes the session and the folder of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidewatch.catalog import inputs
from tidewatch.catalog.inputs import AS_OF, BRANDS, DETECTION, LEXICON, PER_BRAND, SCORER, table
from tidewatch.config import Brand
from tidewatch.functions import sentiment, text
from tidewatch.functions.numbers import epoch_millis, epoch_seconds, round_even
from tidewatch.operators import brands, contracts, messages, normalise, sampling, spikes, windows
from tidewatch.operators.scoring import make_scorer, score_messages
from tidewatch.plans import corpus, quality, serving
from tidewatch.session import shared_dir, spread
from tidewatch.session import stored as keep
from tidewatch.sinks import tables as stored
from tidewatch.sinks import reports, topics
from tidewatch.sources.dumps import DUMP_KINDS, read_dump_folder, read_zstd
from tidewatch.sources.tables import public_corpus
from tidewatch.sources.topics import folder_stream
from tidewatch.streaming import monitor
from tidewatch.streaming.detector import detect_spike_stream

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _seconds(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: epoch_seconds(n) for n in names})


# Messages and records


@query
def message_view(spark, path):
    view = inputs.message_view(spark, path)
    return view.select(
        "id", messages.brand_key().alias("brand"), "author", "score",
        epoch_millis("event_time").alias("event_ms"), F.md5("body").alias("body_md5"))


@query
def normalise_records(spark, path):
    kind, value, props = F.col("event_type"), F.col("value").cast("string"), F.col("props")
    second = F.unix_seconds(F.col("ts").cast("timestamp")).cast("string")
    records = table(spark, path, "events").select(
        F.when(kind == "view", "").alias("id"),
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("name"),
        F.when(kind == "view", " Comment ").when(kind == "signup", "SUBMISSION")
        .when(kind == "error", "other").alias("kind"),
        F.when(kind == "purchase", props).alias("title"),
        F.when(kind.isin("click", "purchase"), props).alias("body"),
        F.when(kind == "signup", props).alias("selftext"),
        F.when(kind == "error", props).alias("text"),
        F.when(kind != "view", F.concat(F.lit("user_"), F.col("user_id").cast("string")))
        .otherwise("").alias("author"),
        F.when(kind == "view", value).when(kind == "signup", "x").when(kind == "error", "")
        .when(kind == "click", "inf").otherwise(F.concat(F.lit("-"), value)).alias("score"),
        F.when(kind == "click", "").alias("created_utc"),
        F.when(kind != "view", second).alias("created"),
        F.when(kind == "view", second).alias("timestamp"),
        kind.alias("brand"),
    )
    return normalise.normalise(records).drop("ingested_at", "permalink", "parent_id")


@query
def live_items(spark, path):
    none = F.lit(None).cast("string")
    posts = inputs.documents(spark, path).select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"),
        F.col("source").alias("subreddit"), none.alias("author"), F.col("lang").alias("brand"),
        F.col("source").alias("title"), F.col("text").alias("selftext"), none.alias("body"),
        none.alias("permalink"), F.col("n_chars").alias("score"), none.alias("parent_id"),
        F.col("doc_id").alias("created_utc"))
    turns = table(spark, path, "conversations").select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"),
        F.col("role").alias("subreddit"), F.col("role").alias("author"), F.col("role").alias("brand"),
        F.col("role").alias("title"), none.alias("selftext"), F.col("text").alias("body"),
        none.alias("permalink"), F.lit(None).cast("bigint").alias("score"),
        F.col("conv_id").cast("string").alias("parent_id"), F.col("turn").alias("created_utc"))
    both = normalise.normalise_items(posts, "submission").unionByName(
        normalise.normalise_items(turns, "comment"))
    return both.withColumn("body_md5", F.md5("body")).drop("ingested_at", "permalink", "body")


@query
def dump_folder_scan(spark, path):
    records = inputs.conversation_records(spark, path)
    root = shared_dir(spark, "dump")
    posts = records.where("type = 'submission'")
    long = F.length("selftext") > 500
    posts.where(~long).write.json(f"{root}/submissions")
    posts.where(long).write.mode("append").json(f"{root}/submissions", compression="gzip")
    records.where("type = 'comment'").write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(f"{root}/comments")
    found = read_dump_folder(spark, root, kinds=(*DUMP_KINDS, "json", "gz"))
    named = found.withColumn("brand", F.lit("none"))
    return normalise.normalise(named).select(
        "id", "type", "author", "title", F.md5("body").alias("body_md5"), "score", "created_utc")


@query
def zstd_frames_scan(spark, path):
    """Dump records in zstd files of many frames, which end anywhere in a line."""
    root = shared_dir(spark, "frames")
    lines = inputs.conversation_records(spark, path).select(F.to_json(F.struct("*")).alias("line"))
    inputs.write_frames(lines, root)
    return normalise.normalise(read_zstd(spark, root, pattern="part-*").withColumn("brand", F.lit("none"))).select(
        "id", "type", "author", "title", F.md5("body").alias("body_md5"), "score", "created_utc")


@query
def json_drop_malformed(spark, path):
    kind, props = F.col("event_type"), F.col("props")
    value = (
        F.when(kind == "signup", F.concat(F.lit("["), props, F.lit("]")))
        .when(kind == "error", "null").when(kind == "click", F.substring(props, 2, 100))
        .when(F.col("event_id") % 3 == 0, F.regexp_replace(props, r'": (\d+)', r'": "$1"'))
        .when(F.col("event_id") % 3 == 1, F.regexp_replace(props, r'": (\d+)', r'": $1.0'))
        .otherwise(props))
    lines = table(spark, path, "events").select("event_id", value.alias("value"))
    return messages.decode(lines, "value", StructType([StructField("k", LongType())]))


@query
def bot_filter(spark, path):
    role = F.col("role")
    author = (
        F.when(role == "system", " AutoModerator ").when(F.col("turn") == 1, "x_BOT")
        .when(F.col("turn") == 2, "botanist").when(F.col("turn") == 3, "  ")
        .when(F.col("turn") > 3, F.lit(None)).otherwise(role))
    turns = table(spark, path, "conversations").withColumn("author", author)
    return turns.where(~text.is_bot("author")).select("conv_id", "turn", "author")


# Brand matching


@query
def brand_match(spark, path):
    matched = brands.match_brand(F.col("text"), BRANDS)
    return spread(inputs.documents(spark, path).select("doc_id", "text")).select(
        "doc_id", matched.alias("brand"))


@query
def brand_match_large(spark, path):
    texts = spread(inputs.documents(spark, path).select("doc_id", "text"))
    filler = [Brand(f"filler{i}", (f"filler{i}x", f"filler {i}y")) for i in range(1000)]
    return brands.keep_matched(texts, "text", [*filler, *BRANDS]).select("doc_id", "brand")


@query
def brand_counters(spark, path):
    counters = Observation("matching")
    texts = spread(inputs.documents(spark, path).select("text"))
    kept = brands.keep_matched(texts, "text", BRANDS, counters)
    kept.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(
        [(counters.get["sent"], counters.get["skipped"])], "sent bigint, skipped bigint")


# Text and sentiment


@query
def clean_text(spark, path):
    texts = spread(inputs.documents(spark, path).select("doc_id", "text"))
    cleaned = messages.clean_messages(texts, F.col("text"))
    return cleaned.select(
        "doc_id", F.length("text").alias("characters"), F.md5("text").alias("text_md5"),
        text.clip(F.col("text"), text.MESSAGE_LIMIT).alias("message_text"))


def _polarity(spark, path) -> DataFrame:
    texts = spread(inputs.documents(spark, path).select("doc_id", "text", "lang"))
    return sentiment.with_polarity(texts, "text", LEXICON)


@query
def lexicon_polarity(spark, path):
    compound, neg = F.col("polarity.compound"), F.col("polarity.neg")
    scored = _polarity(spark, path).withColumn(
        "neg_prob", sentiment.negative_probability(compound, neg))
    return scored.select(
        "doc_id", compound.alias("compound"), neg.alias("neg"),
        F.col("polarity.neu").alias("neu"), F.col("polarity.pos").alias("pos"),
        sentiment.label_of(compound).alias("label"),
        round_even("neg_prob").alias("neg_prob"),
        sentiment.confidence(compound).alias("confidence"))


@query
def label_counts(spark, path):
    label = sentiment.label_of(F.col("polarity.compound"))
    return _polarity(spark, path).groupBy("lang", label.alias("label")).agg(
        F.count("*").alias("rows"))


@query
def weak_labels(spark, path):
    records = table(spark, path, "conversations").select(
        "conv_id", "turn", F.col("text").alias("body"), F.lit("").alias("selftext"),
        F.col("role").alias("title"))
    return corpus.weak_corpus(
        spread(records), rows=None, lexicon=LEXICON, keep=("conv_id", "turn")).select(
        "conv_id", "turn", "text", "label", "source")


@query
def first_weak_rows(spark, path):
    records = table(spark, path, "conversations").select(
        "conv_id", "turn", F.col("text").alias("body"), F.lit("").alias("selftext"),
        F.col("role").alias("title"))
    return corpus.weak_corpus(
        records, ["conv_id", "turn"], rows=100, lexicon=LEXICON, keep=("conv_id", "turn")).select(
        "conv_id", "turn", "label")


@query
def softmax_argmax(spark, path):
    logits = F.transform(F.slice("embedding", 1, 3), lambda x: x.cast("double"))
    classes = table(spark, path, "embeddings").select("vec_id", logits.alias("logits")).withColumn(
        "p", sentiment.softmax(F.col("logits")))
    label, negative, confidence = sentiment.class_scores(F.col("p"))
    scored = classes.select(
        "vec_id", label.alias("label"), negative.alias("neg_prob"), confidence.alias("confidence"))
    return scored.withColumns({c: round_even(c, 9) for c in ("neg_prob", "confidence")})


@query
def scored_records(spark, path):
    """The scored-message contract: whole texts are scored, 512 characters of them sent on."""
    turns = table(spark, path, "conversations").select(
        "conv_id", "turn", F.col("role").alias("author"), F.col("role").alias("title"),
        F.col("text").alias("body"))
    return messages.sent_on(score_messages(messages.clean_messages(spread(turns)), SCORER)).select(
        "conv_id", "turn", "text", "label", "neg_prob")


# Windows and spikes


@query
def sliding_aggregates(spark, path):
    return windows.as_stream_record(inputs.aggregates(spark, path))


@query
def stored_aggregates(spark, path):
    return windows.as_stream_record(inputs.aggregates(spark, path, stored=True))


@query
def ewma_zscore(spark, path):
    scored = inputs.scored_windows(spark, path)
    return _seconds(scored, "window_start").select(
        "brand", "window_start", "neg_count", round_even("z_score", 6).alias("z_score"))


def _alerts(spark, path, detection=DETECTION) -> DataFrame:
    return spikes.alert_records(inputs.scored_windows(spark, path, detection))


@query
def spike_alerts(spark, path):
    return _seconds(_alerts(spark, path), "triggered_at", "window_start", "window_end")


@query
def spike_alerts_per_brand(spark, path):
    return _seconds(
        _alerts(spark, path, PER_BRAND), "triggered_at", "window_start", "window_end")


def _fed(spark: SparkSession, path: str, delivered: DataFrame, parts: int,
         build: Callable[[list[DataFrame]], DataFrame], topics: list[Column] | None = None,
         lag: int = 0) -> DataFrame:
    """Rows of a stream over a feed that arrives part by part, one file per micro-batch.

    The stream is stopped after half of the parts and started again from its checkpoint. With
    several ``topics`` (conditions on events) each is a stream; the last lacks its ``lag`` last parts.
    """
    root = shared_dir(spark, "feed")
    layout = table(spark, path, "events").schema
    roots = [f"{root}/{n}" for n in range(len(topics or [None]))]
    half = parts // 2
    delivered = inputs.by_part(spark, delivered)
    for steps in (range(half), range(half, parts)):
        for n, folder in enumerate(roots):
            own = delivered.where(topics[n]) if topics else delivered
            kept = range(steps.start, min(steps.stop, parts - (lag if n and n == len(roots) - 1 else 0)))
            inputs.feed(spark, own, folder, kept)
        stream = build([inputs.feed_stream(spark, layout, folder) for folder in roots])
        monitor.run(stream, f"{root}/checkpoint", path=f"{root}/rows", drain=True).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/rows")


def _scored_feed(spark: SparkSession, path: str) -> Callable[[list[DataFrame]], DataFrame]:
    texts = keep(inputs.scored_documents(spark, path), "texts")
    return lambda streams: inputs.prepared_stream(spark, path, texts, streams)


@query
def stream_aggregates(spark, path):
    scored = _scored_feed(spark, path)
    closed = _fed(spark, path, *inputs.feed_parts(spark, path),
                  lambda streams: monitor.aggregate_stream(scored(streams), DETECTION))
    return windows.as_stream_record(closed)


@query
def stream_alerts(spark, path):
    scored = _scored_feed(spark, path)
    found = _fed(spark, path, *inputs.feed_parts(spark, path), lambda streams: detect_spike_stream(
        monitor.aggregate_stream(scored(streams), DETECTION), DETECTION))
    return _seconds(found, "triggered_at", "window_start", "window_end")


@query
def late_rows(spark, path):
    """Every fifth event comes with the part after its own."""
    scored = _scored_feed(spark, path)
    events, parts = inputs.feed_parts(spark, path)
    delay = F.when(F.col("event_id") % 5 == 0, 1).otherwise(0)
    delivered = events.withColumn("part", F.least(F.col("part") + delay, F.lit(parts - 1)))
    late = _fed(spark, path, delivered, parts,
                lambda streams: monitor.late_stream(scored(streams), DETECTION))
    return _seconds(late, "window_start").select("brand", "id", "at", "window_start")


@query
def stream_two_topics(spark, path):
    """Two topics with their own watermarks; one lags and holds the windows open."""
    scored = _scored_feed(spark, path)
    fast = F.col("event_type").isin("view", "click")
    closed = _fed(spark, path, *inputs.feed_parts(spark, path),
                  lambda streams: monitor.aggregate_stream(scored(streams), DETECTION),
                  topics=[fast, ~fast], lag=1)
    return windows.as_stream_record(closed)


# Sinks and contracts


def _typed_messages(spark, path) -> DataFrame:
    return inputs.message_view(spark, path).select(
        "id", F.when(F.col("score") > 20, "submission").otherwise("comment").alias("type"),
        F.lit("unknown").alias("subreddit"), "author", "brand", "body", "score",
        epoch_seconds("event_time").alias("created_utc"), F.lit(0.0).alias("ingested_at"))


@query
def route_by_type(spark, path):
    sent = topics.routed(_typed_messages(spark, path), "submissions", "comments")
    return sent.groupBy("topic", "key").agg(
        F.count("*").alias("messages"), F.max(F.get_json_object("value", "$.id")).alias("last_id"),
        F.sum(F.get_json_object("value", "$.score").cast("bigint")).alias("scores"))


@query
def contract_rejects(spark, path):
    kind = F.col("brand")
    broken = _typed_messages(spark, path).drop("body").withColumns({
        "type": F.when(kind == "error", "post").otherwise(F.col("type")),
        "created_utc": F.when(kind == "view", 0.0).otherwise(F.col("created_utc")),
        "id": F.when(kind == "view", F.lit(None)).otherwise(F.col("id")),
        "brand": F.when(kind == "signup", F.lit(None)).otherwise(kind)})
    valid, rejected = contracts.split_valid(broken, contracts.raw_message_rules())
    faults = rejected.select(F.array_join("violations", "; ").alias("violations"))
    return valid.select(F.lit("").alias("violations")).unionByName(faults).groupBy(
        "violations").agg(F.count("*").alias("messages"))


@query
def upsert_aggregates(spark, path):
    root = shared_dir(spark, "upsert")
    scored = keep(inputs.scored_messages(spark, path), "scored")
    halves = scored.where(f"event_time < timestamp'{AS_OF}'"), scored.where(
        f"event_time >= timestamp'{AS_OF}'")
    for batch, half in enumerate(halves):
        rows = windows.window_aggregates(
            half, DETECTION.window_seconds, DETECTION.slide_seconds, stored=True)
        stored.write_aggregates(windows.as_stream_record(rows), root, batch)
    table_now = stored.read_aggregates(spark, root).drop("window_date")
    ratios = ("neg_ratio", "avg_neg_prob", "influencer_neg")
    return _seconds(table_now, "window_start", "window_end").withColumns(
        {c: F.col(c).cast("double") for c in ratios})


@query
def upsert_revisions(spark, path):
    """Two writers with equal batch numbers, each with two revisions of every key in one batch."""
    root = shared_dir(spark, "revisions")
    now = keep(inputs.aggregates(spark, path), "windows")
    for writer, more in (("first", 5), ("second", 0)):
        revisions = [now.withColumns({"volume": F.col("volume") + more + extra, "revision": F.lit(number)})
                     for number, extra in ((2, 0), (1, 9))]
        stored.write_aggregates(revisions[0].unionByName(revisions[1]), root, 7, "revision", writer)
    return _seconds(stored.read_aggregates(spark, root), "window_start").select(
        "brand", "window_start", "volume", "neg_count")


@query
def persisted_records(spark, path):
    """Records of both result topics, some unreadable, some breaking their contract: where each ends."""
    root = shared_dir(spark, "persister")
    now = keep(inputs.aggregates(spark, path), "windows")
    aggregates = windows.as_stream_record(now)
    found = keep(_seconds(
        spikes.detect_spikes(now, DETECTION), "triggered_at", "window_start", "window_end"), "alerts")

    def sent(df: DataFrame, topic: str, value: Column) -> DataFrame:
        return df.select(F.lit(topic).alias("topic"), value.alias("value"), F.lit(1).alias("version"))

    whole = F.to_json(F.struct("*"))
    third = F.col("volume") % 3
    records = reduce(DataFrame.unionByName, [
        sent(aggregates, "aggregates", whole), sent(found, "alerts", whole),
        sent(aggregates.where(third == 0), "aggregates", F.lit("not json")),
        sent(aggregates.where(third == 1).drop("brand"), "aggregates", whole),
        sent(found.drop("brand"), "alerts", whole)])
    stored.persist_batch(records, "aggregates", root, 0)
    kept = [stored.read_aggregates(spark, f"{root}/aggregates").select(F.lit("aggregates").alias("place")),
            stored.read_alerts(spark, f"{root}/alerts").select(F.lit("alerts").alias("place"))]
    lost = spark.read.schema("topic string, violations array<string>, record string").json(f"{root}/rejected")
    places = [*kept, lost.select(F.concat_ws(": ", "topic", F.array_join("violations", "; ")).alias("place"))]
    return reduce(DataFrame.unionByName, places).groupBy("place").agg(F.count("*").alias("records"))


@query
def append_alerts(spark, path):
    root = shared_dir(spark, "alerts")
    found = _alerts(spark, path)
    for batch in (0, 1):
        stored.write_alerts(found, root, batch)
    return _seconds(stored.read_alerts(spark, root), "triggered_at").select(
        "id", "brand", "triggered_at", "volume", "severity", "sample_text")


# Serving


def _stored_aggregates(spark, path) -> DataFrame:
    """The aggregates table as two writers leave it: an older one's rows are superseded."""
    root = shared_dir(spark, "aggregates")
    now = keep(inputs.aggregates(spark, path), "windows")
    stale = now.withColumn("volume", F.col("volume") + 1)
    stored.write_aggregates(stale, root, 0, writer="old")
    stored.write_aggregates(now, root, 0, writer="new")
    return stored.read_aggregates(spark, root)


def _alert_table(spark, path) -> DataFrame:
    """The alerts table after the same alerts were written by two writers."""
    root = shared_dir(spark, "alerts")
    found = keep(_alerts(spark, path), "alerts")
    for writer in ("old", "new"):
        stored.write_alerts(found, root, 0, writer=writer)
    return stored.read_alerts(spark, root)


def _series(spark, path) -> DataFrame:
    return serving.series(_stored_aggregates(spark, path), "click", minutes=1440, as_of=AS_OF)


def _doubles(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


@query
def known_brands(spark, path):
    return serving.brands(_stored_aggregates(spark, path))


@query
def brand_series(spark, path):
    rows = _seconds(_series(spark, path), "window_start", "window_end")
    return _doubles(rows, "neg_ratio", "avg_neg_prob", "influencer_neg")


@query
def brand_trend(spark, path):
    return _seconds(serving.trend(_series(spark, path)), "window_start")


@query
def brand_window_count(spark, path):
    return serving.window_count(_series(spark, path))


@query
def latest_alerts(spark, path):
    rows = serving.alerts(_alert_table(spark, path), limit=20)
    rows = _seconds(rows, "triggered_at", "window_start", "window_end")
    return _doubles(rows, "z_score", "neg_ratio")


@query
def active_alerts(spark, path):
    rows = serving.alerts(_alert_table(spark, path), active=True, limit=None, as_of=AS_OF)
    return _doubles(_seconds(rows, "triggered_at", "window_start", "window_end"),
                    "z_score", "neg_ratio")


@query
def alert_headlines(spark, path):
    found = serving.headlines(serving.alerts(_alert_table(spark, path), active=True, as_of=AS_OF))
    return _seconds(found, "triggered_at")


@query
def recent_alert_table(spark, path):
    rows = serving.recent_alerts(serving.alerts(_alert_table(spark, path), limit=50))
    return _doubles(_seconds(rows, "triggered_at"), "z_score", "neg_ratio")


# Corpora and quality


def _public(spark, path) -> DataFrame:
    return public_corpus(inputs.labelled_documents(spark, path)).withColumnRenamed("doc_id", "row_id")


def _corpus(spark, path) -> DataFrame:
    turns = table(spark, path, "conversations").select(
        (F.col("conv_id") * 1_000_000 + F.col("turn")).alias("row_id"),
        F.col("text").alias("body"), F.lit(None).cast("string").alias("selftext"),
        F.col("role").alias("title"))
    weak = corpus.weak_corpus(spread(turns), rows=None, lexicon=LEXICON, keep=("row_id",), limit=None)
    return corpus.build_corpus(
        _public(spark, path).select("row_id", "text", "label", "source"), weak, "row_id")


@query
def corpus_build(spark, path):
    return _corpus(spark, path).select("text", "label", "source", "split")


@query
def corpus_stats(spark, path):
    return corpus.split_stats(_corpus(spark, path))


@query
def public_sample(spark, path):
    return corpus.sample_public(_public(spark, path), 200, "row_id").select("row_id", "label")


@query
def exact_event_split(spark, path):
    ids = table(spark, path, "events").select("event_id")
    return sampling.exact_split(ids, "event_id")


@query
def seeded_order(spark, path):
    return sampling.with_position(table(spark, path, "events").select("event_id"), "event_id")


@query
def first_messages(spark, path):
    matched = inputs.events_as_messages(spark, path).where("brand = 'error'")
    return sampling.first_rows(matched, 100, "event_time", "id").select("id", "author", "score")


def _predictions(spark, path) -> DataFrame:
    labelled = public_corpus(inputs.labelled_documents(spark, path)).select("text", "label")
    return quality.predict(spread(labelled), SCORER)


@query
def batch_scoring(spark, path):
    return _predictions(spark, path).groupBy("label", "predicted").agg(F.count("*").alias("rows"))


@query
def quality_metrics(spark, path):
    found = quality.metrics(_predictions(spark, path))
    return found.select(
        round_even("accuracy", 9).alias("accuracy"), round_even("f1_macro", 9).alias("f1_macro"), "n")


@query
def quality_gate(spark, path):
    labelled = public_corpus(inputs.labelled_documents(spark, path)).select("text", "label")
    weak = sentiment.with_polarity(spread(labelled), "text", LEXICON).select(
        "label", sentiment.weak_label(F.col("polarity.compound")).alias("predicted"))
    verdict = quality.gate(quality.metrics(_predictions(spark, path)), quality.metrics(weak))
    return verdict.select(
        "n", round_even("delta", 9).alias("delta"), "verdict", "save", "exit_code")


@query
def written_corpus(spark, path):
    """The corpus as written: its statistics, read back."""
    root = shared_dir(spark, "corpus")
    reports.write_corpus(_corpus(spark, path), root)
    return spark.read.schema(
        "split string, label string, label_count bigint, rows bigint, total bigint").json(f"{root}/stats")


@query
def held_out_split(spark, path):
    root = shared_dir(spark, "corpus")
    reports.write_corpus(_corpus(spark, path), root)
    return reports.read_split(spark, root, "test").select(F.md5("text").alias("text_md5"), "label", "source")


@query
def kept_baseline(spark, path):
    """The baseline is written by the first run, kept by a worse one, and read back."""
    root = shared_dir(spark, "baseline")
    first = quality.metrics(_predictions(spark, path))
    reports.write_baseline(quality.gate(first, None), root)
    worse = first.withColumns({"accuracy": F.lit(0.0), "f1_macro": F.lit(0.0)})
    reports.write_baseline(quality.gate(worse, reports.read_baseline(spark, root)), root)
    return reports.read_baseline(spark, root).select(
        round_even("accuracy", 9).alias("accuracy"), round_even("f1_macro", 9).alias("f1_macro"), "n")


@query
def chosen_scorers(spark, path):
    """Scorers by name: the rules, also on null texts, and what stands in for a model that is not there."""
    texts = inputs.documents(spark, path).select(
        "doc_id", F.when(F.col("doc_id") % 7 != 0, F.col("text")).alias("text"))
    rules = make_scorer("vader", lexicon=LEXICON)(spread(texts), "text")
    absent = make_scorer("onnx", strict=False, model_path="/no/model", tokenizer_path="/no/tokenizer")(texts, "text")
    return rules.select("doc_id", F.lit("rules").alias("scorer"), "label").unionByName(
        absent.select("doc_id", F.lit("absent").alias("scorer"), "label"))


@query
def whole_monitor(spark, path):
    """Raw records of two topics through the monitor to its stored tables, which are read back."""
    root = shared_dir(spark, "monitor")
    sent = inputs.message_view(spark, path).select(
        "id", F.when(F.col("brand").isin("view", "click"), "submission").otherwise("comment").alias("type"),
        F.lit("all").alias("subreddit"), "author", "brand", F.lit(None).cast("string").alias("title"), "body",
        "score", epoch_seconds("event_time").alias("created_utc"), F.lit(0.0).alias("ingested_at"))
    topics.write_routed(topics.routed(sent, "submissions", "comments"), f"{root}/raw")
    raw = folder_stream(spark, {t: f"{root}/raw/topic={t}" for t in ("submissions", "comments")})
    monitor.start_monitor(spark, raw, root, DETECTION, SCORER, drain=True)
    found = _seconds(stored.read_aggregates(spark, f"{root}/aggregates"), "window_start")
    raised = _seconds(stored.read_alerts(spark, f"{root}/alerts"), "triggered_at")
    return found.select(
        F.lit("window").alias("kind"), "brand", F.col("window_start").alias("second"), "volume",
        F.col("unique_authors").alias("more").cast("string")).unionByName(raised.select(
            F.lit("alert").alias("kind"), "brand", F.col("triggered_at").alias("second"), "volume",
            F.col("severity").alias("more")))
