"""The given tables in the shape of messages, dump records and corpora."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewatch.config import Brand, Detection, Thresholds
from tidewatch.functions.lexicon import VALENCES, Lexicon, Turns
from tidewatch.functions.numbers import epoch_millis
from tidewatch.functions.text import SAMPLE_LIMIT, clip
from tidewatch.operators.messages import clean_messages
from tidewatch.operators.scoring import lexicon_scorer, score_messages
from tidewatch.operators.spikes import score_windows
from tidewatch.operators.windows import window_aggregates
from tidewatch.session import ROCKSDB_PROVIDER, shared_dir, spread, stored

# The invented prose holds few English words of feeling, so some of its frequent syllables
# get a valence, a degree or a negating sense: every rule of the scorer is then at work.
TOXIC = ("clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash",
         "worthless")
LEXICON = Lexicon(
    valences={w: VALENCES[w] for w in TOXIC} | {"thon": 1.3, "thnt": -0.9, "erin": 2.2, "la": 0.4},
    degrees={"is": 0.293, "as": -0.293, "very": 0.293, "and the": -0.293},
    negators=("not", "of", "que"),
    phrases={"the thon": 2.0, "thon and": -1.0, "la thnt": 0.0, "in the": -0.5, "la de la": 1.5, "of the in": 1.0},
    turns=Turns(never="in", so=("the", "les"), without=("de", "la"), least="to", not_least=("and", "et")),
)
SCORER = lexicon_scorer(LEXICON)

BRANDS = [
    Brand("first", ("thre", "x.com")),
    Brand("second", ("on the", "thnt")),
    Brand("third", ("idiot", "scum", "r/")),
    Brand("fourth", ("que", "des")),
    Brand("fifth", ("and&&&", "in%%%")),
]

# About 14 events an hour at the smallest scale: windows of a day, every six hours.
DETECTION = Detection(
    window_seconds=24 * 3600, slide_seconds=6 * 3600, lateness_seconds=30,
    thresholds=Thresholds(alpha=0.3, spike_k=1.0, min_volume=5, min_neg_ratio=0.05,
                          cooldown_seconds=24 * 3600))
PER_BRAND = Detection(
    DETECTION.window_seconds, DETECTION.slide_seconds, DETECTION.lateness_seconds,
    DETECTION.thresholds,
    {"click": Thresholds(0.3, 0.5, 5, 0.05, 12 * 3600),
     "view": Thresholds(0.5, 1.0, 10, 0.05, 24 * 3600)})
AS_OF = "2024-01-20 00:00:00"


def prepare(spark: SparkSession) -> None:
    """Settings the queries rely on: UTC, and a state store that can hold the detector."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)


def table(spark: SparkSession, path: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{path}/{name}.parquet")


def documents(spark: SparkSession, path: str) -> DataFrame:
    return table(spark, path, "documents")


def _message_columns(document_count: Column) -> list[Column]:
    return [
        F.col("event_id").cast("string").alias("id"),
        F.col("event_type").alias("brand"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("author"),
        F.col("value").cast("int").alias("score"),
        F.col("ts").cast("timestamp").alias("event_time"),
        (F.col("event_id") % document_count).alias("doc_id"),
    ]


def events_as_messages(spark: SparkSession, path: str, events: DataFrame | None = None) -> DataFrame:
    """Events as messages without a text; ``doc_id`` tells which document is their text."""
    events = table(spark, path, "events") if events is None else events
    count = documents(spark, path).agg(F.count("*")).scalar()
    return events.select(*_message_columns(count))


def message_view(spark: SparkSession, path: str) -> DataFrame:
    """Every event as a message whose body is a whole document."""
    texts = documents(spark, path).select("doc_id", F.col("text").alias("body"))
    return events_as_messages(spark, path).join(texts, "doc_id").drop("doc_id")


def scored_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole document texts, cleaned and scored; the text is then cut to a sample."""
    texts = spread(documents(spark, path).select("doc_id", "text"))
    scored = score_messages(clean_messages(texts, F.col("text")), SCORER)
    return scored.withColumn("text", clip(F.col("text"), SAMPLE_LIMIT))


def scored_messages(
    spark: SparkSession, path: str, events: DataFrame | None = None, lateness: str | None = None
) -> DataFrame:
    """The message view, scored; of a stream of events if ``lateness`` is given.

    Many messages share a document. Scoring happens before the join, once per document, and
    the join moves a label, a number and a sample and not the whole text.
    """
    messages = events_as_messages(spark, path, events)
    if lateness:
        messages = messages.withWatermark("event_time", lateness)
    return messages.join(scored_documents(spark, path), "doc_id").drop("doc_id")


def prepared_stream(spark: SparkSession, path: str, texts: DataFrame, streams: list[DataFrame]) -> DataFrame:
    """Streams of events as scored messages, every stream with its own watermark.

    ``texts`` are scored documents that are stored, so that no micro-batch scores them again. Of
    several streams the slowest decides what is late (Spark's policy ``min``).
    """
    own = [events_as_messages(spark, path, s).withWatermark("event_time", DETECTION.lateness) for s in streams]
    return reduce(DataFrame.unionByName, own).join(texts, "doc_id").drop("doc_id")


def aggregates(spark: SparkSession, path: str, stored: bool = False) -> DataFrame:
    """Window aggregates of the scored messages, which are written to a table first if ``stored``."""
    scored = scored_messages(spark, path)
    if stored:
        folder = shared_dir(spark, "scored")
        scored.write.parquet(folder)
        scored = spark.read.parquet(folder)
    return window_aggregates(
        scored, DETECTION.window_seconds, DETECTION.slide_seconds, stored=stored)


def scored_windows(spark: SparkSession, path: str, detection: Detection = DETECTION) -> DataFrame:
    return score_windows(aggregates(spark, path), detection)


# A feed of events: at least so many parts, and so many events in a part on average.
FEED_PARTS, PART_EVENTS = 4, 1_000_000


def feed_parts(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """Events with their time in milliseconds and the ``part`` of the covered time they lie in."""
    events = table(spark, path, "events").withColumn("ms", epoch_millis("ts"))
    low, high, count = events.agg(F.min("ms"), F.max("ms"), F.count("*")).first()
    parts = max(FEED_PARTS, -(-count // PART_EVENTS))
    part = F.expr(f"CAST((ms - {low or 0}) * {parts} DIV {(high or 0) - (low or 0) + 1} AS INT)")
    return events.withColumn("part", part), parts


def by_part(spark: SparkSession, delivered: DataFrame) -> DataFrame:
    """The rows of a feed, stored in one folder per ``part``, so that a part is read without the others."""
    folder = shared_dir(spark, "parts")
    rows = delivered.where("part IS NOT NULL").drop("ms")
    rows.repartition("part").write.partitionBy("part").parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def feed(spark: SparkSession, delivered: DataFrame, root: str, parts: Iterable[int]) -> None:
    """Write parts of a feed (column ``part``) one after the other, each as one file.

    Files are read in the order of their times. A part is bounded, so one task can write it.
    """
    for part in parts:
        delivered.where(F.col("part") == part).drop("part").coalesce(1).write.parquet(f"{root}/{part:06d}")


def feed_stream(spark: SparkSession, layout: StructType, root: str) -> DataFrame:
    """The feed as a stream: one file per micro-batch."""
    return spark.readStream.schema(layout).option("maxFilesPerTrigger", 1).option(
        "recursiveFileLookup", True).parquet(root)


FRAME_BYTES = 10_000
# Fixed value: a zstd frame that is skipped and holds nothing.
EMPTY_FRAME = "P*M\x18\0\0\0\0"


def write_frames(lines: DataFrame, folder: str) -> None:
    """Lines (column ``line``) as zstd files of frames of so many bytes, with empty ones between."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        packing = zstandard.ZstdCompressor(write_checksum=True)
        for batch in batches:
            data = "".join(f"{line}\n" for line in batch["line"].to_pylist()).encode()
            yield pa.record_batch({"frame": pa.array(
                [packing.compress(data[i:i + FRAME_BYTES]) for i in range(0, len(data), FRAME_BYTES)],
                pa.binary())})

    frames = lines.mapInArrow(run, "frame binary").select(F.col("frame").cast("string"))
    frames.write.option("lineSep", EMPTY_FRAME).option("compression", "none").text(folder)


def labelled_documents(spark: SparkSession, path: str) -> DataFrame:
    """Documents with a label, as a three-class corpus: 0 toxic, 2 of quality, else 1."""
    labels = table(spark, path, "labels")
    kind = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 1, 2).otherwise(1)
    return (
        documents(spark, path).select("doc_id", "text")
        .join(labels.select("doc_id", kind.alias("label")), "doc_id")
    )


def conversation_records(spark: SparkSession, path: str) -> DataFrame:
    """Conversation turns as dump records: comments, but for the system's turns."""
    post = F.col("role") == "system"
    return table(spark, path, "conversations").select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"),
        F.when(post, "submission").otherwise("comment").alias("type"),
        F.col("role").alias("author"),
        F.when(post, F.col("role")).alias("title"),
        F.when(~post, F.col("text")).alias("body"),
        F.when(post, F.col("text")).alias("selftext"),
        F.col("turn").cast("string").alias("score"),
        (F.col("conv_id") + 1).cast("string").alias("created_utc"),
    )
