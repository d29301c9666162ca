"""The monitor as streaming queries."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructField, StructType, TimestampType

from tidewatch.config import Detection
from tidewatch.functions.text import MESSAGE_LIMIT
from tidewatch.operators.messages import clean_messages, sent_on
from tidewatch.operators.scoring import Scorer, score_messages
from tidewatch.schemas import SCORED_MESSAGE
from tidewatch.session import ROCKSDB_PROVIDER
from tidewatch.sinks.tables import persist_batch, write_aggregates, write_alerts
from tidewatch.sources.topics import message_stream, rejected_messages, table_stream
from tidewatch.streaming import windows
from tidewatch.streaming.detector import detect_spike_stream

# Fixed value: how often a checkpoint is taken.
CHECKPOINT_EVERY = "30 seconds"
PARTITIONS, LEAST_PARTITIONS = "spark.sql.shuffle.partitions", 8

SCORED_TABLE = StructType([*SCORED_MESSAGE, StructField("event_time", TimestampType())])


def scored_stream(
    records: DataFrame, detection: Detection, scorer: Scorer | None = None,
    limit: int | None = MESSAGE_LIMIT,
) -> DataFrame:
    """Raw topic records as scored messages with a watermark.

    Whole texts are scored; ``limit`` is how many characters are sent on.
    """
    messages = clean_messages(message_stream(records, detection))
    return sent_on(score_messages(messages, scorer), limit)


def aggregate_stream(scored: DataFrame, detection: Detection) -> DataFrame:
    """Each window once, when the watermark passes its end."""
    return windows.aggregate_stream(scored, detection.window_seconds, detection.slide_seconds)


def late_stream(scored: DataFrame, detection: Detection) -> DataFrame:
    """One row per message and window that the message came too late for."""
    return windows.late_rows(scored, detection.window_seconds, detection.slide_seconds)


def alert_stream(scored: DataFrame, detection: Detection) -> DataFrame:
    return detect_spike_stream(aggregate_stream(scored, detection), detection)


def run(
    stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None] | None = None,
    path: str | None = None, drain: bool = False,
) -> StreamingQuery:
    """Start a query that hands micro-batches to ``write``, or appends Parquet at ``path``.

    ``drain`` reads what there is now and stops; otherwise it checkpoints every 30 seconds.
    """
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    with state_partitions(spark):
        return _started(stream, checkpoint, write, path, drain)


@contextmanager
def state_partitions(spark: SparkSession) -> Iterator[None]:
    """Queries that start meanwhile have one partition of state per core at most.

    In every micro-batch each partition of each state is loaded, handed to a Python worker and committed,
    however few keys it has. States go to disk and keys are handled one by one, so more partitions than
    cores gain nothing. A query keeps the number it was first started with.
    """
    wanted = spark.conf.get(PARTITIONS)
    spark.conf.set(PARTITIONS, str(min(int(wanted), max(spark.sparkContext.defaultParallelism, LEAST_PARTITIONS))))
    try:
        yield
    finally:
        spark.conf.set(PARTITIONS, wanted)


def _started(
    stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None] | None, path: str | None, drain: bool,
) -> StreamingQuery:
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if drain else writer.trigger(
        processingTime=CHECKPOINT_EVERY)
    if write is not None:
        return writer.foreachBatch(write).start()
    # Scored messages hold whole texts, which are most of what is stored.
    return writer.format("parquet").option("compression", "zstd").option("path", path).start()


def start_monitor(
    spark: SparkSession, records: DataFrame, root: str, detection: Detection,
    scorer: Scorer | None = None, drain: bool = False,
) -> list[StreamingQuery]:
    """The whole monitor below ``root``: scored messages, aggregates and alerts.

    Messages are scored once, and windows follow the scored table, reading only the columns they need.
    Windows are aggregated once as well: what stores them and the detector follow the table of closed
    windows. ``root`` must be on storage all executors share. With ``drain`` the queries run one after
    the other and are done on return.
    """
    scored_path, windows_path = f"{root}/scored", f"{root}/windows"
    queries = []

    def start(stream: DataFrame, name: str, **target) -> None:
        query = run(stream, f"{root}/checkpoints/{name}", drain=drain, **target)
        if drain:
            query.awaitTermination()
        queries.append(query)

    start(scored_stream(records, detection, scorer), "scored", path=scored_path)
    start(rejected_messages(records), "rejected", path=f"{root}/rejected_messages")

    scored = table_stream(spark, scored_path, SCORED_TABLE).withWatermark("event_time", detection.lateness)
    closed = aggregate_stream(scored, detection)
    start(closed, "windows", path=windows_path)

    def follow() -> DataFrame:
        return table_stream(spark, windows_path, closed.schema)

    start(follow(), "aggregates", write=lambda df, batch: write_aggregates(df, f"{root}/aggregates", batch))
    start(detect_spike_stream(follow(), detection), "alerts",
          write=lambda df, batch: write_alerts(df, f"{root}/alerts", batch))
    return queries


def start_persister(
    records: DataFrame, aggregates_topic: str, root: str, drain: bool = False
) -> StreamingQuery:
    """Store what result topics carry: aggregates are upserted, all other records are alerts."""
    return run(
        records, f"{root}/checkpoints/persister", drain=drain,
        write=lambda batch, number: persist_batch(batch, aggregates_topic, root, number))


class ProgressCounts(StreamingQueryListener):
    """Rows read so far by every query of a session, and how many were too late, by query id.

    Add it to ``spark.streams`` before a query starts: every micro-batch is counted, also those
    that the query itself no longer remembers.
    """

    def __init__(self) -> None:
        self.input: Counter[str] = Counter()
        self.late: Counter[str] = Counter()
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        self.ended.discard(str(event.id))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self.input[str(progress.id)] += progress.numInputRows
        self.late[str(progress.id)] += sum(
            o.numRowsDroppedByWatermark for o in progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.id))
