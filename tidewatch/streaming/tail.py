"""Following the alerts as they come, with a sign of life while there are none."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class Heartbeat(StreamingQueryListener):
    """Calls ``beat`` whenever the query called ``name`` finds nothing new."""

    def __init__(self, name: str, beat: Callable[[], None]):
        self._name, self._beat = name, beat
        self._id = None

    def onQueryStarted(self, event):
        if event.name == self._name:
            self._id = event.id

    def onQueryProgress(self, event):
        progress = event.progress
        if progress.name == self._name and progress.numInputRows == 0:
            self._beat()

    def onQueryIdle(self, event):
        if event.id == self._id:
            self._beat()

    def onQueryTerminated(self, event):
        if event.id == self._id:
            self._id = None


def tail_alerts(
    alerts: DataFrame, checkpoint: str, on_alert: Callable[[str], None],
    on_idle: Callable[[], None] | None = None, name: str = "alert-tail", every: str = "1 second",
) -> StreamingQuery:
    """Hand every new alert to ``on_alert`` as JSON text, and call ``on_idle`` in between.

    Rows are pulled over one by one; alerts are few by design (cooldown per brand).
    """
    spark: SparkSession = alerts.sparkSession
    if on_idle is not None:
        spark.streams.addListener(Heartbeat(name, on_idle))

    def push(batch: DataFrame, _: int) -> None:
        for text in batch.toJSON().toLocalIterator():
            on_alert(text)

    return (
        alerts.writeStream.queryName(name).option("checkpointLocation", checkpoint)
        .trigger(processingTime=every).foreachBatch(push).start()
    )
