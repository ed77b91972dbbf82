"""A-9 for streams: how many rows each micro-batch had, as a table.

The feed is observed (no extra pass over the data) and a listener writes the
metric of every finished micro-batch to a file named by the batch's number. A
batch that a restart runs again finds its file there and adds no second row.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..session import list_names, publish_text

SCHEMA = "batch_id long, rows long"


class BatchCounts(StreamingQueryListener):
    """Counts below ``path``, of the queries whose feeds it observes."""

    def __init__(self, spark: SparkSession, path: str, name: str = "rows of a batch"):
        self.spark, self.path, self.name = spark, path.rstrip("/"), name
        self._ended: dict[str, threading.Event] = {}
        spark.streams.addListener(self)

    def observe(self, feed: DataFrame) -> DataFrame:
        return feed.observe(self.name, F.count(F.lit(1)).alias("rows"))

    def follow(self, query: StreamingQuery) -> None:
        self._ended.setdefault(str(query.runId), threading.Event())

    def close(self, seconds: float = 60) -> None:
        """Wait until the events of the ended queries have arrived, then stop listening."""
        for ended in list(self._ended.values()):
            ended.wait(seconds)
        self.spark.streams.removeListener(self)

    def read(self) -> DataFrame:
        """``batch_id`` and ``rows``, a row per micro-batch."""
        if not list_names(self.spark, self.path):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).json(self.path)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(self.name)
        if seen is not None and event.progress.numInputRows > 0:  # idle triggers run no batch
            batch = event.progress.batchId
            publish_text(self.spark, f"{self.path}/{batch:012d}.json", json.dumps({"batch_id": batch, "rows": seen["rows"]}))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended.setdefault(str(event.runId), threading.Event()).set()
