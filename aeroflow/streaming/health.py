"""Pipeline health from the progress reports of a streaming query."""

from __future__ import annotations

import json
import threading
from collections.abc import Iterable
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

LAG_DDL = "source string, topic string, partition int, read_offset bigint, latest_offset bigint, lag bigint"


def batch_metrics(query: StreamingQuery, name: str) -> list[dict[str, Any]]:
    """Observed counts of each recent batch, oldest first."""
    return [
        {"batch_id": progress.batchId, **progress.observedMetrics[name].asDict()}
        for progress in query.recentProgress
        if name in progress.observedMetrics
    ]


def _offsets(text: str | dict | None) -> dict[tuple[str, int], int]:
    """Positions by topic and partition; a file source has one unnamed partition."""
    parsed = json.loads(text) if isinstance(text, str) and text != "null" else text
    if not isinstance(parsed, dict):
        return {}
    positions = {}
    for topic, value in parsed.items():
        if isinstance(value, dict):
            positions |= {(topic, int(p)): int(o) for p, o in value.items()}
        else:
            positions[(topic, 0)] = int(value)
    return positions


def lag_rows(sources: Iterable[dict[str, Any]]) -> list[tuple]:
    rows = []
    for source in sources:
        read = _offsets(source.get("endOffset"))
        started = _offsets(source.get("startOffset"))
        latest = _offsets(source.get("latestOffset"))
        for topic, partition in sorted(read.keys() | latest.keys()):
            place = (topic, partition)
            done, end = read.get(place, started.get(place)), latest.get(place)
            lag = None if done is None or end is None else end - done
            rows.append((source.get("description"), topic, partition, done, end, lag))
    return rows


def unread(records: DataFrame, audit: DataFrame) -> DataFrame:
    """How far a job is behind a topic whose records can be counted: a row for each topic partition.

    ``audit`` are the audit rows of one job. ``lag`` counts messages that no committed batch has;
    it is all of them for a job that has read nothing, and 0 for one that has caught up.
    """
    place = ["topic", "partition"]
    there = records.groupBy(*place).agg(F.count("*").alias("messages"), F.max("offset").alias("latest_offset"))
    done = audit.groupBy(*place).agg(F.sum("messages").alias("read"), F.max("last_offset").alias("read_offset"))
    lag = F.col("messages") - F.coalesce("read", F.lit(0))
    return there.join(done, place, "left").select(*place, "read_offset", "latest_offset", lag.alias("lag"))


PROGRESS = """query string, run_id string, batch_id bigint, at timestamp, input_rows bigint, rows_per_second double,
  batch_ms bigint, state_rows bigint"""


class ProgressLog(StreamingQueryListener):
    """Appends a row to a table for each progress report of the session's queries.

    Register it with ``spark.streams.addListener``; reports are gathered and written by ``flush`` and
    when a query ends, as a small file for each report would be one more table to compact.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self._rows: list[tuple] = []
        self._lock = threading.Lock()

    def onQueryStarted(self, event: Any) -> None:
        """Nothing is known of a query yet."""

    def onQueryIdle(self, event: Any) -> None:
        """Nothing was read."""

    def onQueryProgress(self, event: Any) -> None:
        p = event.progress
        at = datetime.fromisoformat(p.timestamp.replace("Z", "+00:00"))
        states = sum(s.numRowsTotal for s in p.stateOperators)
        row = (p.name, str(p.runId), p.batchId, at, p.numInputRows, float(p.processedRowsPerSecond), p.batchDuration, states)
        with self._lock:
            self._rows.append(row)

    def onQueryTerminated(self, event: Any) -> None:
        self.flush()

    def flush(self) -> None:
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(PROGRESS).parquet(self.path)


def consumer_lag(spark: SparkSession, sources: Iterable[dict[str, Any]]) -> DataFrame:
    """How far a query is behind, one row per topic partition.

    ``sources`` is the ``sources`` list of a progress report. The lag is NULL where it is not known:
    file sources report no newest position, and a partition not yet read has no position.
    """
    return spark.createDataFrame(lag_rows(sources), LAG_DDL)
