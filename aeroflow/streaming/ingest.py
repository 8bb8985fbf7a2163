"""The two ingest jobs.

Parsing is part of the streaming plan. The batch callback stages the parsed
documents, writes the tables, then the rejected messages, then the audit rows
that commit the batch. Nothing
is caught on the way: if a write fails the query fails, its offsets are not
committed, and the next run gets the same batch again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from typing import Protocol

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aeroflow import schemas
from aeroflow.functions import array_size
from aeroflow.operators import decode, dedup, flatten
from aeroflow.plans.build import FLIGHT_ORDER, flat_flights, placed_flights, staged
from aeroflow.sources.tables import FLIGHT_MONTH

REJECTS = "rejects"
REJECTS_TABLE = {
    "topic": "string",
    "partition": "int",
    "offset": "bigint",
    "raw": "string",
    "reason": "string",
}

# One narrow row per accepted airport message: which message is the newest.
DOCUMENTS = "documents"

# What names the messages of a batch, and how many rows it gave.
BATCH_RANGE = {
    "topic": "string",
    "partition": "int",
    "first_offset": "bigint",
    "last_offset": "bigint",
    "messages": "bigint",
}
COUNTED = (DOCUMENTS, "airports", "frequencies", "runways", "flights", REJECTS)
AUDIT_TABLE = BATCH_RANGE | {name: "bigint" for name in COUNTED}

# Columns the airport tables carry besides their own, to find the newest rows.
MESSAGE_POSITION = {"key": "binary", "partition": "int", "offset": "bigint", "timestamp": "timestamp"}


class Sink(Protocol):
    def open(self, spark: SparkSession, audit_ddl: str) -> None: ...

    def committed(self, spark: SparkSession, job: str, batch_id: int, ddl: str) -> DataFrame: ...

    def write(self, table: str, rows: DataFrame, job: str, batch_id: int) -> None: ...

    def commit(self, audit: DataFrame, job: str, batch_id: int) -> None: ...


class ReadableSink(Protocol):
    def read(self, spark: SparkSession, table: str, ddl: str) -> DataFrame: ...


class Topic(Protocol):
    def stream(self, spark: SparkSession) -> DataFrame: ...


@dataclass(frozen=True)
class Job:
    """How one kind of message becomes tables.

    ``counts`` are taken on the way, of every message; ``distinct`` ones only of a whole batch.
    """

    name: str
    parse: Callable[[DataFrame], DataFrame]
    counts: Callable[[], dict[str, Column]]
    distinct: Callable[[], dict[str, Column]]
    tables: Callable[[DataFrame], dict[str, DataFrame]]
    rejects: Callable[[DataFrame], DataFrame]

    def audit_ddl(self) -> str:
        """The same for every job; what a job does not count is NULL."""
        return schemas.ddl_row(AUDIT_TABLE)


def _count_where(test: Column) -> Column:
    return F.coalesce(F.sum(F.when(test, 1).otherwise(0)), F.lit(0)).cast("bigint")


def _with_sizes(parsed: DataFrame, *arrays: str) -> DataFrame:
    """Adds the size of each array, so that counting need not read the arrays."""
    return parsed.withColumns({f"n_{a}": array_size(a) for a in arrays})


def _total_size(array: str) -> Column:
    return F.coalesce(F.sum(f"n_{array}"), F.lit(0)).cast("bigint")


def _airport_counts() -> dict[str, Column]:
    return {
        DOCUMENTS: _count_where(F.col("_id").isNotNull()),
        "frequencies": _total_size("frequencies"),
        "runways": _total_size("runways"),
        REJECTS: _count_where(decode.is_rejected_airport()),
    }


def _airport_tables(parsed: DataFrame) -> dict[str, DataFrame]:
    documents = decode.with_id(parsed)
    airports = flatten.flatten_airports(documents, *MESSAGE_POSITION)
    return {
        DOCUMENTS: documents.select(F.col("_id").alias("airport_id"), *MESSAGE_POSITION),
        "airports": dedup.latest_by(airports, ["_id"], dedup.ARRIVAL_ORDER),
        "frequencies": flatten.explode_frequencies(documents, *MESSAGE_POSITION),
        "runways": flatten.explode_runways(documents, *MESSAGE_POSITION),
    }


def _flight_counts() -> dict[str, Column]:
    return {
        "flights": _total_size("flights"),
        REJECTS: _count_where(decode.is_rejected_page()),
    }


def _flight_tables(pages: DataFrame) -> dict[str, DataFrame]:
    # A local sort, no shuffle: panels filter on the departure airport.
    ordered = placed_flights(decode.split_flights(pages)).sortWithinPartitions(FLIGHT_MONTH, *FLIGHT_ORDER)
    return {"flights": flat_flights(ordered)}


AIRPORT_JOB = Job(
    "airports",
    lambda records: _with_sizes(
        decode.parse_airports(records, keep_raw=True), "frequencies", "runways"
    ),
    _airport_counts,
    lambda: {"airports": F.count_distinct("_id")},  # one row is written for each
    _airport_tables,
    decode.rejected_airports,
)
FLIGHT_JOB = Job(
    "flights",
    lambda records: _with_sizes(decode.parse_flight_pages(records, keep_raw=True), "flights"),
    _flight_counts,
    dict,
    _flight_tables,
    decode.rejected_pages,
)


def audit(job: Job, parsed: DataFrame) -> DataFrame:
    """Offsets and counts per topic partition, in one pass over parsed messages."""
    return parsed.groupBy("topic", "partition").agg(
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        F.count("*").alias("messages"),
        *[column.alias(name) for name, column in (job.counts() | job.distinct()).items()],
    )


# Staged documents that a task takes at most. Their words repeat, so they are stored in a
# tenth or less of what their rows need in a sort.
STAGE_SPLIT = 32 << 20


@contextmanager
def small_splits(spark: SparkSession, most: int = STAGE_SPLIT) -> Iterator[None]:
    """Files are read by tasks of ``most`` bytes, or less if the session says so."""
    name = "spark.sql.files.maxPartitionBytes"
    before, now = spark.conf.get(name), spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    spark.conf.set(name, str(min(now, most)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


class BatchMismatch(RuntimeError):
    """A batch number that this job has committed for other messages."""


def write_batch(
    job: Job, sink: Sink, parsed: DataFrame, batch_id: int, stage: str, job_id: str | None = None
) -> None:
    """Writes a batch unless the same messages were committed under its number before."""
    spark, job_id = parsed.sparkSession, job_id or job.name
    documents = staged(parsed, stage)
    # One row per topic partition.
    entries = audit(job, documents).collect()
    before = sink.committed(spark, job_id, batch_id, job.audit_ddl()).select(*BATCH_RANGE).collect()
    if before:
        now = {tuple(e[c] for c in BATCH_RANGE) for e in entries}
        if {tuple(b) for b in before} != now:
            raise BatchMismatch(f"batch {batch_id} of {job_id} was committed for other messages")
        return
    totals = {name: sum(e[name] for e in entries) for name in job.counts() | job.distinct()}
    outputs = job.tables(documents) | {REJECTS: job.rejects(documents)}
    for table, rows in outputs.items():
        # A table that is not counted itself has rows whenever there were messages.
        if totals.get(table, len(entries)):
            with small_splits(spark):
                sink.write(table, rows, job_id, batch_id)
    if entries:
        rows = [tuple(e[c] if c in e else None for c in AUDIT_TABLE) for e in entries]
        sink.commit(spark.createDataFrame(rows, job.audit_ddl()), job_id, batch_id)


def job_identity(spark: SparkSession, job: Job, checkpoint: str) -> str:
    """The job's name and an id that is made once and kept next to its checkpoint.

    Jobs that share a sink, and a job that starts over with a new checkpoint, each count
    their batches from 0; this tells them apart.
    """
    path = checkpoint.rstrip("/") + "-job"
    try:
        kept = spark.read.schema("value string").text(path).collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        kept = []
    if not kept:
        new = f"{job.name}-{uuid.uuid4().hex[:12]}"
        spark.createDataFrame([(new,)], "value string").coalesce(1).write.mode("overwrite").text(path)
        return new
    return kept[0]["value"]


def start(
    spark: SparkSession,
    job: Job,
    topic: Topic,
    sink: Sink,
    checkpoint: str,
    *,
    until_caught_up: bool = False,
) -> StreamingQuery:
    """Starts a job: until stopped, or until the topic as it is now is read.

    ``checkpoint`` is a folder all executors reach; the batch being written is
    staged next to it, and the job's id is kept there.
    """
    job_id = job_identity(spark, job, checkpoint)
    stage = checkpoint.rstrip("/") + "-stage"
    sink.open(spark, job.audit_ddl())
    metrics = [F.count("*").alias("messages")]
    metrics += [column.alias(name) for name, column in job.counts().items()]
    parsed = job.parse(topic.stream(spark)).observe(job.name, *metrics)
    writer = (
        parsed.writeStream.queryName(f"ingest_{job.name}")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: write_batch(job, sink, batch, batch_id, stage, job_id))
    )
    if until_caught_up:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def run_to_end(query: StreamingQuery) -> StreamingQuery:
    """Waits for the query; raises what it failed with."""
    query.awaitTermination()
    return query


def ingest(
    spark: SparkSession, job: Job, topic: Topic, sink: Sink, checkpoint: str
) -> StreamingQuery:
    return run_to_end(start(spark, job, topic, sink, checkpoint, until_caught_up=True))


def current_airports(rows: DataFrame) -> DataFrame:
    """The newest row per ``_id`` over all batches."""
    latest = dedup.latest_by(rows, ["_id"], dedup.ARRIVAL_ORDER)
    return latest.select(*schemas.AIRPORTS_TABLE)


def current_children(
    rows: DataFrame, documents: DataFrame, table: dict[str, str]
) -> DataFrame:
    """Children from the newest message of each key over all batches.

    A newer message without children removes those of an older one. Rows are
    matched to the newest message positions, one narrow row per message key, and
    never ranked within an airport, so an airport with very many children stays
    spread out.
    """
    newest = documents.groupBy("airport_id", "key").agg(
        F.max(dedup.arrival_order()).alias("newest")
    )
    row, top = rows.alias("row"), newest.alias("top")
    same_message = (
        (F.col("row.airport_id") == F.col("top.airport_id"))
        & F.col("row.key").eqNullSafe(F.col("top.key"))
        & (F.struct(*[F.col(f"row.{c}") for c in dedup.ARRIVAL_ORDER]) == F.col("top.newest"))
    )
    return row.join(top, same_message, "left_semi").select(*table)


def ingested_airports(spark: SparkSession, sink: ReadableSink) -> dict[str, DataFrame]:
    """Current state of the three airport tables a job has written."""
    stored = {
        name: sink.read(spark, name, schemas.ddl_row(fields | MESSAGE_POSITION))
        for name, fields in (
            ("airports", schemas.AIRPORTS_TABLE),
            ("frequencies", schemas.FREQUENCIES_TABLE),
            ("runways", schemas.RUNWAYS_TABLE),
            (DOCUMENTS, {"airport_id": "string"}),
        )
    }
    return {"airports": current_airports(stored["airports"])} | {
        name: current_children(stored[name], stored[DOCUMENTS], fields)
        for name, fields in (
            ("frequencies", schemas.FREQUENCIES_TABLE),
            ("runways", schemas.RUNWAYS_TABLE),
        )
    }
