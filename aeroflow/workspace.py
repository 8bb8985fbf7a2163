"""Topics and tables derived from one folder of given tables.

Topics are generated once per Spark application and folder, and written to the
shared folder; tables are built from the topics in the same way a backfill
would. Queries then scan stored, column-pruned tables.
"""

from __future__ import annotations

import hashlib
import threading
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroflow import schemas
from aeroflow.operators import decode
from aeroflow.plans import build
from aeroflow.session import prepare, shared_dir
from aeroflow.sinks import CompactingSink, FileTopicSink, ParquetSink
from aeroflow.sources import generated
from aeroflow.sources.tables import read_table
from aeroflow.sources.topics import FileTopic
from aeroflow.streaming import AIRPORT_JOB, FLIGHT_JOB, PANEL_JOB, LandedTopic, current_job, ingest
from aeroflow.streaming.ingest import Job
from aeroflow.streaming.panels import compact_panels

TOPICS = {
    generated.FLIGHTS_TOPIC: generated.flight_messages,
    generated.AIRPORTS_TOPIC: generated.airport_messages,
    generated.STRAY_TOPIC: generated.stray_messages,
}
JOBS = {
    generated.FLIGHTS_TOPIC: FLIGHT_JOB,
    generated.AIRPORTS_TOPIC: AIRPORT_JOB,
    generated.STRAY_TOPIC: AIRPORT_JOB,
}


# Parts of a topic that is read as it grows, and positions looked at to cut it into near equal ones.
BATCHES = 6
POSITIONS = 20_000


def time_ranges(records: DataFrame, parts: int = BATCHES) -> list[Column]:
    """Tests that each take a range of send times and offsets; every record passes just one.

    Only positions of some records are looked at to choose the bounds. The tests are plain
    comparisons, which Parquet row-group statistics can answer.
    """
    position = ["timestamp", "offset"]
    some = records.select(*position)
    share = POSITIONS / max(some.count(), 1)
    if share < 1:
        some = some.sample(share, seed=0)
    known = sorted(tuple(r) for r in some.where(F.col("timestamp").isNotNull() & F.col("offset").isNotNull()).collect())
    bounds = sorted({known[len(known) * i // parts] for i in range(1, parts)}) if known else []
    time, offset = F.col("timestamp"), F.col("offset")

    def from_(bound: tuple) -> Column:
        return (time > bound[0]) | ((time == bound[0]) & (offset >= bound[1]))

    def before(bound: tuple) -> Column:  # NULL comes first
        return time.isNull() | (time < bound[0]) | ((time == bound[0]) & (offset.isNull() | (offset < bound[1])))

    tests = []
    for low, high in zip([None, *bounds], [*bounds, None], strict=True):
        ends = [from_(low)] if low else []
        ends += [before(high)] if high else []
        tests.append(reduce(and_, ends, F.lit(True)))
    return tests


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = prepare(spark)
        self.sf_dir = sf_dir.rstrip("/")
        folder = hashlib.sha256(self.sf_dir.encode()).hexdigest()[:12]
        self.root = shared_dir(spark, f"workspace-{folder}")
        self._done: set[str] = set()
        self._frames: dict[str, DataFrame] = {}
        self._lock = threading.RLock()

    def _once(self, step: str, run: Callable[[], object]) -> None:
        with self._lock:
            if step not in self._done:
                run()
                self._done.add(step)

    def _frame(self, name: str, read: Callable[[], DataFrame]) -> DataFrame:
        """One frame per stored table, so that its files are listed once."""
        with self._lock:
            if name not in self._frames:
                self._frames[name] = read()
            return self._frames[name]

    def given(self, name: str) -> DataFrame:
        return generated.table(self.spark, self.sf_dir, name)

    def topic(self, name: str) -> FileTopic:
        path = f"{self.root}/topics/{name}"

        def publish() -> None:
            records = TOPICS[name](self.spark, self.sf_dir)
            # In offset order within a file, as a topic is: replays skip row groups.
            in_order = records.sortWithinPartitions("partition", "offset")
            FileTopicSink(path).publish(in_order, "overwrite")

        self._once(f"topic {name}", publish)
        return FileTopic(path)

    def messages(self, name: str) -> DataFrame:
        topic = self.topic(name)
        return self._frame(f"topic {name}", lambda: topic.read(self.spark))

    def repeated_airports(self) -> DataFrame:
        """Which airport documents were sent more than once."""
        path = f"{self.root}/scratch/repeated_airports"

        def store() -> None:
            build.store_repeats(decode.parse_airports(self.messages(generated.AIRPORTS_TOPIC), ["_id"]), path)

        self._once("repeats", store)
        return self._frame("repeats", lambda: self.spark.read.parquet(path))

    def build(self, topic: str) -> None:
        if topic == generated.FLIGHTS_TOPIC:
            build.build_flights(self.messages(topic), f"{self.root}/tables")
        else:
            build.build_airports(self.messages(topic), f"{self.root}/tables", f"{self.root}/scratch/airports")

    def table(self, name: str) -> DataFrame:
        topic = generated.FLIGHTS_TOPIC if name == "flights" else generated.AIRPORTS_TOPIC
        self._once(f"tables {topic}", lambda: self.build(topic))
        tables = f"{self.root}/tables"
        return self._frame(f"table {name}", lambda: read_table(self.spark, tables, name))

    def positions(self) -> DataFrame:
        """Airport positions in the order of their cells."""
        path = f"{self.root}/tables/positions"
        self._once("positions", lambda: build.store_positions(self.table("airports"), path))
        return self._frame("positions", lambda: self.spark.read.parquet(path))

    def landed(self) -> FileTopic:
        """Flight pages, landed as a file each in two visits and taken in after each."""
        landed = LandedTopic(f"{self.root}/landing/pages", f"{self.root}/landing/topic", "pages", max_files=2_000)

        def run() -> None:
            pages = self.messages(generated.FLIGHTS_TOPIC)
            for visit in range(2):
                some = pages.where(F.col("offset") % 2 == visit).select(F.col("value").cast("string").alias("value"))
                # Each task moves its own files into the folder; by default the driver moves all of them.
                visitor = some.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2")
                visitor.option("maxRecordsPerFile", 1).text(landed.folder)
                landed.update(self.spark)

        self._once("landed", run)
        return landed.records()

    def flights_by_month(self) -> DataFrame:
        """Flights with their month folder, by which time ranges leave folders out."""
        self.table("flights")
        tables = f"{self.root}/tables"
        return self._frame("flights by month", lambda: read_table(self.spark, tables, "flights", with_folder=True))

    def ingested(self, topic: str) -> ParquetSink:
        """The sink of a streaming job that has read the whole topic.

        The flight and the airport job write to the same tables, as they would in production.
        """
        tables = "tables" if topic != generated.STRAY_TOPIC else topic
        sink = ParquetSink(f"{self.root}/ingested/{tables}")
        checkpoint = f"{self.root}/checkpoints/{topic}"

        def run() -> None:
            ingest(self.spark, JOBS[topic], self.topic(topic), sink, checkpoint)

        self._once(f"stream {topic}", run)
        return sink

    def ingest_growing(self, topic: str, job: Job, sink: ParquetSink, name: str) -> None:
        """Runs a job again each time its copy of a topic has grown by a range of send times: re-sends come later.

        A range is one batch in files of many tasks. Rows are not shuffled: each range is read from
        the topic, whose row groups it skips.
        """
        records, copy = self.messages(topic), FileTopic(f"{self.root}/topics/{topic}-{name}")
        for within in time_ranges(records):
            FileTopicSink(copy.path).publish(records.where(within))
            ingest(self.spark, job, copy, sink, f"{self.root}/checkpoints/{name}")

    def compacted_flights(self) -> CompactingSink:
        """The sink of a flight job that ran in many batches, compacted after the first run."""
        sink = CompactingSink(f"{self.root}/compacted/flights")

        def run() -> None:
            self.ingest_growing(generated.FLIGHTS_TOPIC, FLIGHT_JOB, sink, "compacted")
            sink.compact(self.spark, "flights", schemas.ddl_row(schemas.FLIGHTS_TABLE))

        self._once("compacted flights", run)
        return sink

    def panels(self) -> CompactingSink:
        """Panel sums of many batches: compacted, and then given the strays of another job on top."""
        sink = CompactingSink(f"{self.root}/panels")

        def run() -> None:
            self.ingest_growing(generated.FLIGHTS_TOPIC, PANEL_JOB, sink, "panels")
            compact_panels(self.spark, sink)
            self.ingest_growing(generated.STRAY_TOPIC, PANEL_JOB, sink, "panel-strays")

        self._once("panels", run)
        return sink

    def current(self) -> ParquetSink:
        """The sink of the job that keeps one row per airport, stopped after each batch and started again."""
        sink = ParquetSink(f"{self.root}/current")

        def run() -> None:
            self.ingest_growing(generated.AIRPORTS_TOPIC, current_job(), sink, "current")

        self._once("current", run)
        return sink


_open: dict[tuple[str, str], Workspace] = {}
_open_lock = threading.Lock()


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    """The workspace of this application for a folder; settings are applied again."""
    prepare(spark)
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _open_lock:
        if key not in _open:
            _open[key] = Workspace(spark, sf_dir)
        return _open[key]
