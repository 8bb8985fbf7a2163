"""The ingest jobs: same rows as a batch, restarts, failures, replays, repeats."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from aeroflow import schemas
from aeroflow.operators import flatten
from aeroflow.plans import build
from aeroflow.sinks import ParquetSink
from aeroflow.sources.topics import FileTopic, LandingFolder
from aeroflow.streaming import AIRPORT_JOB, FLIGHT_JOB, ingest, run_to_end, start
from aeroflow.streaming.health import batch_metrics, consumer_lag
from aeroflow.streaming.ingest import REJECTS, REJECTS_TABLE, BatchMismatch, ingested_airports, write_batch

FLIGHT = {"flight_date": "2025-10-21", "flight": {"iata": "AF1"}, "departure": {"iata": "JFK"}}


def airport(name, key="a", frequencies=(), runways=()):
    return {
        "_id": key, "name": name,
        "frequencies": [{"_id": f, "value": "1.5"} for f in frequencies],
        "runways": [{"_id": r} for r in runways],
    }


@pytest.fixture
def place(tmp_path):
    class Place:
        topic = FileTopic(str(tmp_path / "topic"), max_files_per_trigger=1)
        sink = ParquetSink(str(tmp_path / "sink"))
        checkpoint = str(tmp_path / "checkpoint")
        stage = str(tmp_path / "stage")

        def send(self, frame):
            frame.coalesce(1).write.mode("append").parquet(self.topic.path)

    return Place()


def stored(spark, sink, table, fields):
    return sink.read(spark, table, schemas.ddl_row(fields)).select(*fields)


def flights_in(spark, sink):
    rows = stored(spark, sink, "flights", schemas.FLIGHTS_TABLE).collect()
    return sorted(r["flight_iata"] for r in rows)


def flights(*names):
    return {"data": [FLIGHT | {"flight": {"iata": n}} for n in names]}


def test_stream_equals_batch(spark, messages, place):
    first, second = messages([flights("A", "B"), "{oops"]), messages([flights("C")], first_offset=2)
    place.send(first)
    place.send(second)
    ingest(spark, FLIGHT_JOB, place.topic, place.sink, place.checkpoint)
    batch = flatten.flights_from_messages(first.unionByName(second))
    written = stored(spark, place.sink, "flights", schemas.FLIGHTS_TABLE)
    assert sorted(map(str, written.collect())) == sorted(map(str, batch.collect()))
    (reject,) = stored(spark, place.sink, REJECTS, REJECTS_TABLE).collect()
    assert (reject["raw"], reject["reason"], reject["offset"]) == ("{oops", "malformed", 1)


def test_restart_adds_nothing_and_later_messages_arrive(spark, messages, place):
    place.send(messages([flights("A")]))
    for _ in range(2):
        ingest(spark, FLIGHT_JOB, place.topic, place.sink, place.checkpoint)
        assert flights_in(spark, place.sink) == ["A"]
    place.send(messages([flights("B")], first_offset=1))
    ingest(spark, FLIGHT_JOB, place.topic, place.sink, place.checkpoint)
    assert flights_in(spark, place.sink) == ["A", "B"]


class FailingSink(ParquetSink):
    """Fails on one table after writing it."""

    def write(self, table, rows, job, batch_id):
        super().write(table, rows, job, batch_id)
        if table == "runways":
            raise OSError("disk full")


def test_a_failing_sink_loses_and_doubles_nothing(spark, messages, place):
    place.send(messages([airport("A", "a", ["f1", "f2"], ["r1"])]))
    broken = FailingSink(place.sink.root)
    with pytest.raises(StreamingQueryException):
        ingest(spark, AIRPORT_JOB, place.topic, broken, place.checkpoint)
    # Two tables are written, but the batch is not committed: readers see nothing.
    assert place.sink.read(spark, "airports", schemas.ddl_row(schemas.AIRPORTS_TABLE)).count() == 0

    ingest(spark, AIRPORT_JOB, place.topic, place.sink, place.checkpoint)
    tables = ingested_airports(spark, place.sink)
    assert {n: t.count() for n, t in tables.items()} == {"airports": 1, "frequencies": 2, "runways": 1}


def test_a_replayed_batch_is_written_once(spark, messages, place):
    parsed = AIRPORT_JOB.parse(messages([airport("A", "a", ["f1"])]))
    for _ in range(2):
        write_batch(AIRPORT_JOB, place.sink, parsed, 7, place.stage)
    rows = place.sink.read(spark, "frequencies", schemas.ddl_row(schemas.FREQUENCIES_TABLE))
    assert [r["batch_id"] for r in rows.collect()] == [7]


def test_children_are_kept_as_sent_and_current_ones_can_be_read(spark, messages, place):
    place.send(messages([("k", airport("old", "a", ["f1", "f2"], ["r1"])), ("x", airport("B", "b", ["g"]))]))
    place.send(messages([("k", airport("new", "a", ["f3"]))], first_offset=5, wave=1))
    ingest(spark, AIRPORT_JOB, place.topic, place.sink, place.checkpoint)

    appended = stored(spark, place.sink, "frequencies", schemas.FREQUENCIES_TABLE)
    assert sorted(r["_id"] for r in appended.collect()) == ["f1", "f2", "f3", "g"]
    assert stored(spark, place.sink, "airports", schemas.AIRPORTS_TABLE).count() == 3

    current = ingested_airports(spark, place.sink)
    assert {r["_id"]: r["name"] for r in current["airports"].collect()} == {"a": "new", "b": "B"}
    assert sorted(r["_id"] for r in current["frequencies"].collect()) == ["f3", "g"]
    assert current["runways"].count() == 0  # the newer document has none


def test_one_airport_in_several_messages_keeps_all_children(spark, messages, place):
    place.send(messages([("a/0", airport("A", "a", ["f1"]))]))
    place.send(messages([("a/1", airport("A", "a", ["f2"]))], first_offset=1, wave=1))
    ingest(spark, AIRPORT_JOB, place.topic, place.sink, place.checkpoint)
    current = ingested_airports(spark, place.sink)
    assert current["airports"].count() == 1
    assert sorted(r["_id"] for r in current["frequencies"].collect()) == ["f1", "f2"]


def test_empty_tables_are_not_written(spark, messages, place):
    write_batch(AIRPORT_JOB, place.sink, AIRPORT_JOB.parse(messages([airport("A", "a", ["f"])])), 0, place.stage)
    assert sorted(os.listdir(place.sink.root)) == ["airports", "documents", "frequencies", "ingest_audit"]
    write_batch(AIRPORT_JOB, place.sink, AIRPORT_JOB.parse(messages([])), 1, place.stage)
    assert place.sink.committed(spark, "airports", 1, AIRPORT_JOB.audit_ddl()).isEmpty()


def test_audit_rows_and_observed_metrics(spark, messages, place):
    place.send(messages([airport("A", "a", ["f1", "f2"], ["r"]), "{oops"]))
    query = ingest(spark, AIRPORT_JOB, place.topic, place.sink, place.checkpoint)
    (row,) = place.sink.audit(spark, AIRPORT_JOB.audit_ddl()).collect()
    assert (row["first_offset"], row["last_offset"], row["messages"]) == (0, 1, 2)
    assert (row["airports"], row["frequencies"], row["runways"], row["rejects"]) == (1, 2, 1, 1)
    assert row["flights"] is None
    (metrics,) = batch_metrics(query, "airports")
    assert {k: metrics[k] for k in ("messages", "documents", "frequencies", "runways", "rejects")} == {
        "messages": 2, "documents": 1, "frequencies": 2, "runways": 1, "rejects": 1}
    progress = json.loads(query.lastProgress.json)
    lag = consumer_lag(spark, progress["sources"]).collect()
    assert [r["lag"] for r in lag] == [None]  # a file source does not say what is there


def test_lag_of_kafka_positions(spark):
    sources = [{
        "description": "KafkaV2[Subscribe[flights]]",
        "endOffset": {"flights": {"0": 5, "1": 7}},
        "latestOffset": json.dumps({"flights": {"0": 9, "1": 7, "2": 3}}),
    }]
    rows = consumer_lag(spark, sources).orderBy("partition").collect()
    assert [(r["partition"], r["read_offset"], r["latest_offset"], r["lag"]) for r in rows] == [
        (0, 5, 9, 4), (1, 7, 7, 0), (2, None, 3, None)]


def test_a_running_query_can_be_stopped(spark, messages, place):
    place.send(messages([flights("A")]))
    query = start(spark, FLIGHT_JOB, place.topic, place.sink, place.checkpoint)
    try:
        query.processAllAvailable()
        assert flights_in(spark, place.sink) == ["A"]
        assert query.isActive
    finally:
        query.stop()
    run_to_end(query)


def test_two_jobs_share_a_sink(spark, messages, place, tmp_path):
    """In either order, with rejects of both."""
    for order in ((AIRPORT_JOB, FLIGHT_JOB), (FLIGHT_JOB, AIRPORT_JOB)):
        sink = ParquetSink(str(tmp_path / f"shared-{order[0].name}"))
        sent = {"airports": [airport("A", "a", ["f1"]), "{oops"], "flights": [flights("F"), "{}"]}
        for job in order:
            topic = FileTopic(str(tmp_path / f"{order[0].name}-{job.name}"))
            messages(sent[job.name], topic=job.name).coalesce(1).write.parquet(topic.path)
            ingest(spark, job, topic, sink, str(tmp_path / f"check-{order[0].name}-{job.name}"))
        assert flights_in(spark, sink) == ["F"]
        assert ingested_airports(spark, sink)["frequencies"].count() == 1
        assert {r["topic"] for r in stored(spark, sink, REJECTS, REJECTS_TABLE).collect()} == {"airports", "flights"}
        assert sink.audit(spark, FLIGHT_JOB.audit_ddl()).count() == 2


def test_a_new_checkpoint_adds_to_the_tables(spark, messages, place, tmp_path):
    place.send(messages([flights("A")]))
    ingest(spark, FLIGHT_JOB, place.topic, place.sink, place.checkpoint)
    other = FileTopic(str(tmp_path / "other"))
    messages([flights("B")]).write.parquet(other.path)
    ingest(spark, FLIGHT_JOB, other, place.sink, str(tmp_path / "second"))
    assert flights_in(spark, place.sink) == ["A", "B"]


def test_a_batch_number_with_other_messages_is_refused(spark, messages, place):
    write_batch(FLIGHT_JOB, place.sink, FLIGHT_JOB.parse(messages([flights("A")])), 0, place.stage)
    with pytest.raises(BatchMismatch):
        write_batch(FLIGHT_JOB, place.sink, FLIGHT_JOB.parse(messages([flights("B")], first_offset=9)), 0, place.stage)
    assert flights_in(spark, place.sink) == ["A"]


def test_an_airport_sent_twice_in_a_batch_counts_once(spark, messages, place):
    parsed = AIRPORT_JOB.parse(messages([airport("A", "a"), airport("B", "a"), airport("C", "c")]))
    write_batch(AIRPORT_JOB, place.sink, parsed, 0, place.stage)
    (row,) = place.sink.audit(spark, AIRPORT_JOB.audit_ddl()).collect()
    assert (row["documents"], row["airports"]) == (3, 2)
    assert stored(spark, place.sink, "airports", schemas.AIRPORTS_TABLE).count() == 2


def test_landed_pages_become_messages(spark, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "one.json").write_text(json.dumps(flights("A", "B"), indent=2))
    (pages / "two.json").write_text(json.dumps(flights("C")))

    os.utime(pages / "one.json", (1_700_000_000, 1_700_000_000))
    os.utime(pages / "two.json", (1_700_000_000, 1_700_000_000))
    sink = ParquetSink(str(tmp_path / "sink"))
    ingest(spark, FLIGHT_JOB, LandingFolder(str(pages), "landed"), sink, str(tmp_path / "checkpoint"))
    assert flights_in(spark, sink) == ["A", "B", "C"]
    (row,) = sink.audit(spark, FLIGHT_JOB.audit_ddl()).collect()
    assert (row["topic"], row["messages"], row["flights"]) == ("landed", 2, 3)
    assert row["first_offset"] < row["last_offset"]  # files of one instant are told apart

    single = ParquetSink(str(tmp_path / "single"))
    ingest(spark, FLIGHT_JOB, LandingFolder(str(pages), "landed", max_files=1), single, str(tmp_path / "checkpoint-1"))
    assert [r["messages"] for r in single.audit(spark, FLIGHT_JOB.audit_ddl()).collect()] == [1, 1]


def test_many_small_batches_equal_one_build(spark, small_dir, tmp_path):
    from aeroflow.workspace import workspace

    space = workspace(spark, small_dir)
    sent = space.messages("airports").withColumn("wave", F.col("timestamp"))
    topic = FileTopic(str(tmp_path / "topic"), max_files_per_trigger=1)
    for wave in [r["wave"] for r in sent.select("wave").distinct().orderBy("wave").collect()]:
        sent.where(F.col("wave") == wave).drop("wave").coalesce(1).write.mode("append").parquet(topic.path)
    sink = ParquetSink(str(tmp_path / "sink"))
    query = ingest(spark, AIRPORT_JOB, topic, sink, str(tmp_path / "checkpoint"))
    assert len(batch_metrics(query, "airports")) > 2
    current = ingested_airports(spark, sink)
    for name in ("airports", "frequencies", "runways"):
        drop = ("created_at", "updated_at")
        ours = sorted(map(str, current[name].drop(*drop).collect()))
        assert ours == sorted(map(str, space.table(name).drop(*drop).collect()))
    counted = build.count_tables(space.messages("airports"), space.repeated_airports())
    assert counted.first()["airports"] == len(
        current["airports"].collect())


def test_command_line(spark, messages, place, tmp_path):
    from aeroflow.sources.topics import KafkaTopic
    from aeroflow.streaming.__main__ import arguments, main, topic_of

    place.send(messages([flights("A", "B")]))
    sink = ParquetSink(str(tmp_path / "cli"))
    main(["flights", "--files", place.topic.path, "--tables", sink.root,
          "--checkpoint", place.checkpoint, "--once"])
    assert flights_in(spark, sink) == ["A", "B"]

    base = ["airports", "--tables", "t", "--checkpoint", "c"]
    args = arguments([*base, "--kafka", "broker:1", "--starting-offsets", "latest", "--max-offsets", "9"])
    assert topic_of(args) == KafkaTopic("broker:1", "airports", "latest", 9)
    with pytest.raises(SystemExit):
        arguments(base)
