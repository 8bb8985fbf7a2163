"""Compaction: same rows before and after, old versions, crashes, jobs that share a sink."""

from __future__ import annotations

import pytest

from aeroflow import schemas
from aeroflow.sinks import CompactingSink, ParquetSink
from aeroflow.streaming import FLIGHT_JOB
from aeroflow.streaming.ingest import write_batch

DDL = schemas.ddl_row(schemas.FLIGHTS_TABLE)


def page(*names, day="2025-10-21", iata="JFK"):
    return {"data": [{"flight_date": day, "flight": {"iata": n}, "departure": {"iata": iata, "scheduled": f"{day}T08:00:00+00:00"}} for n in names]}


@pytest.fixture
def sink(tmp_path):
    return CompactingSink(str(tmp_path / "sink"))


@pytest.fixture
def send(spark, messages, sink, tmp_path):
    def run(batch, *pages, job="flights-1", to=sink):
        parsed = FLIGHT_JOB.parse(messages(list(pages), first_offset=10 * batch))
        write_batch(FLIGHT_JOB, to, parsed, batch, str(tmp_path / "stage"), job)

    return run


def names(rows):
    return sorted(r["flight_iata"] for r in rows.select("flight_iata").collect())


def test_rows_stay_and_files_become_fewer(spark, send, sink):
    assert names(sink.read(spark, "flights", DDL)) == []
    assert sink.compact(spark, "flights", DDL).version == 0
    for batch in range(5):
        send(batch, page(f"A{batch}", f"B{batch}"), page(f"C{batch}", day="2025-11-01"))
    before = sink.read(spark, "flights", DDL)
    plain = ParquetSink(sink.root).read(spark, "flights", DDL)
    want = sorted(map(str, plain.select(*before.columns).collect()))
    assert sorted(map(str, before.collect())) == want
    manifest = sink.compact(spark, "flights", DDL)
    assert manifest.version == 1 and manifest.last_batch == {"flights-1": 4}
    assert len(manifest.files) < len(plain.inputFiles())
    after = sink.read(spark, "flights", DDL)
    assert sorted(map(str, after.collect())) == want
    assert not set(after.inputFiles()) & set(plain.inputFiles())  # the batch folders are no longer looked at
    assert sorted(map(str, before.collect())) == want  # a reader from before goes on
    assert sink.compact(spark, "flights", DDL).version == 1  # nothing new


def test_batches_after_a_version_and_older_versions(spark, send, sink):
    send(0, page("A"))
    sink.compact(spark, "flights", DDL)
    send(1, page("B"))
    send(0, page("X"), job="flights-2")  # another job on the same sink
    send(2, "{no page")
    assert names(sink.read(spark, "flights", DDL)) == ["A", "B", "X"]
    assert sink.compact(spark, "flights", DDL, small_file=0).last_batch == {"flights-1": 2, "flights-2": 0}
    send(3, page("C"))
    assert names(sink.read(spark, "flights", DDL)) == ["A", "B", "C", "X"]
    assert names(sink.read_version(spark, "flights", DDL, 2)) == ["A", "B", "X"]
    assert names(sink.read_version(spark, "flights", DDL, 1)) == ["A"]
    assert names(sink.read_version(spark, "flights", DDL, 0)) == []
    with pytest.raises(ValueError):
        sink.read_version(spark, "flights", DDL, 9)
    assert sink.read(spark, "rejects", "raw string").count() == 1


def test_a_replayed_batch_after_compaction_adds_nothing(spark, send, sink):
    send(0, page("A"))
    sink.compact(spark, "flights", DDL)
    send(0, page("A"))
    assert names(sink.read(spark, "flights", DDL)) == ["A"]


class CrashingSink(CompactingSink):
    def _publish(self, *args):
        raise OSError("lost the driver")


def test_a_crash_before_publishing_changes_nothing(spark, send, sink):
    send(0, page("A"))
    send(1, page("B"))
    with pytest.raises(OSError):
        CrashingSink(sink.root).compact(spark, "flights", DDL)
    assert sink.manifest(spark, "flights").version == 0
    assert names(sink.read(spark, "flights", DDL)) == ["A", "B"]
    assert sink.compact(spark, "flights", DDL).version == 1
    assert names(sink.read(spark, "flights", DDL)) == ["A", "B"]


def test_a_second_compaction_of_one_version_fails(spark, send, sink):
    send(0, page("A"))
    manifest = sink.compact(spark, "flights", DDL)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sink._publish(spark, "flights", 1, manifest.files, manifest.last_batch)


class FailingSink(CompactingSink):
    def commit(self, audit, job, batch_id):
        raise OSError("disk full")


def test_uncommitted_batches_are_not_compacted(spark, send, sink):
    send(0, page("A"))
    with pytest.raises(OSError):
        send(1, page("B"), to=FailingSink(sink.root))
    assert sink.compact(spark, "flights", DDL).last_batch == {"flights-1": 0}
    assert names(sink.read(spark, "flights", DDL)) == ["A"]
    send(1, page("B"))
    assert names(sink.read(spark, "flights", DDL)) == ["A", "B"]


def test_files_that_no_version_needs(spark, send, sink):
    assert sink.unreferenced(spark, "flights").count() == 0
    send(0, page("A"))
    sink.compact(spark, "flights", DDL)
    send(1, page("B"))
    sink.compact(spark, "flights", DDL)
    send(2, page("C"))
    dropped = {r["file"] for r in sink.unreferenced(spark, "flights").collect()}
    assert len([f for f in dropped if "/batch_id=" in f]) == 2 and len([f for f in dropped if "/run=" in f]) == 1
    assert not dropped & set(sink.read(spark, "flights", DDL).inputFiles())
    assert dropped > {r["file"] for r in sink.unreferenced(spark, "flights", keep=2).collect()}
