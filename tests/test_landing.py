"""Landed pages as a topic."""

from __future__ import annotations

import os

import pytest

from aeroflow.sinks import ParquetSink
from aeroflow.streaming import FLIGHT_JOB, LandedTopic, ingest


def land(folder, names, time=1_700_000_000):
    os.makedirs(folder, exist_ok=True)
    for name in names:
        path = os.path.join(folder, name)
        with open(path, "w") as page:
            page.write('{"data": [{"flight": {"iata": "%s"}}]}' % name)
        os.utime(path, (time, time))


def rows(landed, spark):
    return sorted(landed.records().read(spark).collect(), key=lambda r: r["offset"])


@pytest.fixture
def landed(tmp_path):
    return LandedTopic(str(tmp_path / "pages"), str(tmp_path / "topic"), "pages", max_files=70)


def test_files_of_one_instant_have_positions_of_their_own(spark, landed):
    names = [f"p{i:04d}" for i in range(300)]
    land(landed.folder, names)
    landed.update(spark)
    found = rows(landed, spark)
    assert [r["offset"] for r in found] == list(range(300))
    assert len({r["timestamp"] for r in found}) == 1
    assert sorted(bytes(r["key"]).decode().rsplit("/", 1)[1] for r in found) == names
    assert all(name in bytes(r["value"]).decode() for r, name in ((r, bytes(r["key"]).decode().rsplit("/", 1)[1]) for r in found))


def test_later_visits_go_on_and_read_nothing_twice(spark, landed):
    land(landed.folder, [f"a{i}" for i in range(100)])
    landed.update(spark)
    landed.update(spark)
    first = rows(landed, spark)
    land(landed.folder, ["b0", "b1"], time=1_699_990_000)
    landed.update(spark)
    found = rows(landed, spark)
    assert found[:100] == first
    assert [bytes(r["key"]).decode()[-2:] for r in found[100:]] == ["b0", "b1"]
    assert [r["offset"] for r in found] == list(range(102))


@pytest.mark.parametrize("marked", [False, True])
def test_a_batch_that_runs_again_changes_nothing(spark, landed, monkeypatch, marked):
    land(landed.folder, [f"a{i}" for i in range(50)])
    landed.update(spark)
    land(landed.folder, [f"b{i}" for i in range(20)])
    take = LandedTopic._take

    def fails(self, batch, batch_id):
        if marked:
            take(self, batch, batch_id)
        else:  # the messages are there, the mark is not
            monkeypatch.setattr(LandedTopic, "_next_offset", lambda s, sp, b: None if b == batch_id else 50)
            batch.limit(7).write.parquet(f"{self.path}/messages/batch={batch_id}")
        raise OSError("lost")

    monkeypatch.setattr(LandedTopic, "_take", fails)
    with pytest.raises(Exception, match="lost"):
        landed.update(spark)
    monkeypatch.undo()
    before = rows(landed, spark) if marked else None
    landed.update(spark)
    found = rows(landed, spark)
    assert [r["offset"] for r in found] == list(range(70))
    assert before is None or found == before


def test_a_job_reads_the_topic(spark, landed, tmp_path):
    sink = ParquetSink(str(tmp_path / "sink"))
    for names in (["x", "y"], ["z"]):
        land(landed.folder, names)
        landed.update(spark)
        ingest(spark, FLIGHT_JOB, landed.records(), sink, str(tmp_path / "checkpoint"))
    found = sink.read(spark, "flights", "flight_iata string").collect()
    assert sorted(r["flight_iata"] for r in found) == ["x", "y", "z"]
