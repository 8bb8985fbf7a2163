"""Panels merged from partial sums, sketches, and airports that are written once."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import functions as F

from aeroflow import schemas
from aeroflow.operators import decode, flatten
from aeroflow.plans import flights as plans
from aeroflow.sinks import CompactingSink, ParquetSink
from aeroflow.sources.topics import FileTopic
from aeroflow.streaming import PANEL_JOB, current_job, ingest, panels, run_to_end, start
from aeroflow.streaming.ingest import current_airports, write_batch

AIRPORTS = schemas.ddl_row(schemas.AIRPORTS_TABLE | {"key": "binary", "partition": "int", "offset": "bigint", "timestamp": "timestamp"})


def flight(i, day="2025-10-21", iata="JFK", status="landed", delay=None, airline=None):
    return {"flight_date": day, "flight_status": status, "departure": {"iata": iata, "delay": delay}, "airline": {"name": airline}, "flight": {"iata": f"F{i}"}}


def batches():
    return [
        [{"data": [flight(1, delay=5, airline="a"), flight(2, iata="CDG"), flight(3, day="no date")]}, "{oops"],
        [{"data": [flight(4, day="2024-01-01", delay=7, airline="b"), flight(5, status=None)]}],  # late by a year
        [flight(6, delay=90, airline="a"), {"data": []}, None],
        [{"data": [{"arrival": {"iata": "X"}}, {"departure": {"iata": "JFK", "delay": "bad"}}, flight(7, day=None, airline="c")]}],
    ]


def test_merged_sums_are_those_of_all_flights(spark, messages, tmp_path):
    sink = CompactingSink(str(tmp_path / "sink"))
    sent = [messages(values, first_offset=10 * i) for i, values in enumerate(batches())]

    def write(i):
        write_batch(PANEL_JOB, sink, PANEL_JOB.parse(sent[i]), i, str(tmp_path / "stage"))

    def check(n):
        pages = decode.parse_flight_pages(sent[0].limit(0) if not n else reduce(lambda a, b: a.unionByName(b), sent[:n]))
        rows = flatten.flatten_flights(decode.split_flights(pages))
        sums = panels.merged(spark, sink, panels.DAY_SUMS)
        assert panels.departures_per_day(sums).collect() == plans.departures_per_day(rows).collect()
        assert panels.avg_departure_delay(sums).collect() == plans.avg_departure_delay(rows).collect()
        assert sorted(map(str, panels.flights_by_status(sums).collect())) == sorted(map(str, plans.flights_by_status(rows).collect()))
        return sums

    check(0)
    for i in range(2):
        write(i)
    check(2)
    panels.compact_panels(spark, sink)
    sums = check(2)
    files = sink.manifest(spark, panels.DAY_SUMS).files
    assert len(files) == 1 and sums.count() == spark.read.parquet(files[0][0]).count()
    write(1)  # a replay
    check(2)
    for i in range(2, 4):
        write(i)
    check(4)
    panels.compact_panels(spark, sink)
    check(4)


def test_unions_of_sketches_estimate_all_rows(spark, messages):
    values = [{"data": [flight(i * 100 + j, status="ab"[j % 2], airline=f"air{(i * j) % 37}") for j in range(100)]} for i in range(60)]
    pages = PANEL_JOB.parse(messages(values))
    parts = [decode.split_flights(pages.where(F.col("offset") % 7 == r)) for r in range(7)]
    sketches = [panels.status_sketches(p) for p in parts]

    def union(frames):
        return panels.merge_status_sketches(reduce(lambda a, b: a.unionByName(b), frames))

    # An estimate depends a little on the grouping, but is always within the error.
    for grouped in (union(sketches), union([union(sketches[4:]), union(sketches[:4][::-1])])):
        stats = {r["flight_status"]: r for r in panels.status_stats(grouped).collect()}
        assert {s: (r["n_flights"], r["n_airlines"]) for s, r in stats.items()} == {"a": (3000, 37), "b": (3000, 37)}
        assert all(abs(r["n_flight_numbers"] / 3000 - 1) < 4 * 0.0082 for r in stats.values())


def airport(name, key="a", **more):
    return {"_id": key, "name": name, **more}


class Stream:
    def __init__(self, spark, tmp_path, kept_ms=10**9):
        self.spark, self.job = spark, current_job(kept_ms)
        self.topic = FileTopic(str(tmp_path / "topic"), max_files_per_trigger=1)
        self.sink, self.checkpoint = ParquetSink(str(tmp_path / "sink")), str(tmp_path / "checkpoint")

    def send(self, frame):
        frame.coalesce(1).write.mode("append").parquet(self.topic.path)

    def run(self):
        return run_to_end(start(self.spark, self.job, self.topic, self.sink, self.checkpoint, until_caught_up=True))

    def rows(self):
        return [r["name"] for r in self.sink.read(self.spark, "airports", AIRPORTS).orderBy("timestamp", "offset").collect()]

    def current(self):
        return {r["_id"]: r["name"] for r in current_airports(self.sink.read(self.spark, "airports", AIRPORTS)).collect()}


def test_resends_over_batches_and_a_restart_give_one_row(spark, messages, tmp_path):
    stream = Stream(spark, tmp_path)
    stream.send(messages([airport("A"), airport("A"), airport("B", "b", country="FR"), "{oops", None]))
    stream.send(messages([airport("A", frequencies=[{"_id": "f"}])], first_offset=10, wave=1))
    stream.run()
    stream.send(messages([airport("B", "b", country="FR"), airport("A")], first_offset=20, wave=2))
    stream.run()
    assert sorted(stream.rows()) == ["A", "B"]
    assert stream.current() == {"a": "A", "b": "B"}


def test_changes_and_messages_out_of_order(spark, messages, tmp_path):
    stream = Stream(spark, tmp_path)
    for wave, name in ((1, "A"), (3, "B"), (2, "stale"), (4, "A"), (5, "A")):
        stream.send(messages([airport(name)], first_offset=wave, wave=wave))
        stream.run()
    assert stream.rows() == ["A", "B", "A"]
    assert stream.current() == {"a": "A"}


def test_state_holds_what_was_heard_of_lately(spark, messages, tmp_path):
    stream = Stream(spark, tmp_path, kept_ms=1)
    held = []
    for i in range(4):
        stream.send(messages([airport(f"N{i}-{j}", f"{i}-{j}") for j in range(20)], first_offset=100 * i, wave=i))
        query = stream.run()
        held += [p["stateOperators"][0]["numRowsTotal"] for p in map(lambda p: json.loads(p.json), query.recentProgress) if p["stateOperators"]]
    assert len(stream.rows()) == 80
    assert max(held) <= 40  # never all 80


def test_parse_of_few_fields_keeps_the_same_flights(spark, messages):
    sent = messages([v for batch in batches() for v in batch])
    few = decode.split_flights(decode.parse_flight_pages(sent, panels.PANEL_DOC))
    every = decode.split_flights(decode.parse_flight_pages(sent))
    columns = ("f.flight_date", "f.departure.iata", "f.departure.delay", "f.flight.iata")
    assert sorted(map(str, few.select(*columns).collect())) == sorted(map(str, every.where("f.arrival is null").select(*columns).collect()))
