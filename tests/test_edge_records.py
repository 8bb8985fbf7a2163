"""Hand-written messages: what is kept, what is set aside, what becomes NULL."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from aeroflow.operators import decode, flatten
from aeroflow.plans import build


def airports(messages_frame):
    return {r["_id"]: r for r in build.airports_from_messages(messages_frame).collect()}


@pytest.mark.parametrize(
    "value, reason",
    [
        (None, "empty"),
        ("", "empty"),
        ("   ", "empty"),
        ("{oops", "malformed"),
        ("{}", "missing_id"),
        ('[{"_id":"a"}]', "missing_id"),
        ('{"name":"no id"}', "missing_id"),
    ],
)
def test_airport_rejects(messages, value, reason):
    frame = messages([value])
    (reject,) = decode.airport_rejects(frame).collect()
    assert (reject["raw"], reject["reason"], reject["offset"]) == (value, reason, 0)
    assert build.airports_from_messages(frame).count() == 0
    assert flatten.frequencies_from_messages(frame).count() == 0


def test_bad_fields_become_null_and_the_row_stays(messages):
    rows = airports(messages([
        '{"_id":"a","type":"x","elevation":{"value":"z"}}',
        '{"_id":5,"type":1.5}',
    ]))
    assert rows["a"]["type"] is None and rows["a"]["elevation_value"] is None
    assert rows["5"]["type"] is None


def test_absent_and_empty_children(messages):
    frame = messages([{"_id": "q", "frequencies": [], "runways": None}, {"_id": "r"}])
    assert set(airports(frame)) == {"q", "r"}
    assert flatten.frequencies_from_messages(frame).count() == 0
    assert flatten.runways_from_messages(frame).count() == 0
    counts = build.count_tables(frame).first()
    assert tuple(counts) == (2, 0, 0)


def test_short_coordinates(messages):
    frame = messages([{"_id": "g", "geometry": {"type": "Point", "coordinates": [1.0]}}])
    (row,) = flatten.with_position(build.airports_from_messages(frame)).collect()
    assert (row["latitude"], row["longitude"]) == (None, 1.0)


def test_frequency_text_keeps_its_decimals(spark, messages):
    from aeroflow.plans.airports import total_value

    frame = messages([{"_id": "f", "frequencies": [{"value": "118.700"}, {"value": "abc"}]}])
    rows = flatten.frequencies_from_messages(frame)
    assert {r["value"] for r in rows.collect()} == {"118.700", "abc"}
    assert str(total_value(rows).first()[0]) == "118.70000000"


def test_runway_without_dimensions(messages):
    frame = messages([{"_id": "w", "runways": [{"_id": "1", "dimension": {}}, {"_id": "2"}]}])
    rows = flatten.runways_from_messages(frame).collect()
    assert [r["dimension"] for r in rows] == ["{}", "{}"]
    assert [r["surface"] for r in rows] == [None, None]


def test_one_row_per_airport_and_the_newest_wins(messages):
    frame = messages([{"_id": "a", "name": "old"}, {"_id": "a", "name": "new"}])
    assert airports(frame)["a"]["name"] == "new"


@pytest.mark.parametrize("value", ['{"data":[]}', '{"data":null}', "{}", "{oops", None])
def test_messages_without_flights(messages, value):
    frame = messages([value])
    assert flatten.flights_from_messages(frame).count() == 0
    assert decode.flight_rejects(frame).count() == 1


def test_page_and_bare_flight_give_the_same_row(messages):
    flight = {"flight_date": "2025-10-21", "flight": {"iata": "AF1"}, "departure": {"iata": "JFK"}}
    page, bare = (
        flatten.flights_from_messages(messages([v])).collect() for v in ({"data": [flight]}, flight)
    )
    assert page == bare and len(page) == 1
    assert page[0]["flight_iata"] == "AF1"


def test_flight_values(messages):
    flight = {
        "flight_date": "2025-13-40",
        "departure": {"scheduled": "2025-10-21T06:30:00+02:00", "delay": 7},
        "arrival": {"estimated": "soon"},
        "aircraft": {"iata": "B738", "n": [1]},
        "unknown": {"x": 1},
    }
    rows = flatten.flights_from_messages(messages([{"data": [flight]}]))
    row = rows.withColumn("departure_scheduled", F.col("departure_scheduled").cast("timestamp_ntz")).first()
    assert row["flight_date"] is None
    assert row["departure_scheduled"] == dt.datetime(2025, 10, 21, 4, 30)
    assert row["arrival_estimated"] is None
    raw = json.loads(row["raw_json"])
    assert json.loads(raw["aircraft"]) == {"iata": "B738", "n": [1]}
    assert raw["aircraft"] == '{"iata":"B738","n":[1]}'
    assert "unknown" not in raw and "live" not in raw


def test_results_do_not_depend_on_ansi_mode(spark, messages):
    frame = messages([
        {"data": [{"flight_date": "bad", "departure": {"scheduled": "bad"}}]}, '{"data":null}'
    ])
    results = []
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            results.append((
                flatten.flights_from_messages(frame).collect(),
                decode.flight_rejects(frame).collect(),
            ))
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")
    assert results[0] == results[1]


def test_large_amounts_are_summed_and_bad_ones_counted(messages):
    from aeroflow.plans.airports import total_value, uncastable

    values = ["12345678901234567890", "1234567890123", "1.5", "0.00000049", "1,5", " ", None]
    rows = flatten.frequencies_from_messages(messages([{"_id": "f", "frequencies": [{"value": v} for v in values]}]))
    assert str(total_value(rows).first()[0]) == "12345680135802458014.50000049"
    assert [tuple(r) for r in uncastable(rows, "value").collect()] == [("value", 5, 1)]


def test_one_bad_child_costs_one_child(messages):
    frame = messages([
        {"_id": "a", "runways": [{"_id": "r1"}, 7, None, {"_id": "r2"}], "frequencies": {"_id": "solo"}},
        {"_id": "b", "runways": "x", "frequencies": [{"_id": "f"}]},
        {"_id": "c", "type": "x", "runways": [{"_id": "r3"}]},
        {"_id": "d", "runways": [{"_id": "r4"}]},
    ])
    assert {r["_id"] for r in flatten.runways_from_messages(frame).collect()} >= {"r1", "r2", "r3", "r4"}
    assert {r["_id"] for r in flatten.frequencies_from_messages(frame).collect()} == {"solo", "f"}
    assert set(airports(frame)) == {"a", "b", "c", "d"}
    rejects = decode.airport_rejects(frame).collect()
    assert {(r["offset"], r["reason"]) for r in rejects} == {(0, "bad_field"), (1, "bad_field"), (2, "bad_field")}
    assert all(r["raw"] for r in rejects)


def test_no_flights_are_made_up(messages):
    flight = {"flight": {"iata": "A"}}
    frame = messages([{"data": [None, {}]}, {"data": [flight, {}, None]}, {"data": [flight, 7]}, {"data": [flight]}])
    rows = flatten.flights_from_messages(frame).collect()
    assert [r["flight_iata"] for r in rows] == ["A", "A", "A"]
    rejects = {(r["offset"], r["reason"]) for r in decode.flight_rejects(frame).collect()}
    assert rejects == {(0, "no_flights"), (1, "bad_field"), (2, "bad_field")}
