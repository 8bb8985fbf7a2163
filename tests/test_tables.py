"""Table shapes, round trips, de-duplication."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from aeroflow import schemas
from aeroflow.operators import decode, dedup, flatten
from aeroflow.plans import build


def shape(frame):
    return {f.name: f.dataType.simpleString() for f in frame.schema.fields}


def test_table_shapes(messages):
    frame = messages([{"_id": "a"}])
    assert shape(build.airports_from_messages(frame)) == schemas.AIRPORTS_TABLE
    assert shape(flatten.frequencies_from_messages(frame)) == schemas.FREQUENCIES_TABLE
    assert shape(flatten.runways_from_messages(frame)) == schemas.RUNWAYS_TABLE
    assert shape(flatten.flights_from_messages(frame)) == schemas.FLIGHTS_TABLE
    sizes = [len(t) for t in (schemas.AIRPORTS_TABLE, schemas.FREQUENCIES_TABLE,
                              schemas.RUNWAYS_TABLE, schemas.FLIGHTS_TABLE)]
    assert sizes == [23, 8, 15, 40]


def test_constant_and_audit_columns(messages):
    (row,) = build.airports_from_messages(messages([{"_id": "a"}])).collect()
    assert (row["geoid_height"], row["hae"], row["v_version"]) == (0, 0, 1)
    assert row["created_by"] == row["updated_by"] == "spark"
    assert row["created_at"] == row["updated_at"] is not None
    assert row["traffic_type"] is None and row["magnetic_declination"] is None
    (runway,) = flatten.runways_from_messages(messages([{"_id": "a", "runways": [{}]}])).collect()
    assert runway["aligned_true_north"] is False and runway["main_runway"] is False
    assert runway["visual_approach_aids"] is None


text = st.text(st.characters(codec="utf-8", exclude_categories=["Cs", "Cc"]), max_size=8)
frequency = st.fixed_dictionaries(
    {}, optional={"_id": text, "name": text, "value": text, "unit": st.integers(0, 9),
                  "type": st.integers(0, 9), "primary": st.booleans(), "publicUse": st.booleans()}
)
runway = st.fixed_dictionaries(
    {}, optional={"_id": text, "designator": text, "takeOffOnly": st.booleans(),
                  "dimension": st.fixed_dictionaries({"length": st.fixed_dictionaries(
                      {"value": st.floats(0, 9000, allow_nan=False)})})}
)
airport = st.fixed_dictionaries(
    {"name": text},
    optional={
        "type": st.integers(0, 9), "country": text,
        "geometry": st.fixed_dictionaries({"type": st.just("Point"), "coordinates": st.lists(
            st.floats(-180, 180, allow_nan=False), max_size=3)}),
        "frequencies": st.none() | st.lists(frequency, max_size=4),
        "runways": st.none() | st.lists(runway, max_size=4),
    },
)


@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(st.lists(airport, min_size=1, max_size=12))
def test_any_airports_survive_the_round_trip(messages, docs):
    docs = [{"_id": f"id{i}"} | doc for i, doc in enumerate(docs)]
    frame = messages(docs)
    counts = build.count_tables(frame).first()
    expected = [len(docs)] + [sum(len(d.get(n) or []) for d in docs) for n in ("frequencies", "runways")]
    assert list(counts) == expected

    rows = {r["_id"]: r for r in build.airports_from_messages(frame).collect()}
    frequencies = flatten.frequencies_from_messages(frame).collect()
    assert len(frequencies) == expected[1]
    assert flatten.runways_from_messages(frame).count() == expected[2]
    for doc in docs:
        row = rows[doc["_id"]]
        assert (row["name"], row["type"], row["country"]) == (
            doc["name"], doc.get("type"), doc.get("country"))
        if "geometry" in doc:
            assert json.loads(row["geometry"]) == doc["geometry"]
        mine = sorted((f["name"] or "", f["value"] or "") for f in frequencies if f["airport_id"] == doc["_id"])
        sent = sorted((f.get("name") or "", f.get("value") or "") for f in doc.get("frequencies") or [])
        assert mine == sent


def some(fields):
    return st.fixed_dictionaries({}, optional={
        n: st.integers(-99, 999) if n == "delay" else text
        for n in fields if n not in schemas.STOP_TIME_FIELDS
    })


flight = st.fixed_dictionaries(
    {"flight": st.fixed_dictionaries({"iata": text}, optional={
        "number": text, "icao": text, "codeshared": st.none() | some(schemas.CODESHARE_FIELDS)})},
    optional={"flight_status": text, "airline": some(schemas.AIRLINE_FIELDS),
              "departure": some(schemas.DEPARTURE_FIELDS), "arrival": some(schemas.ARRIVAL_FIELDS),
              "flight_date": st.dates().map(str)},
)


def at(doc, *path):
    for name in path:
        doc = (doc or {}).get(name)
    return doc


@settings(max_examples=10, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(st.lists(flight, min_size=1, max_size=10))
def test_any_flights_survive_the_round_trip(messages, docs):
    for i, doc in enumerate(docs):
        doc["flight"]["number"] = f"no{i}"
    rows = flatten.flights_from_messages(messages([{"data": docs[1:]}, docs[0]])).collect()
    assert len(rows) == len(docs)
    for row in rows:
        doc = docs[int(row["flight_number"][2:])]
        assert (str(row["flight_date"]) if row["flight_date"] else None) == doc.get("flight_date")
        for group, names in (("departure", schemas.DEPARTURE_FIELDS), ("arrival", schemas.ARRIVAL_FIELDS),
                             ("airline", schemas.AIRLINE_FIELDS), ("flight", schemas.FLIGHT_NUMBER_FIELDS)):
            for name in names:
                assert row[f"{group}_{name}"] == at(doc, group, name)
        for name in schemas.CODESHARE_FIELDS:
            assert row[f"codeshared_{name}"] == at(doc, "flight", "codeshared", name)
        sent = {k: v for k, v in doc["flight"].items() if v is not None}
        assert json.loads(row["raw_json"])["flight"] == sent


def current(frame):
    parsed = decode.parse_airports(frame, ["_id", "frequencies"])
    return dedup.current_documents(decode.with_id(parsed), dedup.repeated_documents(parsed))


def test_only_documents_replace_documents(messages):
    sent = messages([("k1", {"_id": "a"}), ("k2", {"_id": "b"}), (None, {"_id": "c"}), (None, {"_id": "c"}), ("k3", {"_id": "d"})])
    again = messages([("k1", {"_id": "a"}), ("k2", "{oops"), ("k3", {"_id": "e"})], first_offset=10, wave=1)
    kept = current(sent.unionByName(again))
    assert sorted((r["_id"], r["offset"]) for r in kept.collect()) == [("a", 10), ("b", 1), ("c", 3), ("d", 4), ("e", 12)]


def test_batch_and_stream_agree_on_what_is_current(spark, messages, tmp_path):
    from aeroflow.sinks import ParquetSink
    from aeroflow.sources.topics import FileTopic
    from aeroflow.streaming import AIRPORT_JOB, ingest
    from aeroflow.streaming.ingest import ingested_airports

    def doc(key, *children):
        return {"_id": key, "frequencies": [{"_id": c} for c in children]}

    frame = messages([
        ("k", doc("a", "f1")), ("k", "{oops"), (None, doc("b", "g1", "g2")), (None, doc("b", "g1", "g2")),
        ("p/0", doc("c", "h1")), ("p/1", doc("c", "h2")), ("p/1", doc("c", "h3")), ("q", doc("d", "i")), ("q", doc("e", "j")),
    ])
    topic = FileTopic(str(tmp_path / "topic"))
    frame.write.parquet(topic.path)
    build.build_airports(frame, str(tmp_path / "tables"), str(tmp_path / "stage"))
    batch = spark.read.parquet(str(tmp_path / "tables" / "frequencies"))
    sink = ParquetSink(str(tmp_path / "sink"))
    ingest(spark, AIRPORT_JOB, topic, sink, str(tmp_path / "checkpoint"))
    streamed = ingested_airports(spark, sink)["frequencies"]
    expected = ["f1", "g1", "g2", "h1", "h3", "i", "j"]
    assert sorted(r["_id"] for r in batch.collect()) == sorted(r["_id"] for r in streamed.collect()) == expected


def test_dedup_takes_null_as_a_key(spark):
    rows = spark.createDataFrame(
        [(None, 1, 0, 1, "x"), (None, 1, 0, 2, "y"), ("a", 2, 0, 0, "z"), ("a", 1, 5, 9, "w")],
        "_id string, timestamp int, partition int, offset int, name string",
    )
    kept = dedup.latest_by(rows, ["_id"], dedup.ARRIVAL_ORDER).collect()
    assert {(r["_id"], r["name"]) for r in kept} == {(None, "y"), ("a", "z")}
    assert set(kept[0].asDict()) == set(rows.columns)


def test_enrichment(spark):
    rows = spark.createDataFrame([("K1", 1), (None, 2)], "icao_code string, n int")
    (row,) = flatten.clean_and_enrich(rows).collect()
    assert (row["n"], row["created_by"], row["v_version"]) == (1, "spark", 1)


def test_flights_without_a_date_are_stored(spark, messages, tmp_path):
    from aeroflow.sources.tables import read_table

    sent = [{"data": [{"flight_date": d, "flight": {"iata": d}} for d in ("2025-01-02", "bad")]}]
    build.build_flights(messages(sent), str(tmp_path))
    rows = read_table(spark, str(tmp_path), "flights").collect()
    assert {(r["flight_iata"], str(r["flight_date"])) for r in rows} == {
        ("2025-01-02", "2025-01-02"), ("bad", "None")}
