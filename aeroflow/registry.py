"""Every registered query, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeroflow import schemas
from aeroflow.functions import array_size, as_double, json_number
from aeroflow.operators import decode, flatten
from aeroflow.operators.numeric import sum_numeric
from aeroflow.plans import airports as ap
from aeroflow.plans import build
from aeroflow.plans import flights as fl
from aeroflow.session import fresh_dir
from aeroflow.sinks import FileTopicSink, ParquetSink, to_records
from aeroflow.sources import generated
from aeroflow.sources.generated import AIRPORTS_TOPIC, FLIGHTS_TOPIC, STRAY_TOPIC
from aeroflow.sources.tables import TABLES
from aeroflow.sources.topics import FileTopic, peek
from aeroflow.streaming import AIRPORT_JOB, FLIGHT_JOB
from aeroflow.streaming import panels as live
from aeroflow.streaming.health import unread
from aeroflow.streaming.ingest import (
    DOCUMENTS,
    MESSAGE_POSITION,
    REJECTS,
    REJECTS_TABLE,
    audit,
    ingested_airports,
)
from aeroflow.workspace import Workspace, workspace

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(build_frame: Callable[[Workspace], DataFrame]) -> Callable[[Workspace], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _zone_free(build_frame(workspace(spark, sf_dir)))

    QUERIES[build_frame.__name__] = run
    return build_frame


def _zone_free(rows: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock times, the form the given tables use."""
    return rows.withColumns(
        {
            f.name: F.col(f.name).cast("timestamp_ntz")
            for f in rows.schema.fields
            if isinstance(f.dataType, T.TimestampType)
        }
    )


def _doubles(rows: DataFrame, *names: str) -> DataFrame:
    return rows.withColumns({n: F.col(n).cast("double") for n in names})


# --- decode and flatten -----------------------------------------------------

AIRPORT_SCALARS = (
    "_id", "name", "icaoCode", "iataCode", "type", "country",
    "ppr", "private", "skydiveActivity", "winchOnly",
)


@query
def airports_parse(w: Workspace) -> DataFrame:
    parsed = decode.parse_airports(w.messages(AIRPORTS_TOPIC), flatten.AIRPORT_ROW_FIELDS)
    return parsed.select(
        *AIRPORT_SCALARS,
        F.get("geometry.coordinates", F.lit(1)).alias("latitude"),
        F.get("geometry.coordinates", F.lit(0)).alias("longitude"),
        F.col("elevation.value").alias("elevation_value"),
    )


FLAT_AIRPORT = (
    "_id", "name", "iata_code", "icao_code", "type", "country", "latitude", "longitude",
    "elevation_value", "elevation_unit", "elevation_reference_datum",
    "ppr", "private", "skydive_activity", "winch_only",
)


@query
def airports_flatten(w: Workspace) -> DataFrame:
    flat = build.airports_from_messages(w.messages(AIRPORTS_TOPIC))
    return flatten.with_position(flat).select(*FLAT_AIRPORT)


@query
def airports_dedup(w: Workspace) -> DataFrame:
    return build.current_fields(w.messages(AIRPORTS_TOPIC), "name")


def _frequency_rows(rows: DataFrame) -> DataFrame:
    return rows.withColumn("value", as_double(F.col("value")))


def _runway_rows(rows: DataFrame) -> DataFrame:
    return rows.select(
        "_id", "airport_id", "designator", "take_off_only", "landing_only", "pilot_ctrl_lighting",
        json_number(F.col("surface"), "$.mainComposite").cast("int").alias("surface_main"),
        json_number(F.col("dimension"), "$.length").alias("length"),
        json_number(F.col("dimension"), "$.width").alias("width"),
    )


@query
def frequencies_explode(w: Workspace) -> DataFrame:
    return _frequency_rows(flatten.frequencies_from_messages(w.messages(AIRPORTS_TOPIC), w.repeated_airports()))


@query
def runways_explode(w: Workspace) -> DataFrame:
    return _runway_rows(flatten.runways_from_messages(w.messages(AIRPORTS_TOPIC), w.repeated_airports()))


@query
def flights_flatten(w: Workspace) -> DataFrame:
    return flatten.flights_from_messages(w.messages(FLIGHTS_TOPIC)).drop("raw_json")


@query
def flights_timestamps(w: Workspace) -> DataFrame:
    return flatten.flights_from_messages(w.messages(FLIGHTS_TOPIC)).select(
        "flight_iata", "departure_scheduled", "departure_actual",
        "arrival_scheduled", "arrival_estimated",
    )


@query
def flights_raw_json(w: Workspace) -> DataFrame:
    paths = {
        "raw_flight_iata": "$.flight.iata",
        "raw_gate": "$.departure.gate",
        "raw_aircraft": "$.aircraft",
    }
    records = w.table("flights").select("flight_iata", F.col("raw_json").alias("record"))
    return decode.extract_paths(records, paths, "flight_iata")


@query
def batch_counts(w: Workspace) -> DataFrame:
    return build.count_tables(w.messages(AIRPORTS_TOPIC), w.repeated_airports())


# --- messages ---------------------------------------------------------------


@query
def json_split(w: Workspace) -> DataFrame:
    records = decode.split_records(w.messages(FLIGHTS_TOPIC))
    return decode.extract_paths(
        records.withColumn("page_key", F.col("key").cast("string")),
        {"flight_iata": "$.flight.iata", "status": "$.flight_status"},
        "page_key",
    )


def _event_records(w: Workspace) -> DataFrame:
    return w.given("events").select("event_id", F.col("props").alias("record"))


@query
def json_path_extract(w: Workspace) -> DataFrame:
    return decode.extract_paths(_event_records(w), {"k": "$.k"}, "event_id")


@query
def variant_split(w: Workspace) -> DataFrame:
    """The split without a declared shape."""
    records = decode.split_variants(w.messages(FLIGHTS_TOPIC)).withColumn("page_key", F.col("key").cast("string"))
    return decode.extract_variants(records, {"flight_iata": "$.flight.iata", "status": "$.flight_status"}, "page_key")


@query
def variant_paths(w: Workspace) -> DataFrame:
    """A field as text and as a number, and one that is not there."""
    paths = {"k": "$.k", "number": "$.k: bigint", "missing": "$.no.such[0]"}
    return decode.extract_variants(decode.variant_records(_event_records(w)), paths, "event_id")


@query
def variant_shapes(w: Workspace) -> DataFrame:
    """Records of unknown shape, and words among them, by what they look like."""
    words = w.given("events").select("event_id", F.col("event_type").alias("record"))
    records = decode.variant_records(_event_records(w).unionByName(words))
    shapes = decode.variant_shapes(records)
    return shapes.groupBy(F.col("shape").isNotNull().alias("is_json")).agg(F.sum("n").alias("n"))


@query
def json_normalize(w: Workspace) -> DataFrame:
    records = decode.split_records(w.messages(FLIGHTS_TOPIC))
    paths = {
        "flight": "$.flight.iata",
        "icao": "$.departure.icao",
        "name": "$.departure.airport",
        "gate": "$.departure.gate",
    }
    return decode.normalize_records(records, paths)


@query
def json_rewrite(w: Workspace) -> DataFrame:
    return decode.rewrite_records(_event_records(w), "k int", "event_id")


@query
def enriched_airports(w: Workspace) -> DataFrame:
    """The light filter and enrichment, with the constants and typed NULLs of the table."""
    kept = flatten.clean_and_enrich(w.table("airports"))
    return kept.select(
        "_id", "icao_code", "geoid_height", "hae", "created_by", "updated_by", "v_version",
        F.col("magnetic_declination").cast("double").alias("magnetic_declination"),
        F.size(F.coalesce("traffic_type", F.array().cast("array<int>"))).alias("n_traffic_types"),
    )


@query
def airports_reference_box(w: Workspace) -> DataFrame:
    """The box of the reference's example, not widened."""
    return ap.airports_in_box(w.table("airports"))


@query
def display_names(w: Workspace) -> DataFrame:
    return fl.with_display_names(fl.departures_per_day(w.table("flights")), fl.DAILY_FLIGHTS_LABELS)


@query
def percentage_bands(w: Workspace) -> DataFrame:
    """Daily delays coloured by where they lie between the least and the greatest."""
    return fl.delay_percentage_bands(w.table("flights"))


@query
def publish_records(w: Workspace) -> DataFrame:
    path = fresh_dir(w.spark, "published")
    flights = w.table("flights")
    FileTopicSink(path).publish(to_records(flights, F.col("flight_iata")))
    published = w.spark.read.schema("key binary, value binary").parquet(path)
    return decode.open_document(published, schemas.FLIGHTS_TABLE).drop("raw_json")


def _page_sizes(records: DataFrame) -> DataFrame:
    return decode.parse_flight_pages(records).select(
        F.col("key").cast("string").alias("key"),
        "partition",
        "offset",
        array_size("flights").cast("bigint").alias("n_flights"),
    )


@query
def topic_peek(w: Workspace) -> DataFrame:
    return _page_sizes(peek(w.messages(FLIGHTS_TOPIC), 5))


@query
def replay_from_offset(w: Workspace) -> DataFrame:
    return _page_sizes(w.topic(FLIGHTS_TOPIC).read(w.spark, {0: 20, 1: 40}))


@query
def ingest_audit(w: Workspace) -> DataFrame:
    flights = audit(FLIGHT_JOB, FLIGHT_JOB.parse(w.messages(FLIGHTS_TOPIC)))
    airports = audit(AIRPORT_JOB, AIRPORT_JOB.parse(w.messages(AIRPORTS_TOPIC)))
    columns = ("topic", "partition", "first_offset", "last_offset", "messages")
    return flights.select(*columns, F.col("flights").alias("records"), "rejects").unionByName(
        airports.select(*columns, F.col("documents").alias("records"), "rejects")
    )


@query
def quarantine(w: Workspace) -> DataFrame:
    """What an airport job sets aside from its own topic and a topic of stray messages."""
    return decode.airport_rejects(w.messages(AIRPORTS_TOPIC).unionByName(w.messages(STRAY_TOPIC)))


@query
def reject_reasons(w: Workspace) -> DataFrame:
    """What a flight job sets aside, for each reason that there is, and what it keeps of the same messages."""
    return decode.flight_rejects(generated.broken_pages(w.spark, w.sf_dir))


@query
def kept_of_broken_pages(w: Workspace) -> DataFrame:
    return flatten.flights_from_messages(generated.broken_pages(w.spark, w.sf_dir)).select("flight_iata", "flight_status")


@query
def landed_pages(w: Workspace) -> DataFrame:
    """Pages landed as files, taken in by a stream: their positions have no gaps, and no flight is lost."""
    return decode.parse_flight_pages(w.landed().read(w.spark)).groupBy("topic", "partition").agg(
        F.count("*").alias("pages"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"),
        F.count_distinct("offset").alias("offsets"), F.sum(array_size("flights").cast("bigint")).alias("flights"),
    )


# --- flight panels ----------------------------------------------------------


def _flight_panel(name: str, panel: Callable[[DataFrame], DataFrame]) -> None:
    def run(w: Workspace) -> DataFrame:
        return panel(w.table("flights"))

    run.__name__ = name
    query(run)


_flight_panel("departures_per_day", fl.departures_per_day)
_flight_panel("avg_departure_delay", fl.avg_departure_delay)
_flight_panel("avg_arrival_delay", fl.avg_arrival_delay)
_flight_panel("literal_relation", fl.arrival_delay_against_literal)
_flight_panel("top_destinations", fl.top_destinations)
_flight_panel("flights_by_airline", fl.flights_by_airline)
_flight_panel("flights_by_status", fl.flights_by_status)
_flight_panel("status_airline_stats", fl.status_airline_stats)
_flight_panel("latest_flights", fl.latest_flights)
_flight_panel("flights_codeshare", fl.codeshare_delays)
_flight_panel("latest_day_kpi", fl.latest_day_kpi)
_flight_panel("delay_bands", fl.delay_bands)
_flight_panel("delay_alerts", fl.delay_alerts)


@query
def distinct_destinations(w: Workspace) -> DataFrame:
    return fl.distinct_values(w.table("flights"), "arrival_airport")


@query
def distinct_airlines(w: Workspace) -> DataFrame:
    return fl.distinct_values(w.table("flights"), "airline_name")


@query
def airline_share(w: Workspace) -> DataFrame:
    return fl.share_by(w.table("flights"), "airline_name")


@query
def status_share(w: Workspace) -> DataFrame:
    return fl.share_by(w.table("flights"), "flight_status")


@query
def filter_multi_select(w: Workspace) -> DataFrame:
    return fl.selected_flights(w.table("flights"), ["1-URGENT", "5-LOW"])


@query
def filter_all_selected(w: Workspace) -> DataFrame:
    return fl.selected_flights(w.table("flights"), ["$__all"], ["Airport 3", "Airport 7"])


@query
def filter_time_range(w: Workspace) -> DataFrame:
    low, high = (F.lit(t).cast("timestamp") for t in ("1998-01-01", "1998-02-01"))
    flights = fl.in_time_range(w.flights_by_month(), "departure_scheduled", low, high)
    return flights.select("flight_iata", "departure_scheduled")


# --- airport panels ---------------------------------------------------------


@query
def airports_clean(w: Workspace) -> DataFrame:
    return ap.airports_clean(w.table("airports"))


@query
def airports_bbox(w: Workspace) -> DataFrame:
    return ap.airports_in_box(w.table("airports"), longitudes=(-5.0, 180.0))


@query
def positions_bbox(w: Workspace) -> DataFrame:
    return ap.positions_in_box(w.positions(), longitudes=(-5.0, 180.0))


@query
def positions_over_date_line(w: Workspace) -> DataFrame:
    """A box whose western edge lies east of its eastern one."""
    return ap.positions_in_box(w.positions(), (-60.0, 60.0), (100.0, -20.0))


@query
def airport_geo_points(w: Workspace) -> DataFrame:
    return ap.airport_geo_points(w.table("airports"))


@query
def airports_by_country(w: Workspace) -> DataFrame:
    return ap.airports_by_country(w.table("airports"))


@query
def total_value(w: Workspace) -> DataFrame:
    return _doubles(ap.total_value(w.table("frequencies")), "total_value")


@query
def value_by_airport(w: Workspace) -> DataFrame:
    return _doubles(ap.value_by_airport(w.table("frequencies")), "total_value")


@query
def long_amounts(w: Workspace) -> DataFrame:
    """Exact totals of amounts with 20 to 30 digits, some of them negative."""
    amount = F.concat(
        F.when(F.col("l_linenumber") % 3 == 0, "-").otherwise(""), F.col("l_orderkey"), F.lit("0" * 17), F.lit("."),
        F.lpad(F.col("l_partkey").cast("string"), 12, "0"),
    )
    lines = w.given("lineitem").select("l_returnflag", amount.alias("amount"))
    return sum_numeric(lines, "amount", ["l_returnflag"], "total")


@query
def uncastable_values(w: Workspace) -> DataFrame:
    """Frequency texts that are present but no number: none of the values, all of the names."""
    return ap.uncastable(w.table("frequencies"), "value", "name")


def _priced(w: Workspace) -> tuple[DataFrame, DataFrame]:
    return w.table("frequencies"), w.table("airports")


@query
def value_by_country(w: Workspace) -> DataFrame:
    return _doubles(ap.value_by_country(*_priced(w)), "total_value_country")


@query
def top_countries(w: Workspace) -> DataFrame:
    return _doubles(ap.top_countries(*_priced(w)), "total_value_country")


@query
def top_airports(w: Workspace) -> DataFrame:
    return _doubles(ap.top_airports(*_priced(w)), "total_value")


@query
def ranked_airports(w: Workspace) -> DataFrame:
    return _doubles(ap.ranked_airports(*_priced(w)), "total_value")


@query
def airport_heatmap(w: Workspace) -> DataFrame:
    return ap.airport_heatmap(*_priced(w))


@query
def distinct_airport_ids(w: Workspace) -> DataFrame:
    return ap.distinct_airport_ids(w.table("airports"))


@query
def airport_names(w: Workspace) -> DataFrame:
    return ap.airport_names(w.table("airports"))


@query
def data_freshness(w: Workspace) -> DataFrame:
    return ap.data_freshness(w.messages(AIRPORTS_TOPIC), "timestamp")


@query
def freshness_by_airport(w: Workspace) -> DataFrame:
    documents = flatten.documents(w.messages(AIRPORTS_TOPIC), ["_id"])
    return ap.freshness_by(documents.withColumnRenamed("_id", "airport_id"), "airport_id", "timestamp")


# --- streams ----------------------------------------------------------------


@query
def stream_flights_ingest(w: Workspace) -> DataFrame:
    sink = w.ingested(FLIGHTS_TOPIC)
    rows = sink.read(w.spark, "flights", schemas.ddl_row(schemas.FLIGHTS_TABLE))
    return rows.drop("job", "batch_id", "flight_month", "raw_json")


def _streamed_flights(w: Workspace) -> DataFrame:
    return w.ingested(FLIGHTS_TOPIC).read(w.spark, "flights", schemas.ddl_row(schemas.FLIGHTS_TABLE))


@query
def stream_top_destinations(w: Workspace) -> DataFrame:
    return fl.top_destinations(_streamed_flights(w))


@query
def stream_time_range(w: Workspace) -> DataFrame:
    low, high = (F.lit(t).cast("timestamp") for t in ("1998-01-01", "1998-02-01"))
    flights = fl.in_time_range(_streamed_flights(w), "departure_scheduled", low, high)
    return flights.select("flight_iata", "departure_scheduled")


@query
def stream_airports_ingest(w: Workspace) -> DataFrame:
    tables = ingested_airports(w.spark, w.ingested(AIRPORTS_TOPIC))
    return flatten.with_position(tables["airports"]).select(*FLAT_AIRPORT)


@query
def stream_frequencies_ingest(w: Workspace) -> DataFrame:
    return _frequency_rows(ingested_airports(w.spark, w.ingested(AIRPORTS_TOPIC))["frequencies"])


@query
def stream_runways_ingest(w: Workspace) -> DataFrame:
    return _runway_rows(ingested_airports(w.spark, w.ingested(AIRPORTS_TOPIC))["runways"])


@query
def stream_ingest_audit(w: Workspace) -> DataFrame:
    """Totals of the audit rows the airports job wrote, over all of its batches."""
    entries = w.ingested(AIRPORTS_TOPIC).audit(w.spark, AIRPORT_JOB.audit_ddl()).where(F.col("topic") == AIRPORTS_TOPIC)
    counted = ("messages", *AIRPORT_JOB.counts(), *AIRPORT_JOB.distinct())
    return entries.groupBy("topic", "partition").agg(
        *[F.sum(c).alias(c) for c in counted if c != "documents"]
    )


@query
def stream_table_counts(w: Workspace) -> DataFrame:
    """Rows of each table after both jobs, which share one sink."""
    w.ingested(AIRPORTS_TOPIC)
    sink = w.ingested(FLIGHTS_TOPIC)
    counts = None
    for name, fields in TABLES.items():
        rows = sink.read(w.spark, name, schemas.ddl_row(dict(list(fields.items())[:1])))
        count = rows.agg(F.lit(name).alias("table_name"), F.count("*").alias("n"))
        counts = count if counts is None else counts.unionByName(count)
    return counts


@query
def stream_rejects(w: Workspace) -> DataFrame:
    """The rejects table of an airports job that was given a topic of stray messages."""
    sink = w.ingested(STRAY_TOPIC)
    return sink.read(w.spark, REJECTS, schemas.ddl_row(REJECTS_TABLE)).drop("job", "batch_id")


@query
def stream_airport_freshness(w: Workspace) -> DataFrame:
    """When the newest message about each airport was sent."""
    ddl = schemas.ddl_row({"airport_id": "string"} | MESSAGE_POSITION)
    documents = w.ingested(AIRPORTS_TOPIC).read(w.spark, DOCUMENTS, ddl)
    return ap.freshness_by(documents, "airport_id", "timestamp")


# --- tables and panels kept up to date --------------------------------------


@query
def compacted_flights(w: Workspace) -> DataFrame:
    """Flights of many batches, read by a manifest of compacted files."""
    sink = w.compacted_flights()
    return sink.read(w.spark, "flights", schemas.ddl_row(schemas.FLIGHTS_TABLE)).drop("job", "batch_id", "flight_month", "raw_json")


@query
def compacted_versions(w: Workspace) -> DataFrame:
    """Flights per status in the batches as they were written, and in version 1."""
    ddl, sink = schemas.ddl_row({"flight_status": "string"}), w.compacted_flights()
    before = ParquetSink(sink.root).read(w.spark, "flights", ddl).withColumn("version", F.lit("batches"))
    after = sink.read_version(w.spark, "flights", ddl, 1).withColumn("version", F.lit("version 1"))
    return before.unionByName(after).groupBy("version", "flight_status").agg(F.count("*").alias("n_flights"))


@query
def stream_current_airports(w: Workspace) -> DataFrame:
    """All rows that the current-airports job has appended: one for each airport, for all re-sends."""
    return w.current().read(w.spark, "airports", schemas.ddl_row(schemas.AIRPORTS_TABLE)).select("_id", "name")


def _live_panel(name: str, table: str, panel: Callable[[DataFrame], DataFrame]) -> None:
    def run(w: Workspace) -> DataFrame:
        return panel(live.merged(w.spark, w.panels(), table))

    run.__name__ = name
    query(run)


_live_panel("live_departures_per_day", live.DAY_SUMS, live.departures_per_day)
_live_panel("live_avg_departure_delay", live.DAY_SUMS, live.avg_departure_delay)
_live_panel("live_flights_by_status", live.DAY_SUMS, live.flights_by_status)


@query
def live_status_stats(w: Workspace) -> DataFrame:
    """Airlines by sketches, and whether the estimate of flight numbers is within 4 standard errors."""
    stats = live.status_stats(live.merged(w.spark, w.panels(), live.STATUS_SKETCHES))
    error = F.abs(F.col("n_flight_numbers") / F.col("n_flights") - 1)  # numbers are distinct
    return stats.select("flight_status", "n_flights", "n_airlines", (error < 4 * 0.0082).alias("close"))


@query
def stream_lag(w: Workspace) -> DataFrame:
    """Messages that the airport job has not read: before its first batch, and when it has caught up."""
    records = w.topic(AIRPORTS_TOPIC).read(w.spark)
    audit = w.ingested(AIRPORTS_TOPIC).audit(w.spark, AIRPORT_JOB.audit_ddl()).where(F.col("topic") == AIRPORTS_TOPIC)
    before = unread(records, audit.limit(0)).withColumn("moment", F.lit("before"))
    return before.unionByName(unread(records, audit).withColumn("moment", F.lit("after")))


@query
def republished_topic(w: Workspace) -> DataFrame:
    """Airport names published twice as a topic, and replayed from an offset of its second partition."""
    path = fresh_dir(w.spark, "republished")
    sink = FileTopicSink(path)
    names = to_records(w.table("airports").select("_id", "name"), F.col("_id"))
    for _ in range(2):
        sink.append(names, "names", f"{path}-stage")
    replayed = FileTopic(path).read(w.spark, {1: 1})
    return replayed.groupBy("topic", "partition").agg(
        F.count("*").alias("messages"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"),
        F.count_distinct("offset").alias("offsets"), F.count_distinct("key").alias("airports"),
    )
