"""Builds the stored tables from whole topics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroflow import schemas
from aeroflow.functions import array_size, as_time
from aeroflow.operators import decode, dedup, flatten
from aeroflow.operators.cells import CELL, cell
from aeroflow.sinks.parquet import write_clustered, write_sorted
from aeroflow.sinks.topic import WIDE_ROWS
from aeroflow.sources.tables import FLIGHT_MONTH, flight_month


def build_flights(messages: DataFrame, root: str) -> None:
    """Month folders, sorted by departure airport: a dashboard reads one airport."""
    flights = placed_flights(decode.split_flights(decode.parse_flight_pages(messages)))
    write_clustered(flights, f"{root}/flights", FLIGHT_MONTH, FLIGHT_ORDER, flat_flights)


FLIGHT_ORDER = ["departure_iata", "flight_date"]


def placed_flights(flights: DataFrame) -> DataFrame:
    """Flights ``f`` with their month and what they are sorted by, each still one struct.

    A row of the table is three times as large, as it also holds the flight as text; so flights
    are shuffled and sorted first, and ``flat_flights`` makes the rows when they are written.
    """
    keys = flights.select(
        "f",
        as_time(F.col("f.departure.scheduled")).alias("departure_scheduled"),
        F.col("f.flight_date").try_cast("date").alias("flight_date"),
        F.col("f.departure.iata").alias("departure_iata"),
    )
    return keys.select("f", flight_month().alias(FLIGHT_MONTH), *FLIGHT_ORDER)


def flat_flights(placed: DataFrame) -> DataFrame:
    """The flights table and its month, in the order of the rows given."""
    return flatten.flatten_flights(placed, FLIGHT_MONTH).select(*schemas.FLIGHTS_TABLE, FLIGHT_MONTH)


def staged(documents: DataFrame, path: str) -> DataFrame:
    """Parsed documents, written out and read back.

    Several tables are made of documents that should be parsed, and fetched, once.
    A table rather than a cache: cached blocks hold many whole documents per
    task in memory, are lost with their executor, and are read whole, while each
    output here reads only the columns it needs. The next use overwrites it.
    """
    documents.write.mode("overwrite").options(**WIDE_ROWS).parquet(path)
    return documents.sparkSession.read.schema(documents.schema).parquet(path)


def store_repeats(parsed: DataFrame, path: str) -> DataFrame:
    """Stores which documents were sent more than once, so that their size is known."""
    repeated = dedup.repeated_documents(parsed)
    repeated.write.mode("overwrite").parquet(path)
    return parsed.sparkSession.read.schema(repeated.schema).parquet(path)


def build_airports(messages: DataFrame, root: str, stage: str) -> None:
    """Airports, frequencies and runways from the current documents of a topic.

    Messages are parsed once, into a staged table; each output reads its columns of it, and
    replaced documents are left out by joining these narrow rows.
    """
    parsed = staged(decode.with_id(decode.parse_airports(messages)), f"{stage}/documents")
    repeated = store_repeats(parsed, f"{stage}/repeated")
    position = ["key", *schemas.SOURCE_COLUMNS]
    narrow = {
        name: dedup.current_documents(parsed.select(*position, "_id", name), repeated)
        for name in ("frequencies", "runways")
    }
    rows = parsed.select(*position, *flatten.AIRPORT_ROW_FIELDS)
    for name, table in (
        ("airports", dedup.dedup_batch(flatten.flatten_airports(rows, *schemas.SOURCE_COLUMNS))),
        ("frequencies", flatten.explode_frequencies(narrow["frequencies"])),
        ("runways", flatten.explode_runways(narrow["runways"])),
    ):
        table.write.mode("overwrite").parquet(f"{root}/{name}")


POSITION_COLUMNS = ("_id", "name", "icao_code", "country", "latitude", "longitude")


def store_positions(airports: DataFrame, path: str) -> None:
    """Positions as numbers, in the order of their cells, for queries by a box.

    The id is part of the order, so that a cell with very many rows, or the rows without a
    position, are several tasks' work.
    """
    placed = flatten.with_position(airports).select(*POSITION_COLUMNS)
    write_sorted(placed.withColumn(CELL, cell(F.col("latitude"), F.col("longitude"))), path, CELL, "_id")


def current_fields(messages: DataFrame, *fields: str) -> DataFrame:
    """Some scalar fields of each airport's newest document; only these are parsed and shuffled."""
    parsed = flatten.documents(messages, ["_id", *fields])
    return dedup.dedup_batch(parsed.select(*schemas.SOURCE_COLUMNS, "_id", *fields))


def airports_from_messages(messages: DataFrame) -> DataFrame:
    """One airports row per ``_id``, from its newest message."""
    parsed = flatten.documents(messages, flatten.AIRPORT_ROW_FIELDS)
    return dedup.dedup_batch(flatten.flatten_airports(parsed, *schemas.SOURCE_COLUMNS))


def count_tables(messages: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """Rows each table gets from these messages, in one pass and without exploding."""
    parsed = flatten.documents(messages, ["_id", "frequencies", "runways"], repeated)
    children = {
        name: F.sum(array_size(name)).alias(name)
        for name in ("frequencies", "runways")
    }
    return parsed.agg(F.count_distinct("_id").alias("airports"), *children.values())
