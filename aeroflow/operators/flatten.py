"""Documents to flat tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroflow import schemas
from aeroflow.functions import as_time, json_number, typed_null
from aeroflow.operators.decode import (
    parse_airports,
    parse_flight_pages,
    split_flights,
    with_id,
)
from aeroflow.operators.dedup import current_documents

WRITER = "spark"
LATITUDE = "$.coordinates[1]"
LONGITUDE = "$.coordinates[0]"
AIRPORT_ROW_FIELDS = [n for n in schemas.AIRPORT_DOC if n not in ("frequencies", "runways")]


def flatten_flights(flights: DataFrame, *keep: str) -> DataFrame:
    """The 40 columns of the flights table from the struct column ``f``."""
    return flights.select(
        *keep,
        F.col("f.flight_date").try_cast("date").alias("flight_date"),
        "f.flight_status",
        *_stop("departure", schemas.DEPARTURE_FIELDS),
        *_stop("arrival", schemas.ARRIVAL_FIELDS),
        *_prefixed("f.airline", "airline", schemas.AIRLINE_FIELDS),
        *_prefixed("f.flight", "flight", schemas.FLIGHT_NUMBER_FIELDS),
        *_prefixed("f.flight.codeshared", "codeshared", schemas.CODESHARE_FIELDS),
        F.to_json("f").alias("raw_json"),
    )


def _stop(side: str, names: tuple[str, ...]) -> list[Column]:
    columns = []
    for name in names:
        column = F.col(f"f.{side}.{name}")
        if name in schemas.STOP_TIME_FIELDS:
            column = as_time(column)
        columns.append(column.alias(f"{side}_{name}"))
    return columns


def _prefixed(path: str, prefix: str, names: tuple[str, ...]) -> list[Column]:
    return [F.col(f"{path}.{name}").alias(f"{prefix}_{name}") for name in names]


def flights_from_messages(messages: DataFrame) -> DataFrame:
    return flatten_flights(split_flights(parse_flight_pages(messages)))


def flatten_airports(parsed: DataFrame, *keep: str) -> DataFrame:
    """The 23 columns of the airports table, one row per document."""
    values = {
        "iata_code": F.col("iataCode"),
        "icao_code": F.col("icaoCode"),
        "geometry": F.to_json("geometry"),
        "elevation_value": F.col("elevation.value"),
        "elevation_unit": F.col("elevation.unit"),
        "elevation_reference_datum": F.col("elevation.referenceDatum"),
        "skydive_activity": F.col("skydiveActivity"),
        "winch_only": F.col("winchOnly"),
        "geoid_height": F.lit(0),
        "hae": F.lit(0),
        **audit_columns(),
    }
    return parsed.select(*keep, *_table_columns(schemas.AIRPORTS_TABLE, values, parsed.columns))


def audit_columns(writer: str = WRITER) -> dict[str, Column]:
    """Who wrote a row and when; the time is one instant per query or batch."""
    now = F.current_timestamp()
    return {
        "created_at": now,
        "updated_at": now,
        "created_by": F.lit(writer),
        "updated_by": F.lit(writer),
        "v_version": F.lit(1),
    }


def clean_and_enrich(rows: DataFrame, required: str = "icao_code") -> DataFrame:
    """The light filter before publishing: rows with the key, plus audit columns."""
    return rows.where(F.col(required).isNotNull()).withColumns(audit_columns())


def _table_columns(
    table: dict[str, str], values: dict[str, Column], same_name: list[str]
) -> list[Column]:
    """Table columns in order: a given value, else the document field of that
    name, else a typed NULL that a later writer may fill."""
    columns = []
    for name, ddl_type in table.items():
        if name in values:
            column = values[name]
        elif name in same_name:
            column = F.col(name)
        else:
            column = typed_null(ddl_type)
        columns.append(column.alias(name))
    return columns


def with_position(airports: DataFrame) -> DataFrame:
    """Adds latitude and longitude to airports rows, read from the GeoJSON point."""
    geometry = F.col("geometry")
    return airports.withColumns(
        {"latitude": json_number(geometry, LATITUDE), "longitude": json_number(geometry, LONGITUDE)}
    )


def explode_frequencies(parsed: DataFrame, *keep: str) -> DataFrame:
    """One row per frequency; documents with none give no row."""
    children = parsed.select(
        *keep, F.col("_id").alias("airport_id"), F.inline("frequencies")
    )
    values = {"primary_freq": F.col("primary"), "public_use": F.col("publicUse")}
    return children.select(
        *keep, *_table_columns(schemas.FREQUENCIES_TABLE, values, children.columns)
    )


def explode_runways(parsed: DataFrame, *keep: str) -> DataFrame:
    """One row per runway; documents with none give no row."""
    children = parsed.select(*keep, F.col("_id").alias("airport_id"), F.inline("runways"))
    values = {
        "aligned_true_north": F.lit(False),
        "main_runway": F.lit(False),
        "take_off_only": F.col("takeOffOnly"),
        "landing_only": F.col("landingOnly"),
        "pilot_ctrl_lighting": F.col("pilotCtrlLighting"),
        "surface": F.to_json("surface"),
        "dimension": F.to_json(
            F.struct(
                F.col("dimension.length.value").alias("length"),
                F.col("dimension.width.value").alias("width"),
            )
        ),
    }
    return children.select(
        *keep, *_table_columns(schemas.RUNWAYS_TABLE, values, children.columns)
    )


def documents(
    messages: DataFrame, fields: list[str], repeated: DataFrame | None = None
) -> DataFrame:
    """Airport documents, narrowed to some fields, without replaced ones if ``repeated`` is given."""
    parsed = with_id(parse_airports(messages, fields))
    return parsed if repeated is None else current_documents(parsed, repeated)


def frequencies_from_messages(messages: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    return explode_frequencies(documents(messages, ["_id", "frequencies"], repeated))


def runways_from_messages(messages: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    return explode_runways(documents(messages, ["_id", "runways"], repeated))
