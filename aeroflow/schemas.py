"""Shapes of the incoming JSON documents and of the tables made from them.

Types are Spark DDL text, which ``from_json`` takes as it is. A parser can be
given a subset of the fields, so that a query that needs two of them does not
convert the rest of each document.
"""

from __future__ import annotations

from collections.abc import Iterable

# --- fixed values: field names and types of the two document kinds ----------

FREQUENCY_FIELDS = {
    "_id": "string",
    "name": "string",
    "value": "string",
    "unit": "int",
    "type": "int",
    "primary": "boolean",
    "publicUse": "boolean",
}

RUNWAY_FIELDS = {
    "_id": "string",
    "designator": "string",
    "pilotCtrlLighting": "boolean",
    "takeOffOnly": "boolean",
    "landingOnly": "boolean",
    "surface": "struct<composition:array<int>,mainComposite:int,condition:int>",
    "dimension": "struct<length:struct<value:double>,width:struct<value:double>>",
}

DEPARTURE_FIELDS = (
    "airport", "timezone", "iata", "icao", "terminal", "gate", "delay",
    "scheduled", "estimated", "actual", "estimated_runway", "actual_runway",
)
ARRIVAL_FIELDS = (
    "airport", "timezone", "iata", "icao", "terminal", "gate", "baggage",
    "scheduled", "delay", "estimated", "actual", "estimated_runway", "actual_runway",
)
AIRLINE_FIELDS = ("name", "iata", "icao")
FLIGHT_NUMBER_FIELDS = ("number", "iata", "icao")
CODESHARE_FIELDS = (
    "airline_name", "airline_iata", "airline_icao",
    "flight_number", "flight_iata", "flight_icao",
)

# Everything else in a departure or arrival is text on the wire.
STOP_INT_FIELDS = frozenset({"delay"})
STOP_TIME_FIELDS = frozenset(
    {"scheduled", "estimated", "actual", "estimated_runway", "actual_runway"}
)



def ddl_struct(fields: dict[str, str]) -> str:
    return "struct<" + ",".join(f"`{n}`:{t}" for n, t in fields.items()) + ">"


def ddl_row(fields: dict[str, str]) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in fields.items())


def _texts(names: Iterable[str]) -> dict[str, str]:
    return {n: "string" for n in names}


def _stop(names: Iterable[str]) -> dict[str, str]:
    return {n: "int" if n in STOP_INT_FIELDS else "string" for n in names}


AIRPORT_DOC = {
    "_id": "string",
    "name": "string",
    "icaoCode": "string",
    "iataCode": "string",
    "type": "int",
    "country": "string",
    "geometry": "struct<type:string,coordinates:array<double>>",
    "elevation": "struct<value:double,unit:int,referenceDatum:int>",
    "ppr": "boolean",
    "private": "boolean",
    "skydiveActivity": "boolean",
    "winchOnly": "boolean",
    "frequencies": f"array<{ddl_struct(FREQUENCY_FIELDS)}>",
    "runways": f"array<{ddl_struct(RUNWAY_FIELDS)}>",
}

# `aircraft` and `live` are text: from_json then keeps the raw JSON subtree.
FLIGHT_DOC = {
    "flight_date": "string",
    "flight_status": "string",
    "departure": ddl_struct(_stop(DEPARTURE_FIELDS)),
    "arrival": ddl_struct(_stop(ARRIVAL_FIELDS)),
    "airline": ddl_struct(_texts(AIRLINE_FIELDS)),
    "flight": ddl_struct(
        _texts(FLIGHT_NUMBER_FIELDS) | {"codeshared": ddl_struct(_texts(CODESHARE_FIELDS))}
    ),
    "aircraft": "string",
    "live": "string",
}


def flight_message(flight: dict[str, str]) -> dict[str, str]:
    """A page of flights, or one flight without the page around it."""
    return {"data": f"array<{ddl_struct(flight)}>"} | flight


FLIGHT_MESSAGE_DOC = flight_message(FLIGHT_DOC)

# One record of a topic, as the Kafka source delivers it.
MESSAGE_FIELDS = {
    "key": "binary",
    "value": "binary",
    "topic": "string",
    "partition": "int",
    "offset": "bigint",
    "timestamp": "timestamp",
}

# Where a row came from, kept next to decoded documents.
SOURCE_COLUMNS = ("topic", "partition", "offset", "timestamp")

FLIGHTS_TABLE = (
    {"flight_date": "date", "flight_status": "string"}
    | {
        f"{side}_{n}": "int" if n in STOP_INT_FIELDS
        else "timestamp" if n in STOP_TIME_FIELDS else "string"
        for side, names in (("departure", DEPARTURE_FIELDS), ("arrival", ARRIVAL_FIELDS))
        for n in names
    }
    | {f"airline_{n}": "string" for n in AIRLINE_FIELDS}
    | {f"flight_{n}": "string" for n in FLIGHT_NUMBER_FIELDS}
    | {f"codeshared_{n}": "string" for n in CODESHARE_FIELDS}
    | {"raw_json": "string"}
)

# Columns that no message fills. A bare `decimal` is (10,0) in Spark and would round 118.700
# to 119. Amounts stay text, and `operators.numeric` sums them whatever their length.
NUMERIC = "decimal(28,8)"

AIRPORTS_TABLE = {
    "_id": "string",
    "name": "string",
    "iata_code": "string",
    "icao_code": "string",
    "type": "int",
    "traffic_type": "array<int>",
    "magnetic_declination": NUMERIC,
    "country": "string",
    "geometry": "string",
    "elevation_value": "double",
    "elevation_unit": "int",
    "elevation_reference_datum": "int",
    "ppr": "boolean",
    "private": "boolean",
    "skydive_activity": "boolean",
    "winch_only": "boolean",
    "geoid_height": "int",
    "hae": "int",
    "created_at": "timestamp",
    "updated_at": "timestamp",
    "created_by": "string",
    "updated_by": "string",
    "v_version": "int",
}

FREQUENCIES_TABLE = {
    "_id": "string",
    "airport_id": "string",
    "value": "string",
    "unit": "int",
    "type": "int",
    "name": "string",
    "primary_freq": "boolean",
    "public_use": "boolean",
}

RUNWAYS_TABLE = {
    "_id": "string",
    "airport_id": "string",
    "designator": "string",
    "true_heading": NUMERIC,
    "aligned_true_north": "boolean",
    "operations": "int",
    "main_runway": "boolean",
    "turn_direction": "int",
    "take_off_only": "boolean",
    "landing_only": "boolean",
    "pilot_ctrl_lighting": "boolean",
    "visual_approach_aids": "array<int>",
    "surface": "string",
    "dimension": "string",
    "declared_distance": "string",
}

# --- end of fixed values ----------------------------------------------------
