"""Stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroflow import schemas
from aeroflow.operators.flatten import with_position

TABLES = {
    "airports": schemas.AIRPORTS_TABLE,
    "frequencies": schemas.FREQUENCIES_TABLE,
    "runways": schemas.RUNWAYS_TABLE,
    "flights": schemas.FLIGHTS_TABLE,
}

# Names the stored tables have in SQL text.
VIEW_NAMES = {
    "airports": "airportsInt",
    "frequencies": "frequencies",
    "runways": "runways",
    "flights": "flights",
}

# Folder column of the flights table; not one of its 40 columns.
FLIGHT_MONTH = "flight_month"
MONTH_FORMAT = "yyyy-MM"


def flight_month() -> Column:
    """The month of the scheduled departure, on which time ranges filter; the flight's date
    stands in where there is none."""
    day = F.coalesce(F.to_date("departure_scheduled"), F.col("flight_date"))
    return F.date_format(day, MONTH_FORMAT)


def read_table(spark: SparkSession, root: str, name: str, with_folder: bool = False) -> DataFrame:
    """A stored table with its declared columns; the schema is never inferred.

    ``with_folder`` adds the folder column, by which a time range leaves folders out.
    """
    fields = TABLES[name]
    folders = {FLIGHT_MONTH: "string"} if name == "flights" else {}
    rows = spark.read.schema(schemas.ddl_row(fields | folders)).parquet(f"{root}/{name}")
    return rows.select(*fields, *(folders if with_folder else ()))


def register_views(spark: SparkSession, root: str) -> None:
    """Makes the stored tables available to SQL text under their usual names.

    Airports also get their position, and flights the short names ``status``
    and ``airline``, since ad-hoc SQL uses those.
    """
    tables = {name: read_table(spark, root, name) for name in TABLES}
    tables["airports"] = with_position(tables["airports"])
    tables["flights"] = tables["flights"].withColumns(
        {"status": F.col("flight_status"), "airline": F.col("airline_name")}
    )
    for name, view in VIEW_NAMES.items():
        tables[name].createOrReplaceTempView(view)
