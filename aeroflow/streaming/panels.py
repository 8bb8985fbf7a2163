"""Panels that stay current: partial sums and sketches per batch, merged when they are read.

A batch of flights gives a few rows of sums for each airport, day and status it has flights of, and a
sketch for each status. Sums of sums are those of all flights, in any order and however late a flight
comes; unions of sketches estimate all flights, within the error of one sketch. A replayed batch replaces its own rows. Compaction merges the
rows of many batches into one for each key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroflow import schemas
from aeroflow.operators import decode
from aeroflow.plans.flights import HOME
from aeroflow.sinks.compaction import CompactingSink
from aeroflow.streaming.ingest import REJECTS, REJECTS_TABLE, Job, _total_size, _with_sizes

DAY_SUMS, STATUS_SKETCHES = "day_sums", "status_sketches"
DAY_KEYS = {"departure_iata": "string", "flight_date": "date", "flight_status": "string"}
DAY_FIELDS = DAY_KEYS | {"n_flights": "bigint", "n_delays": "bigint", "sum_delay": "bigint"}
STATUS_FIELDS = {"flight_status": "string", "n_flights": "bigint", "airlines": "binary", "flight_numbers": "binary"}

# What the panels need of a flight; the rest of a page is not parsed.
PANEL_DOC = {
    "flight_date": "string",
    "flight_status": "string",
    "departure": "struct<iata: string, delay: int>",
    "airline": "struct<name: string>",
    "flight": "struct<iata: string>",
}

# 2^14 registers: a count of distinct values has a standard error of 1.04 / 2^7, that is 0.8 %.
SKETCH_BITS = 14


def day_sums(flights: DataFrame) -> DataFrame:
    """Sums over flights ``f``, as ``decode.split_flights`` gives them."""
    keys = flights.select(
        F.col("f.departure.iata").alias("departure_iata"),
        F.col("f.flight_date").try_cast("date").alias("flight_date"),
        F.col("f.flight_status").alias("flight_status"),
        F.col("f.departure.delay").cast("bigint").alias("delay"),
    )
    return keys.groupBy(*DAY_KEYS).agg(
        F.count("*").alias("n_flights"), F.count("delay").alias("n_delays"), F.sum("delay").alias("sum_delay")
    )


def merge_day_sums(rows: DataFrame) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in DAY_FIELDS if c not in DAY_KEYS]
    return rows.groupBy(*DAY_KEYS).agg(*sums)


def status_sketches(flights: DataFrame) -> DataFrame:
    """Sketches of the airlines and flight numbers of each status."""
    return flights.groupBy(F.col("f.flight_status").alias("flight_status")).agg(
        F.count("*").alias("n_flights"),
        F.hll_sketch_agg("f.airline.name", SKETCH_BITS).alias("airlines"),
        F.hll_sketch_agg("f.flight.iata", SKETCH_BITS).alias("flight_numbers"),
    )


def merge_status_sketches(rows: DataFrame) -> DataFrame:
    return rows.groupBy("flight_status").agg(
        F.sum("n_flights").alias("n_flights"),
        *[F.hll_union_agg(c).alias(c) for c in ("airlines", "flight_numbers")],
    )


MERGES = {DAY_SUMS: (DAY_FIELDS, merge_day_sums), STATUS_SKETCHES: (STATUS_FIELDS, merge_status_sketches)}


def _tables(pages: DataFrame) -> dict[str, DataFrame]:
    flights = decode.split_flights(pages)
    return {DAY_SUMS: day_sums(flights), STATUS_SKETCHES: status_sketches(flights)}


def _no_rejects(parsed: DataFrame) -> DataFrame:
    """The flight job sets messages aside; this one only counts flights."""
    return parsed.sparkSession.createDataFrame([], schemas.ddl_row(REJECTS_TABLE))


PANEL_JOB = Job(
    "panels",
    lambda records: _with_sizes(decode.parse_flight_pages(records, PANEL_DOC), "flights"),
    lambda: {"flights": _total_size("flights"), REJECTS: F.count(F.lit(None))},
    dict,
    _tables,
    _no_rejects,
)


def compact_panels(spark: SparkSession, sink: CompactingSink) -> None:
    """One row for each key, however many batches there have been; run it from time to time."""
    for table, (fields, merge) in MERGES.items():
        sink.compact(spark, table, schemas.ddl_row(fields), merge)


def merged(spark: SparkSession, sink: CompactingSink, table: str) -> DataFrame:
    """A panel table over all committed batches, compacted or not."""
    fields, merge = MERGES[table]
    return merge(sink.read(spark, table, schemas.ddl_row(fields)))


def departures_per_day(sums: DataFrame, airport: str = HOME) -> DataFrame:
    days = sums.where(F.col("departure_iata") == airport).groupBy("flight_date")
    return days.agg(F.sum("n_flights").alias("n_flights")).orderBy(F.asc_nulls_last("flight_date"))


def avg_departure_delay(sums: DataFrame, airport: str = HOME) -> DataFrame:
    """Mean delay of each day that has a delay."""
    days = sums.where((F.col("departure_iata") == airport) & (F.col("n_delays") > 0)).groupBy("flight_date")
    mean = (F.sum("sum_delay") / F.sum("n_delays")).alias("avg_delay")
    return days.agg(mean).orderBy(F.asc_nulls_last("flight_date"))


def flights_by_status(sums: DataFrame, airport: str = HOME) -> DataFrame:
    statuses = sums.where(F.col("departure_iata") == airport).groupBy("flight_status")
    return statuses.agg(F.sum("n_flights").alias("n_flights"))


def status_stats(sketches: DataFrame) -> DataFrame:
    """Flights of each status, with estimates of its airlines and flight numbers (``SKETCH_BITS``)."""
    return sketches.select(
        "flight_status",
        "n_flights",
        F.hll_sketch_estimate("airlines").alias("n_airlines"),
        F.hll_sketch_estimate("flight_numbers").alias("n_flight_numbers"),
    )
