"""Queries over the flights table. The airport and all limits are parameters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroflow.functions import any_selected, band
from aeroflow.operators import panels
from aeroflow.sources.tables import FLIGHT_MONTH, MONTH_FORMAT

HOME = "JFK"

# The literal the arrival-delay panel shows instead of a measurement.
PANEL_DELAY = 22
PANEL_UNIT = "min"

# Fixed value: the time range the dashboards open with.
DASHBOARD_HOURS = 6

# Display names of the panels' columns.
DAILY_FLIGHTS_LABELS = {"flight_date": "time", "n_flights": "Vols au départ de JFK"}
DAILY_DELAY_LABELS = {"flight_date": "time", "avg_delay": "Retard moyen (minutes)"}
DESTINATION_LABELS = {"arrival_airport": "Destination", "n_flights": "Nombre de vols"}
AIRLINE_LABELS = {"airline_name": "Compagnie", "n_flights": "Vols"}
STATUS_LABELS = {"flight_status": "Statut", "n_flights": "Nombre"}
LATEST_FLIGHTS_LABELS = {
    "flight_iata": "Numéro de vol",
    "airline_name": "Compagnie",
    "arrival_airport": "Destination",
    "departure_scheduled": "Heure prévue",
    "departure_actual": "Heure réelle",
    "departure_delay": "Retard (min)",
    "flight_status": "Statut",
}


def departing(flights: DataFrame, airport: str = HOME) -> DataFrame:
    return flights.where(F.col("departure_iata") == airport)


def departures_per_day(flights: DataFrame, airport: str = HOME) -> DataFrame:
    days = departing(flights, airport).groupBy("flight_date")
    return days.agg(F.count("*").alias("n_flights")).orderBy(F.asc_nulls_last("flight_date"))


def daily_departure_delay(flights: DataFrame, airport: str = HOME) -> DataFrame:
    late = departing(flights, airport).where(F.col("departure_delay").isNotNull())
    return late.groupBy("flight_date").agg(F.avg("departure_delay").alias("avg_delay"))


def avg_departure_delay(flights: DataFrame, airport: str = HOME) -> DataFrame:
    return daily_departure_delay(flights, airport).orderBy(F.asc_nulls_last("flight_date"))


def avg_arrival_delay(flights: DataFrame, airport: str = HOME) -> DataFrame:
    return departing(flights, airport).agg(
        F.avg("arrival_delay").alias("delay_minutes"), F.lit(PANEL_UNIT).alias("unit")
    )


def literal_delay(spark: SparkSession) -> DataFrame:
    """The one-row literal relation behind the arrival-delay panel."""
    return spark.range(1).select(
        F.lit(PANEL_DELAY).alias("delay_minutes"), F.lit(PANEL_UNIT).alias("unit")
    )


def arrival_delay_against_literal(flights: DataFrame, airport: str = HOME) -> DataFrame:
    """The measured mean arrival delay beside the literal the panel shows."""
    literal = literal_delay(flights.sparkSession)
    return avg_arrival_delay(flights, airport).select(
        literal.select("delay_minutes").scalar().alias("delay_minutes"),
        "unit",
        F.col("delay_minutes").alias("measured_minutes"),
    )


def count_by(flights: DataFrame, column: str, airport: str = HOME) -> DataFrame:
    return departing(flights, airport).groupBy(column).agg(F.count("*").alias("n_flights"))


def top_destinations(flights: DataFrame, airport: str = HOME, n: int = 5) -> DataFrame:
    return panels.top(count_by(flights, "arrival_airport", airport), "n_flights", "arrival_airport", n)


def flights_by_airline(flights: DataFrame, airport: str = HOME) -> DataFrame:
    counts = count_by(flights, "airline_name", airport)
    return panels.ranked(counts, "n_flights", "airline_name")


def flights_by_status(flights: DataFrame, airport: str = HOME) -> DataFrame:
    return count_by(flights, "flight_status", airport)


def status_airline_stats(flights: DataFrame, *, approximate: bool = False) -> DataFrame:
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return flights.groupBy("flight_status").agg(
        F.count("*").alias("n_flights"), distinct("airline_name").alias("n_airlines")
    )


def latest_flights(flights: DataFrame, airport: str = HOME, n: int = 20) -> DataFrame:
    return (
        departing(flights, airport)
        .select("flight_date", *LATEST_FLIGHTS_LABELS)
        .orderBy(F.desc_nulls_first("departure_scheduled"), "flight_iata")
        .limit(n)
    )


def delay_percentage_bands(flights: DataFrame, airport: str = HOME) -> DataFrame:
    """The same steps, as percentages of the range of the daily means."""
    daily = daily_departure_delay(flights, airport)
    low, high = panels.value_range(daily, "avg_delay")
    colour = band(F.col("avg_delay"), low=low, high=high)
    return daily.select("flight_date", "avg_delay", colour.alias("band"))


def with_display_names(rows: DataFrame, labels: dict[str, str]) -> DataFrame:
    return rows.withColumnsRenamed(labels)


def codeshare_delays(flights: DataFrame) -> DataFrame:
    return flights.groupBy("codeshared_airline_name").agg(
        F.count("*").alias("n"), F.avg("arrival_delay").alias("avg_delay")
    )


def distinct_values(flights: DataFrame, column: str, airport: str = HOME) -> DataFrame:
    """Entries of a dashboard variable."""
    return departing(flights, airport).select(column).distinct()


def latest_day_kpi(flights: DataFrame, airport: str = HOME) -> DataFrame:
    """Departures of the last day, and mean delay of the last day that has one."""
    days = departing(flights, airport).groupBy("flight_date").agg(
        F.count("*").alias("n_flights"), F.avg("departure_delay").alias("avg_delay")
    )
    return panels.last_not_null(days, ["n_flights", "avg_delay"], "flight_date")


def delay_bands(flights: DataFrame, airport: str = HOME) -> DataFrame:
    return daily_departure_delay(flights, airport).select(
        "flight_date", "avg_delay", band(F.col("avg_delay")).alias("band")
    )


def delay_alerts(flights: DataFrame, airport: str = HOME) -> DataFrame:
    """Days in the red band."""
    return delay_bands(flights, airport).where("band = 'red'").select("flight_date", "avg_delay")


def share_by(flights: DataFrame, column: str, airport: str = HOME) -> DataFrame:
    """Counts of a pie panel with their part of the whole, largest first."""
    counts = count_by(flights, column, airport).withColumnRenamed("n_flights", "n")
    return panels.ranked(panels.share(counts, "n"), "n", column)


def selected_flights(
    flights: DataFrame,
    airlines: Iterable[str],
    destinations: Iterable[str] = ("$__all",),
    airport: str = HOME,
) -> DataFrame:
    """Departures of the airlines and destinations picked in the dashboard variables."""
    return (
        departing(flights, airport)
        .where(any_selected(F.col("airline_name"), airlines))
        .where(any_selected(F.col("arrival_airport"), destinations))
        .select("flight_iata", "arrival_airport", "airline_name")
    )


def in_time_range(rows: DataFrame, column: str, low: Column, high: Column) -> DataFrame:
    """Rows whose time is in a range; with the month folder of the scheduled departure among the
    columns, folders outside the range are not read."""
    within = F.col(column).between(low, high)
    if column == "departure_scheduled" and FLIGHT_MONTH in rows.columns:
        first, last = (F.date_format(t, MONTH_FORMAT) for t in (low, high))
        within = within & F.col(FLIGHT_MONTH).between(first, last)
    return rows.where(within)


def in_last_hours(rows: DataFrame, column: str, hours: int = DASHBOARD_HOURS) -> DataFrame:
    """The dashboards' relative time range, ending now."""
    now = F.current_timestamp()
    return in_time_range(rows, column, now - F.make_dt_interval(hours=F.lit(hours)), now)
