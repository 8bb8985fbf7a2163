"""Queries over the airports and frequencies tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroflow.functions import min_max_scale
from aeroflow.operators import cells, panels
from aeroflow.operators.flatten import with_position
from aeroflow.operators.numeric import is_number, numeric_order, sum_numeric

def airports_clean(airports: DataFrame) -> DataFrame:
    """Airports with an ICAO code, their position as numbers."""
    return with_position(airports.where(F.col("icao_code").isNotNull())).select(
        "_id", "icao_code", "latitude", "longitude"
    )


def airports_in_box(
    airports: DataFrame,
    latitudes: tuple[float, float] = (40.0, 50.0),
    longitudes: tuple[float, float] = (-5.0, 10.0),
) -> DataFrame:
    return (
        with_position(airports)
        .where(F.col("latitude").between(*latitudes))
        .where(F.col("longitude").between(*longitudes))
        .select("name", "latitude", "longitude")
    )


def positions_in_box(
    positions: DataFrame,
    latitudes: tuple[float, float] = (40.0, 50.0),
    longitudes: tuple[float, float] = (-5.0, 10.0),
) -> DataFrame:
    """``airports_in_box`` over the table of positions: pages outside the box are not read."""
    return positions.where(cells.in_box(latitudes, longitudes)).select("name", "latitude", "longitude")


def airport_geo_points(airports: DataFrame, code: str = "JFK") -> DataFrame:
    named = airports.where(
        F.col("geometry").isNotNull()
        & F.col("icao_code").isNotNull()
        & F.col("icao_code").like(f"%{code}%")
    )
    return with_position(named).select("name", "latitude", "longitude")


def airports_by_country(airports: DataFrame, n: int = 10) -> DataFrame:
    counts = airports.groupBy("country").agg(F.count("*").alias("nb_airports"))
    return panels.top(counts, "nb_airports", "country", n)


def total_value(frequencies: DataFrame) -> DataFrame:
    """The exact sum of all amounts, as text: amounts and sum have any number of digits."""
    return sum_numeric(frequencies, "value", [], "total_value")


def value_by_airport(frequencies: DataFrame) -> DataFrame:
    return sum_numeric(frequencies, "value", ["airport_id"], "total_value")


def airports_with_value(frequencies: DataFrame, airports: DataFrame, *columns: str) -> DataFrame:
    """Airport columns with the airport's total.

    ``airports`` must have one row per ``_id``, or totals would count twice.
    Frequencies are summed before the join, so both of its sides have one row
    per airport however many frequencies an airport has.
    """
    totals = value_by_airport(frequencies)
    wanted = airports.select("_id", *columns)
    return totals.join(wanted, F.col("airport_id") == F.col("_id")).drop("airport_id")


def value_by_country(frequencies: DataFrame, airports: DataFrame) -> DataFrame:
    totals = airports_with_value(frequencies, airports, "country")
    return _ranked(sum_numeric(totals, "total_value", ["country"], "total_value_country"), "total_value_country", "country")


def top_countries(frequencies: DataFrame, airports: DataFrame, n: int = 15) -> DataFrame:
    return value_by_country(frequencies, airports).limit(n)


def ranked_airports(frequencies: DataFrame, airports: DataFrame) -> DataFrame:
    totals = airports_with_value(frequencies, airports, "name").select("name", "total_value")
    return _ranked(totals, "total_value", "name")


def _ranked(totals: DataFrame, value: str, tie_break: str) -> DataFrame:
    """Largest total first, as ``panels.ranked`` does, by the values of the texts."""
    order = [F.desc_nulls_first(c) for c in numeric_order(F.col(value))]
    return totals.orderBy(*order, F.asc_nulls_last(tie_break))


def top_airports(frequencies: DataFrame, airports: DataFrame, n: int = 15) -> DataFrame:
    return ranked_airports(frequencies, airports).limit(n)


def airport_heatmap(frequencies: DataFrame, airports: DataFrame) -> DataFrame:
    """Position, total and 0..1 weight of every airport that has frequencies.

    The range of the totals is one row, read as a scalar subquery. Rows without
    an airport are left out first, as the join would do, so that the subquery
    and the join share one shuffle of the frequencies.
    """
    owned = frequencies.where(F.col("airport_id").isNotNull())
    low, high = panels.value_range(value_by_airport(owned), "total_value")
    points = with_position(airports_with_value(owned, airports, "name", "geometry"))
    value = F.col("total_value").cast("double")
    return points.select(
        "_id",
        "name",
        "latitude",
        "longitude",
        value.alias("total_value"),
        min_max_scale(value, low, high).alias("weight"),
    )


def distinct_airport_ids(airports: DataFrame) -> DataFrame:
    return airports.select("_id").distinct().orderBy(F.asc_nulls_last("_id"))


def airport_names(airports: DataFrame) -> DataFrame:
    return airports.select("name")


def uncastable(rows: DataFrame, *columns: str) -> DataFrame:
    """For each text column: values present, and those that are no number and so are in no sum."""
    present = [F.count(F.when(F.trim(c) != "", 1)) for c in columns]
    numbers = [F.count(F.when(is_number(F.col(c)), 1)) for c in columns]
    counted = F.array(*[
        F.struct(F.lit(c).alias("column_name"), p.alias("present"), (p - n).alias("uncastable"))
        for c, p, n in zip(columns, present, numbers, strict=True)
    ])
    return rows.agg(counted.alias("counted")).select(F.inline("counted"))


def data_freshness(rows: DataFrame, time: str = "created_at") -> DataFrame:
    return rows.agg(F.max(time).alias("latest"))


def freshness_by(rows: DataFrame, key: str = "_id", time: str = "created_at") -> DataFrame:
    """The repeated freshness panel: all its copies in one aggregation."""
    return rows.groupBy(key).agg(F.max(time).alias("latest"))
