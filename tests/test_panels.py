"""Panel computations on hand-written rows."""

import pytest
from pyspark.sql import functions as F

from aeroflow.functions import any_selected, as_numeric, band, min_max_scale
from aeroflow.functions.bands import GREEN_ONLY
from aeroflow.operators import panels
from aeroflow.plans import airports as ap
from aeroflow.plans import flights as fl


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("value, colour", [(None, "green"), (79.9, "green"), (80.0, "red"), (200.0, "red")])
def test_absolute_bands(spark, value, colour):
    assert one(spark, band(F.lit(value).cast("double"))) == colour


def test_bands_take_the_highest_step(spark):
    steps = ((None, "green"), (10.0, "yellow"), (80.0, "red"))
    frame = spark.createDataFrame([(5.0,), (10.0,), (85.0,)], "v double")
    assert [r[0] for r in frame.select(band(F.col("v"), steps)).collect()] == ["green", "yellow", "red"]


def test_percentage_bands(spark):
    steps = ((None, "green"), (50.0, "red"))
    frame = spark.createDataFrame([(10.0,), (14.0,), (15.0,), (20.0,)], "v double")
    low, high = panels.value_range(frame, "v")
    bands = frame.select("v", band(F.col("v"), steps, low=low, high=high).alias("b")).collect()
    assert {r["v"]: r["b"] for r in bands} == {10.0: "green", 14.0: "green", 15.0: "red", 20.0: "red"}
    only = frame.select(band(F.col("v"), GREEN_ONLY, low=low, high=high).alias("b")).distinct()
    assert [r["b"] for r in only.collect()] == ["green"]
    with pytest.raises(ValueError):
        band(F.col("v"), low=low)


def test_scale_of_equal_values(spark):
    assert one(spark, min_max_scale(F.lit(3.0), F.lit(3.0), F.lit(3.0))) == 0.0


def test_last_not_null(spark):
    series = spark.createDataFrame(
        [(1, 10, 0.5), (2, 20, 0.7), (3, 30, None)], "day int, n int, d double"
    )
    assert tuple(panels.last_not_null(series, ["n", "d"], "day").first()) == (30, 0.7)


def test_ranking_puts_null_first_and_breaks_ties_by_key(spark):
    rows = spark.createDataFrame([("b", 2), ("a", 2), ("c", None), ("d", 3)], "k string, n int")
    assert [r["k"] for r in panels.ranked(rows, "n", "k").collect()] == ["c", "d", "a", "b"]
    assert [r["k"] for r in panels.top(rows, "n", "k", 2).collect()] == ["c", "d"]


def test_share(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 3)], "k string, n int")
    assert {r["k"]: r["share"] for r in panels.share(rows, "n").collect()} == {"a": 0.25, "b": 0.75}


def test_multi_select(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    assert rows.where(any_selected(F.col("k"), ["a"])).count() == 1
    assert rows.where(any_selected(F.col("k"), ["$__all"])).count() == 3
    assert rows.where(any_selected(F.col("k"), [])).count() == 0


def test_numeric_text(spark):
    assert str(one(spark, as_numeric(F.lit("118.700")))) == "118.70000000"
    assert one(spark, as_numeric(F.lit("abc"))) is None


def test_literal_relation(spark):
    assert [tuple(r) for r in fl.literal_delay(spark).collect()] == [(22, "min")]


def test_display_names(spark):
    rows = spark.createDataFrame([("F1", "A")], "flight_iata string, airline_name string")
    assert fl.with_display_names(rows, fl.LATEST_FLIGHTS_LABELS).columns == ["Numéro de vol", "Compagnie"]


def test_approximate_airline_count(spark):
    rows = spark.createDataFrame([("s", "a"), ("s", "b"), ("s", None)], "flight_status string, airline_name string")
    for approximate in (True, False):
        assert tuple(fl.status_airline_stats(rows, approximate=approximate).first()) == ("s", 3, 2)


def test_totals_join_one_row_per_airport(spark):
    frequencies = spark.createDataFrame([("a", "1.5"), ("a", "2.5"), ("b", "x"), (None, "9")],
                                        "airport_id string, value string")
    airports = spark.createDataFrame([("a", "A", "FR", None), ("b", "B", "FR", None)],
                                     "_id string, name string, country string, geometry string")
    assert [(r[0], float(r[1])) for r in ap.value_by_country(frequencies, airports).collect()] == [("FR", 4.0)]
    ranked = [(r["name"], r["total_value"]) for r in ap.ranked_airports(frequencies, airports).collect()]
    assert ranked[0] == ("B", None) and ranked[1][0] == "A"
    heat = {r["name"]: r["weight"] for r in ap.airport_heatmap(frequencies, airports).collect()}
    assert heat == {"A": 0.0, "B": None}


def test_freshness_is_one_aggregation(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 5), ("b", 2)], "_id string, created_at int")
    assert ap.data_freshness(rows).first()[0] == 5
    assert {r[0]: r[1] for r in ap.freshness_by(rows).collect()} == {"a": 5, "b": 2}


def test_relative_time_range(spark):
    ages = spark.createDataFrame([(1,), (5,), (7,)], "hours int")
    rows = ages.withColumn("at", F.current_timestamp() - F.make_dt_interval(hours=F.col("hours")))
    assert sorted(r["hours"] for r in fl.in_last_hours(rows, "at").collect()) == [1, 5]
    assert [r["hours"] for r in fl.in_last_hours(rows, "at", 2).collect()] == [1]
