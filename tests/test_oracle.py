"""Every registered query against DuckDB on the given tables."""

import pytest
from compare import connect, duck_rows, spark_rows

import __spark_entry__ as contract
from aeroflow import oracles
from aeroflow.registry import QUERIES

ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = connect(sf_dir)
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= contract.queries().items()
    assert ORACLES.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, sf_dir, duck, name):
    names, rows = spark_rows(QUERIES[name](spark, sf_dir))
    expected_names, expected = duck_rows(duck, ORACLES[name])
    assert names == expected_names
    assert len(rows) == len(expected)
    assert rows == expected


def test_entry(spark, small_dir):
    result = contract.entry(spark)
    assert result.columns == ["arrival_airport", "n_flights"]
    assert 0 < result.count() <= 5


@pytest.mark.parametrize(
    "name",
    ["departures_per_day", "avg_departure_delay", "top_destinations", "flights_by_airline",
     "latest_flights", "airports_by_country", "value_by_country", "top_countries",
     "ranked_airports", "top_airports", "distinct_airport_ids", "topic_peek"],
)
def test_sorted_results_keep_their_order(spark, sf_dir, duck, name):
    result = QUERIES[name](spark, sf_dir)
    order = sorted(result.columns)
    ours = [tuple(row[c] for c in order) for row in result.collect()]
    cursor = duck.execute(f'select {", ".join(chr(34) + c + chr(34) for c in order)} from ({ORACLES[name]})')
    theirs = cursor.fetchall()
    assert [_rounded(r) for r in ours] == [_rounded(r) for r in theirs]


def _rounded(row):
    return tuple(float(f"{v:.9g}") if isinstance(v, float) else v for v in row)
