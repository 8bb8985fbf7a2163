"""Skewed inputs, and the plans that must hold at any size."""

from __future__ import annotations

import re

import pytest
from compare import connect, duck_rows, spark_rows
from pyspark.sql import functions as F

import __spark_entry__ as contract
from aeroflow.operators import decode
from aeroflow.registry import QUERIES
from aeroflow.sinks.parquet import write_clustered
from aeroflow.sources import generated
from aeroflow.workspace import Workspace


@pytest.fixture(scope="module")
def skewed_dir(spark, small_dir, tmp_path_factory):
    """The small tables, but one supplier and one row hold a third of all lines each,
    and one customer a third of all orders."""
    root = tmp_path_factory.mktemp("skewed")
    read = lambda name: spark.read.parquet(f"{small_dir}/{name}.parquet")
    lines = read("lineitem")
    third = lines.withColumn("l_suppkey", F.lit(2).cast("bigint"))
    copies = lines.where("l_suppkey = 4").limit(1).crossJoin(spark.range(6000)).drop("id")
    tables = {"lineitem": lines.unionByName(third).unionByName(copies)}
    hot = F.when(F.col("o_orderkey") % 3 == 0, F.lit(1).cast("bigint")).otherwise(F.col("o_custkey"))
    tables["orders"] = read("orders").withColumn("o_custkey", hot)
    for name in ("supplier", "nation", "customer", "events"):
        tables[name] = read(name)
    for name, rows in tables.items():
        rows.coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return str(root)


def test_no_message_grows_with_a_hot_key(spark, skewed_dir):
    messages = generated.airport_messages(spark, skewed_dir)
    parsed = decode.parse_airports(messages, ["_id", "frequencies", "runways"])
    largest = parsed.agg(F.max(F.size("frequencies"))).first()[0]
    assert largest < 1.5 * generated.CHILDREN_PER_MESSAGE
    hot = parsed.where("_id = 'ap2'").agg(F.count("*"), F.sum(F.size("frequencies"))).first()
    assert hot[0] > 10 and hot[1] > 6000


def test_page_size_of_flights(spark, small_dir):
    messages = generated.flight_messages(spark, small_dir, per_message=10)
    sizes = decode.parse_flight_pages(messages).select(F.size("flights").alias("n"))
    assert sizes.agg(F.max("n")).first()[0] < 40
    assert sizes.agg(F.sum("n")).first()[0] == 1500


SKEW_CHECKED = (
    "frequencies_explode", "runways_explode", "airports_dedup", "value_by_airport", "value_by_country",
    "airport_heatmap", "flights_flatten", "batch_counts", "stream_frequencies_ingest",
    "stream_airports_ingest",
)


@pytest.mark.parametrize("name", SKEW_CHECKED)
def test_skewed_tables_give_whole_results(spark, skewed_dir, name):
    con = connect_folders(skewed_dir)
    assert spark_rows(QUERIES[name](spark, skewed_dir)) == duck_rows(con, contract.oracle_sql()[name])


def connect_folders(root):
    con = connect("/nowhere")
    for name in ("lineitem", "orders", "supplier", "nation", "customer", "events"):
        con.execute(f"create view {name} as select * from read_parquet('{root}/{name}.parquet/*.parquet')")
    return con


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins_python_or_single_task_windows(spark, small_dir, name):
    text = plan(QUERIES[name](spark, small_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Window", "PythonUDF", "MapInPandas"):
        assert operator not in text


# One parse, and three more for each array that is read anew where it did not parse as a whole.
@pytest.mark.parametrize(
    "name, parses",
    [("airports_flatten", 1), ("frequencies_explode", 4), ("runways_explode", 4), ("flights_flatten", 4),
     ("batch_counts", 7), ("airports_parse", 1)],
)
def test_documents_are_parsed_once(spark, small_dir, name, parses):
    text = plan(QUERIES[name](spark, small_dir)).split("== Initial Plan ==")[0]
    assert len(re.findall(r"from_json\(", text)) == parses


def test_filters_and_columns_reach_the_scan(spark, small_dir):
    scan = next(l for l in plan(QUERIES["top_destinations"](spark, small_dir)).splitlines() if "FileScan" in l)
    assert "EqualTo(departure_iata,JFK)" in scan
    assert "ReadSchema: struct<departure_iata:string,arrival_airport:string>" in scan
    for name in ("filter_time_range", "stream_time_range"):
        scan = next(l for l in plan(QUERIES[name](spark, small_dir)).splitlines() if "FileScan" in l and "flight_month" in l)
        assert "GreaterThanOrEqual(departure_scheduled" in scan and "LessThanOrEqual(departure_scheduled" in scan
        folders = scan[scan.index("PartitionFilters:"):].split("]")[0]
        assert "flight_month" in folders and "1998-01" in folders and "1998-02" in folders
    scan = next(l for l in plan(QUERIES["replay_from_offset"](spark, small_dir)).splitlines() if "FileScan" in l)
    assert "GreaterThanOrEqual(offset,20)" in scan
    scan = next(l for l in plan(QUERIES["topic_peek"](spark, small_dir)).splitlines() if "FileScan" in l)
    assert "EqualTo(partition,0)" in scan and "EqualTo(offset,4)" in scan


def test_top_k_does_not_sort_everything(spark, small_dir):
    for name in ("top_destinations", "latest_flights", "top_airports", "top_countries"):
        text = plan(QUERIES[name](spark, small_dir))
        assert "TakeOrderedAndProject" in text, name


def test_totals_are_summed_before_the_join(spark, small_dir):
    text = plan(QUERIES["value_by_country"](spark, small_dir))
    join = next(i for i, l in enumerate(text.splitlines()) if "Join" in l)
    below = "\n".join(text.splitlines()[join:])
    assert "partial_sum(try_cast(value" in below


def test_a_table_is_built_once(spark, small_dir):
    space = Workspace(spark, small_dir)
    space.table("flights")
    files = space.table("flights").inputFiles()
    assert space.table("flights").inputFiles() == files
    row_groups = space.spark.read.parquet(f"{space.root}/tables/flights").select("flight_month").distinct()
    assert row_groups.count() > 12


def test_sql_text_over_the_views(spark, small_dir):
    from aeroflow.sources.tables import register_views
    from aeroflow.workspace import workspace

    space = workspace(spark, small_dir)
    space.table("flights"), space.table("airports")
    register_views(spark, f"{space.root}/tables")
    found = spark.sql(
        "select status, count(*) as n, count(distinct airline) as a from flights group by status"
    )
    assert found.count() == 3
    assert spark.sql("select name from AIRPORTSINT where latitude between -90 and 90").count() == 10


def test_one_airport_reads_few_pages(spark, tmp_path):
    rows = spark.range(40_000).select(
        F.lit("2025-01").alias("flight_month"),
        F.concat(F.lit("A"), F.col("id") % 20).alias("departure_iata"),
        F.col("id"),
    )
    write_clustered(rows, str(tmp_path / "t"), "flight_month", ["departure_iata"])
    table = spark.read.parquet(str(tmp_path / "t"))
    found = table.where("departure_iata = 'A7'").select("id")
    executed = found._jdf.queryExecution().executedPlan()
    assert executed.execute().count() == 2000
    while executed.children().size():
        executed = executed.children().apply(0)
    assert executed.metrics().apply("numOutputRows").value() <= 8000
