"""Options and record shapes of the connectors that need a server, and the file ones."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from aeroflow import schemas
from aeroflow.functions import json_paths, paths_schema
from aeroflow.operators import decode
from aeroflow.sinks import FileTopicSink, JdbcSink, KafkaTopicSink, to_records
from aeroflow.sinks.jdbc import encode_arrays
from aeroflow.sources.jdbc import Database, Split
from aeroflow.sources.topics import FileTopic, KafkaTopic, peek
from aeroflow.session import shared_dir
from aeroflow.streaming import FLIGHT_JOB, ingest


def test_kafka_options():
    topic = KafkaTopic("broker:1", "flights", max_offsets_per_trigger=500, options={"failOnDataLoss": "false"})
    assert topic.stream_options() == {
        "kafka.bootstrap.servers": "broker:1", "subscribe": "flights", "startingOffsets": "earliest",
        "failOnDataLoss": "false", "maxOffsetsPerTrigger": "500",
    }
    ranged = topic.range_options({0: 12, 2: 5})
    assert json.loads(ranged["startingOffsets"]) == {"flights": {"0": 12, "2": 5}}
    assert ranged["endingOffsets"] == "latest"
    assert topic.range_options()["startingOffsets"] == "earliest"
    assert KafkaTopicSink("broker:1", "flights").write_options() == {
        "kafka.bootstrap.servers": "broker:1", "topic": "flights"}


def test_file_topic_reads_like_kafka(spark, messages, tmp_path):
    topic = FileTopic(str(tmp_path / "t"))
    messages([flights for flights in ("{}", "{}", "{}", "{}")]).write.parquet(topic.path)
    assert topic.read(spark).columns == list(schemas.MESSAGE_FIELDS)
    assert [r["offset"] for r in peek(topic.read(spark), 2).collect()] == [0, 1]
    assert sorted(r["offset"] for r in topic.read(spark, {0: 2}).collect()) == [2, 3]
    assert topic.read(spark, {5: 100}).count() == 4
    assert topic.read(spark, {}).count() == 4


def test_publish_and_read_back(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, None), ("b", None, 2.5)], "k string, n int, x double")
    sink = FileTopicSink(str(tmp_path / "t"))
    sink.publish(to_records(rows, F.col("k")))
    records = spark.read.parquet(sink.path)
    assert {(bytes(r["key"]), bytes(r["value"])) for r in records.collect()} == {
        (b"a", b'{"k":"a","n":1}'), (b"b", b'{"k":"b","x":2.5}')}
    back = decode.open_document(records, {"k": "string", "n": "int", "x": "double"})
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))


def test_database_options():
    database = Database("jdbc:postgresql://host/db", {"user": "u", "driver": "d"})
    assert database.options("flights") == {
        "url": "jdbc:postgresql://host/db", "dbtable": "flights", "stringtype": "unspecified",
        "user": "u", "driver": "d"}
    assert "stringtype" not in Database("jdbc:other:x").options("t")


def test_probe_fails_without_a_database(spark):
    with pytest.raises(Exception):
        Database("jdbc:nosuchdb:x").probe(spark)


def test_arrays_become_json_text(spark):
    rows = spark.createDataFrame([([1, 2], "x"), (None, "y")], "a array<int>, b string")
    assert [tuple(r) for r in encode_arrays(rows).collect()] == [("[1,2]", "x"), (None, "y")]


class FolderDatabase:
    """Append and read of tables as a database offers them, on folders."""

    def __init__(self, root):
        self.root = root

    def append(self, rows, table):
        rows.write.mode("append").parquet(f"{self.root}/{table}")

    def read(self, spark, table):
        return spark.read.parquet(f"{self.root}/{table}")


def test_rows_of_a_failed_attempt_are_not_read(spark, tmp_path):
    database = FolderDatabase(str(tmp_path))
    rows = spark.createDataFrame([(1, [1])], "n int, a array<int>")
    audit = spark.createDataFrame([("t",)], "topic string")
    done = JdbcSink(database)
    done.write("flights", rows, "job", 0)
    done.commit(audit, "job", 0)

    JdbcSink(database).write("flights", rows, "job", 1)  # an attempt that never commits
    again = JdbcSink(database)
    assert again.committed(spark, "job", 0, "topic string").count() == 1
    assert again.committed(spark, "job", 1, "topic string").isEmpty()
    assert again.committed(spark, "other", 0, "topic string").isEmpty()
    again.write("flights", rows, "job", 1)
    again.commit(audit, "job", 1)

    assert database.read(spark, "flights").count() == 3
    kept = again.read(spark, "flights")
    assert sorted(r["batch_id"] for r in kept.collect()) == [0, 1]
    assert {r["a"] for r in kept.collect()} == {"[1]"}


def test_a_job_can_start_on_an_empty_database(spark, messages, tmp_path):
    topic = FileTopic(str(tmp_path / "topic"))
    messages([{"data": [{"flight": {"iata": "A"}}]}, "{oops"]).write.parquet(topic.path)
    sink = JdbcSink(FolderDatabase(str(tmp_path / "db")))
    for _ in range(2):
        ingest(spark, FLIGHT_JOB, topic, sink, str(tmp_path / "checkpoint"))
    assert [r["flight_iata"] for r in sink.read(spark, "flights").collect()] == ["A"]
    assert [r["reason"] for r in sink.read(spark, "rejects").collect()] == ["malformed"]


def test_two_jobs_share_a_database(spark, messages, tmp_path):
    from aeroflow.streaming import AIRPORT_JOB

    sink = JdbcSink(FolderDatabase(str(tmp_path / "db")))
    for job, value in ((AIRPORT_JOB, {"_id": "a", "frequencies": [{"_id": "f"}]}), (FLIGHT_JOB, {"flight": {"iata": "A"}})):
        topic = FileTopic(str(tmp_path / job.name))
        messages([value], topic=job.name).write.parquet(topic.path)
        ingest(spark, job, topic, sink, str(tmp_path / f"checkpoint-{job.name}"))
    assert [sink.read(spark, t).count() for t in ("airports", "frequencies", "flights")] == [1, 1, 1]


def test_options_that_split_reads():
    split = Split("id", "0", "1000", 8)
    assert split.options() == {"partitionColumn": "id", "lowerBound": "0", "upperBound": "1000", "numPartitions": "8"}
    topic = KafkaTopic("b:1", "t", min_partitions=64)
    assert topic.stream_options()["minPartitions"] == topic.range_options()["minPartitions"] == "64"
    assert "minPartitions" not in KafkaTopic("b:1", "t").stream_options()


def test_json_record_operators(spark, messages):
    pages = messages([{"data": [{"a": {"b": 1}, "c": "x"}, {"c": None}]}, "{oops", {"data": None}])
    records = decode.split_records(pages)
    assert [(r["offset"], r["pos"], r["record"]) for r in records.collect()] == [
        (0, 0, '{"a":{"b":1},"c":"x"}'), (0, 1, '{"c":null}')]
    paths = {"b": "$.a.b", "c": "$.c"}
    assert [tuple(r) for r in decode.extract_paths(records, paths).collect()] == [("1", "x"), (None, None)]
    assert [r[0] for r in decode.normalize_records(records, paths).collect()] == ['{"b":"1","c":"x"}', "{}"]
    assert [r[0] for r in decode.rewrite_records(records, "c string").collect()] == ['{"c":"x"}', "{}"]


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_dir(spark, "x").endswith("/x")


def test_one_parse_extracts_what_single_paths_do(spark):
    texts = ['{"a":{"b":1.50,"c":"x"},"d":true,"e":[1,{"f":2}],"g":{"h": 1}}', '{"a":null}', "{}", "[1]", "{bad", None]
    records = spark.createDataFrame([(t,) for t in texts], "record string")
    paths = {"b": "$.a.b", "c": "$.a.c", "d": "$.d", "e": "$.e", "g": "$.g"}
    assert paths_schema(paths.values()) is not None
    single = records.select(*json_paths(F.col("record"), paths)).collect()
    assert decode.extract_paths(records, paths).collect() == single
    assert paths_schema(["$.e[1].f"]) is None
    assert paths_schema(["$.a", "$.a.b"]) is None and paths_schema(["$.a.b", "$.a"]) is None
    indexed = decode.extract_paths(records, {"f": "$.e[1].f"}).collect()
    assert [r["f"] for r in indexed] == ["2"] + [None] * 5
