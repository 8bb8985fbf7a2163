"""Command line of the ingest jobs, for ``spark-submit``.

    python -m aeroflow.streaming flights --kafka broker:9092 --topic flights \\
        --tables /shared/tables --checkpoint /shared/checkpoints/flights
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from aeroflow.session import prepare
from aeroflow.sinks import JdbcSink, ParquetSink
from aeroflow.sources.jdbc import Database
from aeroflow.sources.topics import FileTopic, KafkaTopic, LandingFolder
from aeroflow.streaming.ingest import AIRPORT_JOB, FLIGHT_JOB, run_to_end, start

JOBS = {job.name: job for job in (AIRPORT_JOB, FLIGHT_JOB)}


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="aeroflow.streaming")
    parser.add_argument("job", choices=sorted(JOBS))
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--kafka", metavar="SERVERS")
    source.add_argument("--files", metavar="FOLDER", help="Parquet files of topic records")
    source.add_argument("--landing", metavar="FOLDER", help="API pages, one JSON file each")
    parser.add_argument("--max-files", type=int, default=10_000, help="landed files per micro-batch")
    parser.add_argument("--topic", help="Kafka topic; the job's name if not given")
    parser.add_argument("--starting-offsets", default="earliest")
    parser.add_argument("--max-offsets", type=int, default=200_000, help="records per micro-batch")
    sink = parser.add_mutually_exclusive_group(required=True)
    sink.add_argument("--tables", metavar="FOLDER")
    sink.add_argument("--jdbc", metavar="URL")
    parser.add_argument(
        "--jdbc-properties", metavar="FILE", help="JSON object: user, password, driver, ..."
    )
    parser.add_argument("--checkpoint", required=True, metavar="FOLDER")
    parser.add_argument("--once", action="store_true", help="stop when the topic has been read")
    return parser.parse_args(argv)


def topic_of(args: argparse.Namespace) -> KafkaTopic | FileTopic | LandingFolder:
    if args.landing:
        return LandingFolder(args.landing, args.topic or args.job, args.max_files)
    if args.files:
        return FileTopic(args.files)
    return KafkaTopic(args.kafka, args.topic or args.job, args.starting_offsets, args.max_offsets)


def sink_of(args: argparse.Namespace, spark: SparkSession) -> ParquetSink | JdbcSink:
    if args.tables:
        return ParquetSink(args.tables)
    properties = {}
    if args.jdbc_properties:
        with open(args.jdbc_properties) as file:
            properties = json.load(file)
    database = Database(args.jdbc, properties)
    database.probe(spark)
    return JdbcSink(database)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = prepare(SparkSession.builder.appName(f"ingest-{args.job}").getOrCreate())
    sink = sink_of(args, spark)
    run_to_end(
        start(
            spark, JOBS[args.job], topic_of(args), sink, args.checkpoint, until_caught_up=args.once
        )
    )


if __name__ == "__main__":
    main()
