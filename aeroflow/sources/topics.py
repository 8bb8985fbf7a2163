"""Topic readers: Kafka, and files that hold the same record columns."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroflow import schemas

Offsets = Mapping[int, int]

RECORD_COLUMNS = tuple(schemas.MESSAGE_FIELDS)


@dataclass(frozen=True)
class KafkaTopic:
    """A Kafka topic; needs the Kafka connector on the session's class path."""

    servers: str
    topic: str
    starting: str = "earliest"
    max_offsets_per_trigger: int | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    min_partitions: int | None = None  # more tasks than the topic has partitions

    def _common(self) -> dict[str, str]:
        return {"minPartitions": str(self.min_partitions)} if self.min_partitions else {}

    def stream_options(self) -> dict[str, str]:
        options = {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.topic,
            "startingOffsets": self.starting,
            **self._common(),
            **self.options,
        }
        if self.max_offsets_per_trigger:
            options["maxOffsetsPerTrigger"] = str(self.max_offsets_per_trigger)
        return options

    def range_options(self, start: Offsets | None = None) -> dict[str, str]:
        starting = "earliest"
        if start is not None:
            starting = json.dumps({self.topic: {str(p): o for p, o in start.items()}})
        return {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.topic,
            "startingOffsets": starting,
            "endingOffsets": "latest",
            **self._common(),
            **self.options,
        }

    def stream(self, spark: SparkSession) -> DataFrame:
        reader = spark.readStream.format("kafka").options(**self.stream_options())
        return reader.load().select(*RECORD_COLUMNS)

    def read(self, spark: SparkSession, start: Offsets | None = None) -> DataFrame:
        reader = spark.read.format("kafka").options(**self.range_options(start))
        return reader.load().select(*RECORD_COLUMNS)


@dataclass(frozen=True)
class FileTopic:
    """A folder of Parquet files with the record columns of a Kafka topic.

    A micro-batch is bounded, by bytes unless a number of files is given: a
    backlog is worked off in batches of a known size.
    """

    path: str
    max_files_per_trigger: int | None = None
    max_bytes_per_trigger: int = 256 * 2**30

    def stream(self, spark: SparkSession) -> DataFrame:
        reader = spark.readStream.schema(schemas.ddl_row(schemas.MESSAGE_FIELDS))
        if self.max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", self.max_files_per_trigger)
        else:
            reader = reader.option("maxBytesPerTrigger", self.max_bytes_per_trigger)
        return reader.parquet(self.path)

    def read(self, spark: SparkSession, start: Offsets | None = None) -> DataFrame:
        records = spark.read.schema(schemas.ddl_row(schemas.MESSAGE_FIELDS)).parquet(self.path)
        return records if start is None else records.where(_from_offsets(start))


def _from_offsets(start: Offsets) -> Column:
    """Per-partition lower bounds; partitions not named are read whole.

    A plain disjunction of comparisons, which Parquet row-group statistics can
    answer.
    """
    test = ~F.col("partition").isin(list(start))
    for partition, offset in start.items():
        test = test | ((F.col("partition") == partition) & (F.col("offset") >= offset))
    return test


def peek(records: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` records of a topic by partition and offset.

    Their positions are found without reading any value; fetching them then
    skips all row groups they are not in.
    """
    position = ("partition", "offset")
    first = records.select(*position).orderBy(*position).limit(n).collect()
    wanted = F.lit(False)
    for partition, offset in first:
        wanted = wanted | ((F.col("partition") == partition) & (F.col("offset") == offset))
    return records.where(wanted).orderBy(*position)


# Files of one microsecond that keep positions of their own.
FILES_PER_INSTANT = 4096


def landing_pages(spark: SparkSession, path: str, topic: str, max_files: int = 10_000) -> DataFrame:
    """A stream over a folder of API pages, one JSON document per file, ``max_files`` in a batch.

    The file stands in for the record position: it is the key, so a page that
    is landed again under the same name replaces the earlier one. Its offset is
    its modification time; the name tells files of one instant apart.
    """
    reader = spark.readStream.format("text").option("wholetext", "true")
    pages = reader.option("maxFilesPerTrigger", max_files).load(path)
    name = F.pmod(F.xxhash64("_metadata.file_path"), F.lit(FILES_PER_INSTANT))
    offset = F.unix_micros("_metadata.file_modification_time") * FILES_PER_INSTANT + name
    return pages.select(
        F.col("_metadata.file_path").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        offset.alias("offset"),
        F.col("_metadata.file_modification_time").alias("timestamp"),
    )


@dataclass(frozen=True)
class LandingFolder:
    """A folder that API pages are landed in, as a topic."""

    path: str
    topic: str
    max_files: int = 10_000

    def stream(self, spark: SparkSession) -> DataFrame:
        return landing_pages(spark, self.path, self.topic, self.max_files)
