"""Publishing rows as JSON messages."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aeroflow.functions import json_record


# For files of whole documents. A reader decodes up to 4096 rows of a row group at
# once; at some hundred kilobytes a document that would be gigabytes per task. The
# size is looked at after every ten rows, as ten documents can already fill it.
WIDE_ROWS = {"parquet.block.size": str(4 * 2**20), "parquet.page.size.row.check.min": "10"}


def to_records(rows: DataFrame, key: Column | None = None) -> DataFrame:
    """``key`` and ``value`` of the messages that carry these rows."""
    key = F.lit(None) if key is None else key
    return rows.select(
        key.cast("binary").alias("key"),
        json_record(rows.columns).cast("binary").alias("value"),
    )


@dataclass(frozen=True)
class KafkaTopicSink:
    """Needs the Kafka connector on the session's class path."""

    servers: str
    topic: str
    options: Mapping[str, str] = field(default_factory=dict)

    def write_options(self) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.servers, "topic": self.topic, **self.options}

    def publish(self, records: DataFrame) -> None:
        records.write.format("kafka").options(**self.write_options()).save()


# Rows of a partition are numbered in so many groups at once.
NUMBERING_GROUPS = 64


def topic_partition(key: Column, partitions: int) -> Column:
    """The partition of a key: equal keys share one; records without a key are in the first."""
    number = F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint")
    return F.coalesce(F.pmod(number, F.lit(partitions)), F.lit(0)).cast("int")


@dataclass(frozen=True)
class FileTopicSink:
    """A folder of Parquet files holding the record columns."""

    path: str

    def append(self, records: DataFrame, topic: str, stage: str, partitions: int = 3) -> None:
        """Appends ``key`` and ``value`` as messages of a topic, with offsets that have no gaps.

        Records are staged first, so that a task that runs again numbers the same rows. Rows of a
        partition are numbered in groups, and groups by the sums of those before, so a key that holds a third
        of all records is no single task. One append of a topic runs at a time.
        """
        spark = records.sparkSession
        placed = records.select("key", "value", topic_partition(F.col("key"), partitions).alias("partition"))
        group = F.pmod(F.monotonically_increasing_id(), F.lit(NUMBERING_GROUPS)).cast("int")
        placed.withColumn("group", group).write.mode("overwrite").options(**WIDE_ROWS).parquet(stage)
        staged = spark.read.schema("key binary, value binary, partition int, group int").parquet(stage)
        # A row for each partition and group.
        counts = staged.groupBy("partition", "group").agg(F.count("*").alias("n"))
        earlier = Window.partitionBy("partition").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
        starts = counts.select("partition", "group", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
        ends = self._ends(spark).select("partition", "next")
        first = (F.coalesce("next", F.lit(0)) + F.col("before")).alias("first")
        starts = starts.join(ends, "partition", "left").select("partition", "group", first)
        within = F.row_number().over(Window.partitionBy("partition", "group").orderBy("key", "value")) - 1
        numbered = staged.withColumn("place", within).join(starts, ["partition", "group"]).select(
            "key", "value", F.lit(topic).alias("topic"), "partition", (F.col("first") + F.col("place")).alias("offset"),
            F.current_timestamp().alias("timestamp"),
        )
        self.publish(numbered.sortWithinPartitions("partition", "offset"))

    def _ends(self, spark: SparkSession) -> DataFrame:
        """The next offset of each partition; no message is opened."""
        empty = spark.createDataFrame([], "partition int, next bigint")
        try:
            there = spark.read.schema("partition int, offset bigint").parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return empty
        return there.groupBy("partition").agg((F.max("offset") + 1).alias("next"))

    def publish(self, records: DataFrame, mode: str = "append") -> None:
        records.write.mode(mode).options(**WIDE_ROWS).parquet(self.path)
