"""Landed pages as a topic: every file gets a position of its own, without gaps.

A stream over a folder of pages numbers the files of each batch in the order of their
times and names, after those of the batch before. Messages go to a folder for each batch, and
the next free offset is then written down for the batch. A batch that runs again finds its mark and does
nothing, or replaces what it left behind by the same messages at the same offsets.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aeroflow import schemas
from aeroflow.sinks.topic import WIDE_ROWS
from aeroflow.sources.topics import FileTopic

_PLACES = 33  # bits that count rows within a task, in the numbers that Spark gives to rows

# The files of a batch are looked up by a job with a task for each file, unless told otherwise.
_LOOKUP = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_LOOKUP_TASKS = 16


@dataclass(frozen=True)
class LandedTopic:
    """A topic below ``path`` of the pages landed in ``folder``, with its checkpoint.

    A page that is landed again under the same name with a new time is a new message with the same key.
    Files more than ``max_age`` older than the newest are taken for read, so that the stream need not remember
    every file there ever was. At most ``max_files`` pages are in a batch; pages are sorted by tasks that each take a range of times.
    """

    folder: str
    path: str
    topic: str
    max_files: int = 10_000
    max_age: str = "7d"

    def update(self, spark: SparkSession) -> None:
        """Takes in the pages that have been landed since the last update."""
        pages = spark.readStream.format("text").option("wholetext", "true").option("maxFilesPerTrigger", self.max_files)
        named = pages.option("maxFileAge", self.max_age).load(self.folder).select(
            F.col("_metadata.file_path").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
            F.col("_metadata.file_modification_time").alias("timestamp"),
        )
        writer = named.writeStream.option("checkpointLocation", f"{self.path}/checkpoint")
        before = spark.conf.get(_LOOKUP)
        spark.conf.set(_LOOKUP, str(_LOOKUP_TASKS))
        try:
            writer.foreachBatch(self._take).trigger(availableNow=True).start().awaitTermination()
        finally:
            spark.conf.set(_LOOKUP, before)

    def records(self) -> FileTopic:
        return FileTopic(f"{self.path}/messages/batch=*")

    def _next_offset(self, spark: SparkSession, batch_id: int) -> int | None:
        """The offset after a batch, None if it is not complete. Looks into one folder."""
        if batch_id < 0:
            return 0
        try:
            mark = spark.read.schema("next bigint").parquet(f"{self.path}/marks/batch={batch_id}").first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return mark["next"] if mark else None

    def _take(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if self._next_offset(spark, batch_id) is not None:
            return
        first = self._next_offset(spark, batch_id - 1)
        if first is None:
            raise RuntimeError(f"batch {batch_id - 1} of {self.path} has no mark")
        ordered = batch.repartitionByRange("timestamp", "key").sortWithinPartitions("timestamp", "key")
        stage = f"{self.path}/stage"
        ordered.withColumn("place", F.monotonically_increasing_id()).write.mode("overwrite").options(**WIDE_ROWS).parquet(stage)
        staged = spark.read.schema("key binary, value binary, timestamp timestamp, place bigint").parquet(stage)
        part = F.shiftright("place", _PLACES).alias("part")
        # A row for each task.
        parts = staged.groupBy(part).agg(F.count("*").alias("n"))
        earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        starts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
        offset = F.lit(first) + F.col("before") + F.col("place").bitwiseAND(F.lit((1 << _PLACES) - 1))
        numbered = staged.withColumn("part", part).join(starts, "part").select(
            "key", "value", F.lit(self.topic).alias("topic"), F.lit(0).alias("partition"), offset.alias("offset"), "timestamp"
        )
        numbered.select(*schemas.MESSAGE_FIELDS).write.mode("overwrite").options(**WIDE_ROWS).parquet(f"{self.path}/messages/batch={batch_id}")
        mark = staged.agg((F.lit(first) + F.count("*")).alias("next"))
        mark.write.mode("overwrite").parquet(f"{self.path}/marks/batch={batch_id}")
