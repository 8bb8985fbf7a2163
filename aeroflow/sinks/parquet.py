"""Append-only Parquet tables that a replayed micro-batch cannot duplicate."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

JOB = "job"
BATCH = "batch_id"
PAGE_ROWS = 2000

# Folder column of tables that have one below their batches.
FOLDERS = {"flights": "flight_month"}


@dataclass(frozen=True)
class ParquetSink:
    """One folder per table, job and batch, so several jobs can share the tables.

    Batch numbers start anew with each checkpoint; the job, which carries an id kept
    with the checkpoint, tells them apart. A batch overwrites its own folders, so running
    it again replaces what a failed attempt left behind. Its audit rows are written last;
    readers only take batches that have them, so no reader sees one table of a batch
    without the others.
    """

    root: str
    audit_table: str = "ingest_audit"

    def _folder(self, table: str, job: str, batch_id: int) -> str:
        return f"{self.root}/{table}/{JOB}={job}/{BATCH}={batch_id}"

    def open(self, spark: SparkSession, audit_ddl: str) -> None:
        """Nothing to prepare: a missing folder reads as an empty table."""

    def write(self, table: str, rows: DataFrame, job: str, batch_id: int) -> None:
        writer = rows.write.mode("overwrite").option("parquet.page.row.count.limit", PAGE_ROWS)
        if FOLDERS.get(table) in rows.columns:
            writer = writer.partitionBy(FOLDERS[table])
        writer.parquet(self._folder(table, job, batch_id))

    def commit(self, audit: DataFrame, job: str, batch_id: int) -> None:
        # At most one row per topic partition.
        audit.coalesce(1).write.mode("overwrite").parquet(self._folder(self.audit_table, job, batch_id))

    def audit(self, spark: SparkSession, ddl: str) -> DataFrame:
        return self._all(spark, self.audit_table, ddl)

    def read(self, spark: SparkSession, table: str, ddl: str) -> DataFrame:
        """Rows of committed batches, with their ``job``, ``batch_id`` and folder column."""
        committed = self._all(spark, self.audit_table, "topic string").select(JOB, BATCH).distinct()
        return self._all(spark, table, ddl).join(committed, [JOB, BATCH], "left_semi")

    def committed(self, spark: SparkSession, job: str, batch_id: int, ddl: str) -> DataFrame:
        """Audit rows of one batch; none if it has not been committed."""
        # Looks into the one folder, however many batches there have been.
        return _read_or_empty(spark, self._folder(self.audit_table, job, batch_id), ddl)

    def _all(self, spark: SparkSession, table: str, ddl: str) -> DataFrame:
        if table in FOLDERS:
            ddl = f"{ddl}, {FOLDERS[table]} string"
        return _read_or_empty(spark, f"{self.root}/{table}", f"{ddl}, {JOB} string, {BATCH} bigint")


def _read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_sorted(rows: DataFrame, path: str, *order: str) -> None:
    """Writes a table in files that each hold a range of ``order``, with short pages."""
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.write.mode("overwrite").option("parquet.page.row.count.limit", PAGE_ROWS).parquet(path)


def write_clustered(
    rows: DataFrame, path: str, folder: str, within: list[str], shape: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """Writes a table in folders, with few files per folder.

    ``rebalance`` brings the rows of a folder together, but splits a folder that
    is larger than the advisory partition size over several tasks, so a hot
    folder does not end up in one. Rows are sorted within a file and pages are
    short: a filter on the first sort column then reads a few pages of a file.
    ``shape`` makes the stored rows, with their ``folder``, of the sorted ones.
    """
    ordered = rows.hint("rebalance", F.col(folder)).sortWithinPartitions(folder, *within)
    (
        (shape(ordered) if shape else ordered)
        .write.mode("overwrite")
        .partitionBy(folder)
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .parquet(path)
    )
