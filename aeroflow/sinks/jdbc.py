"""Append-only relational tables that a replayed micro-batch cannot duplicate."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeroflow.sinks.parquet import BATCH, FOLDERS, JOB
from aeroflow.sources.jdbc import Database

ATTEMPT = "attempt"


def encode_arrays(rows: DataFrame) -> DataFrame:
    """Array columns as JSON text, for databases without an array type."""
    return rows.select(
        *[
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, T.ArrayType) else f.name
            for f in rows.schema.fields
        ]
    )


@dataclass(frozen=True)
class JdbcSink:
    """Appends rows tagged with their job, batch and attempt.

    Tasks append over their own connections, so a failed attempt can leave rows
    behind. The audit rows appended last name the attempt that completed;
    ``read`` and database views take only rows of such attempts. All jobs have audit
    rows of one shape, so they can share one database.
    """

    database: Database
    audit_table: str = "ingest_audit"
    native_arrays: bool = False
    attempt: dict[tuple[str, int], str] = field(default_factory=dict, repr=False)

    def _append(self, table: str, rows: DataFrame, job: str, batch_id: int) -> None:
        tag = self.attempt.setdefault((job, batch_id), uuid.uuid4().hex)
        rows = rows.drop(FOLDERS.get(table, ""))
        if not self.native_arrays:
            rows = encode_arrays(rows)
        tagged = rows.withColumns(
            {JOB: F.lit(job), BATCH: F.lit(batch_id).cast("bigint"), ATTEMPT: F.lit(tag)}
        )
        self.database.append(tagged, table)

    def open(self, spark: SparkSession, audit_ddl: str) -> None:
        """Appends no audit rows, which creates the audit table if there is none."""
        self._append(self.audit_table, spark.createDataFrame([], audit_ddl), "", -1)
        self.attempt.clear()

    def write(self, table: str, rows: DataFrame, job: str, batch_id: int) -> None:
        self._append(table, rows, job, batch_id)

    def commit(self, audit: DataFrame, job: str, batch_id: int) -> None:
        # One task: all audit rows go in over one connection, in one transaction.
        self._append(self.audit_table, audit.coalesce(1), job, batch_id)
        self.attempt.pop((job, batch_id), None)

    def committed(self, spark: SparkSession, job: str, batch_id: int, ddl: str) -> DataFrame:
        """Audit rows of one batch; none if it has not been committed."""
        audit = self.database.read(spark, self.audit_table)
        return audit.where((F.col(JOB) == job) & (F.col(BATCH) == batch_id)).drop(JOB, BATCH, ATTEMPT)

    def read(self, spark: SparkSession, table: str, ddl: str | None = None) -> DataFrame:
        """Rows of committed batches; the database knows the columns, not ``ddl``."""
        batch = [JOB, BATCH, ATTEMPT]
        done = self.database.read(spark, self.audit_table).select(*batch).distinct()
        return self.database.read(spark, table).join(done, batch, "left_semi")
