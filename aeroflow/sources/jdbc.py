"""Relational sources. The driver jar and all credentials come from the caller."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Split:
    """Ranges of a numeric, date or timestamp column; rows outside the bounds go to the outer ranges."""

    column: str
    lower: str
    upper: str
    parts: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column, "lowerBound": self.lower,
            "upperBound": self.upper, "numPartitions": str(self.parts),
        }


@dataclass(frozen=True)
class Database:
    """Where it is, how to log in, and how many tasks may write to it at once."""

    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    max_writers: int = 32

    def options(self, table: str) -> dict[str, str]:
        # `unspecified` lets a PostgreSQL server coerce text to richer column types.
        defaults = {"stringtype": "unspecified"} if ":postgresql:" in self.url else {}
        return {"url": self.url, "dbtable": table, **defaults, **self.properties}

    def read(self, spark: SparkSession, table: str, split: Split | None = None) -> DataFrame:
        """A table, over one connection or split into ranges of a column that are read side by side."""
        options = self.options(table) | (split.options() if split else {})
        return spark.read.format("jdbc").options(**options).load()

    def append(self, rows: DataFrame, table: str) -> None:
        options = self.options(table) | {"numPartitions": str(self.max_writers)}
        rows.write.format("jdbc").options(**options).mode("append").save()

    def probe(
        self, spark: SparkSession, table: str = "information_schema.tables", n: int = 5
    ) -> DataFrame:
        """Shows some rows of a system table, so that a bad connection fails now."""
        rows = self.read(spark, table).limit(n)
        rows.show(n)
        return rows
