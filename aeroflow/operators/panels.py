"""What the dashboards do to a query result before they draw it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ranked(rows: DataFrame, value: str, tie_break: str) -> DataFrame:
    """Largest first with NULLs in front; ties go by key, so results repeat."""
    return rows.orderBy(F.desc_nulls_first(value), F.asc_nulls_last(tie_break))


def top(rows: DataFrame, value: str, tie_break: str, n: int) -> DataFrame:
    return ranked(rows, value, tie_break).limit(n)


def last_not_null(series: DataFrame, values: Sequence[str], time: str) -> DataFrame:
    """Reduces a series to the newest value of each column that is not NULL."""
    return series.agg(
        *[
            F.max_by(v, F.when(F.col(v).isNotNull(), F.col(time))).alias(v)
            for v in values
        ]
    )


def share(counts: DataFrame, value: str) -> DataFrame:
    """Adds ``share``, the part of the total, which is a scalar subquery."""
    total = counts.agg(F.sum(value)).scalar()
    return counts.withColumn("share", F.col(value).cast("double") / total)


def value_range(rows: DataFrame, value: str) -> tuple[Column, Column]:
    """Smallest and largest value, as scalar subqueries over one aggregation."""
    number = F.col(value).cast("double")
    bounds = rows.agg(F.struct(F.min(number).alias("low"), F.max(number).alias("high"))).scalar()
    return bounds["low"], bounds["high"]
