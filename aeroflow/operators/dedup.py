"""De-duplication. The survivor is always the newest copy, never an arbitrary one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroflow import schemas

# Newest last. Offsets order records of one partition; the timestamp orders
# records of different partitions.
ARRIVAL_ORDER = ("timestamp", "partition", "offset")


def arrival_order() -> Column:
    return F.struct(*ARRIVAL_ORDER)


def latest_by(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row per key, NULL being one key value.

    An aggregate rather than a window: copies are merged map-side, so a key
    that holds a third of all rows reaches the shuffle as one row per task.
    """
    rest = [c for c in rows.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("newest")
    return rows.groupBy(*keys).agg(newest).select(
        *[F.col("newest")[c].alias(c) if c in rest else F.col(c) for c in rows.columns]
    )


def sender() -> Column:
    """What a later message must share to replace an airport's message: its key, or without one its id."""
    return F.coalesce("key", F.col("_id").cast("binary")).alias("sender")


def repeated_documents(parsed: DataFrame) -> DataFrame:
    """Documents sent more than once, with the position of the newest.

    Only messages that hold a document count: a malformed one replaces nothing, and one with
    another id under the same key is another airport.
    """
    return (
        parsed.where(F.col("_id").isNotNull())
        .groupBy("topic", "_id", sender())
        .agg(F.count("*").alias("copies"), F.max(arrival_order()).alias("newest"))
        .where("copies > 1")
        .select("topic", "_id", "sender", "newest")
    )


def current_documents(parsed: DataFrame, repeated: DataFrame) -> DataFrame:
    """Parsed messages without those that a newer one replaces.

    Give ``repeated`` as a stored table where the topic is large: its true size
    then decides the join. Few repeats are broadcast and no document is
    shuffled; many are joined by sort-merge, where AQE can split a hot key.
    """
    again = repeated.select(*[F.col(c).alias(f"repeated_{c}") for c in repeated.columns])
    superseded = (
        (F.col("topic") == F.col("repeated_topic"))
        & (F.col("_id") == F.col("repeated__id"))
        & (sender() == F.col("repeated_sender"))
        & (arrival_order() < F.col("repeated_newest"))
    )
    return parsed.join(again, superseded, "left_anti")


def dedup_batch(airports: DataFrame) -> DataFrame:
    """One row per ``_id``; needs the source columns next to the table columns."""
    return latest_by(airports, ["_id"], ARRIVAL_ORDER).drop(*schemas.SOURCE_COLUMNS)
