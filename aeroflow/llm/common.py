"""What the corpus operators share: text columns, stored intermediates, row order."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroflow.session import fresh_dir

# ASCII white space, as the contracts of the queries define it.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written once to the shared folder and read from there.

    Cuts the lineage: a lost executor never repeats the work that led here, and
    rows that depend on how tasks were dealt out keep one meaning.
    """
    path = fresh_dir(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str) -> Column:
    """A text column with NULL as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def one_spaced(text: Column) -> Column:
    return F.regexp_replace(text, SPACES, " ")


def word_count(text: Column) -> Column:
    """Number of maximal runs of non-space characters."""
    words = F.trim(one_spaced(text))
    return F.when(words == "", F.lit(0).cast("bigint")).otherwise(
        (F.length(words) - F.length(F.replace(words, F.lit(" "), F.lit(""))) + 1).cast("bigint")
    )


def size_in_bytes(text: Column) -> Column:
    return F.octet_length(text).cast("bigint")


def columns(df: DataFrame) -> list[Column]:
    """All columns of a table, whatever characters their names have."""
    return [F.col(f"`{name}`") for name in df.columns]


def unused_name(wanted: str, taken: Iterable[str]) -> str:
    """``wanted``, with underscores in front until no column has that name."""
    lower = {name.lower() for name in taken}
    while wanted.lower() in lower:
        wanted = f"_{wanted}"
    return wanted


# Copies that are numbered by one row at a time.
COPIES_PER_BLOCK = 1 << 16


def each_copy(counted: DataFrame, n: str, number: str) -> DataFrame:
    """Each row of ``counted`` as often as its column ``n`` says, numbered from 0 in ``number`` in its place.

    Rows that occur very often are dealt out in blocks first, so that no task
    numbers all copies of one.
    """
    rest = [F.col(f"`{c}`") for c in counted.columns if c != n]
    few = counted.where(F.col(n) <= COPIES_PER_BLOCK).select(
        *rest, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)).alias(number)
    )
    block, last = "_block", F.floor((F.col(n) - 1) / COPIES_PER_BLOCK)
    blocks = counted.where(F.col(n) > COPIES_PER_BLOCK).select(
        *rest, F.col(n).alias("_n"), F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias(block)
    )
    low = F.col(block) * COPIES_PER_BLOCK
    high = F.least(low + COPIES_PER_BLOCK, F.col("_n")) - 1
    many = blocks.repartition(F.col(block)).select(*rest, F.explode(F.sequence(low, high)).alias(number))
    return few.unionByName(many)


def batches_of(rows: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.Table]:
    """Arrow batches joined to tables of ``least`` rows or more, so that vector work pays."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in rows:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= least:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)
