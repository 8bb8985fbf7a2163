"""Exact duplicates across immutable snapshots and new batches.

A snapshot holds a row for each distinct text, in buckets by digest, and a static
binary fuse filter for each bucket. A new batch is first grouped within itself; only its
distinct digests go to the filters of their buckets. What a filter lets through joins
the exact rows of the bucket. Every group of two or more is then compared byte by byte.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroflow.llm.common import each_copy, one_spaced, stored, text_of
from aeroflow.llm.fuse import FuseFilter

KEYS_PER_BUCKET = 1 << 18
_CHECK_SALTS = 16


def normalised(text_col: str) -> Column:
    return one_spaced(text_of(text_col))


def digest_key(digest: Column) -> Column:
    """The first eight bytes of a digest given in hexadecimal, as a signed number."""
    high = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    low = F.conv(F.substring(digest, 9, 8), 16, 10).cast("bigint")
    return F.shiftleft(high, 32).bitwiseOR(low)


def digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.sha2(normalised(text_col), 256).alias("digest"))


@dataclass
class Snapshot:
    """Distinct digests ``(digest, keep_id, n, bucket)`` and a filter for each bucket."""

    rows: DataFrame
    filters: DataFrame
    buckets: int

    @classmethod
    def of(cls, groups: DataFrame) -> Snapshot:
        """From ``groups (digest, keep_id, n)``. Digests are even, so buckets are."""
        groups = stored(groups, "groups")
        buckets = max(1, -(-groups.count() // KEYS_PER_BUCKET))
        bucketed = groups.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int"))
        rows = stored(bucketed, "snapshot")

        def build(part: pa.Table) -> pa.Table:
            made = FuseFilter.build(part.column("key").to_numpy().view(np.uint64))
            return pa.table({
                "bucket": part.column("bucket")[:1], "seed": [made.seed], "segment": [made.segment],
                "cells": pa.array([made.cells.tobytes()], pa.binary()),
            })

        keys = rows.select("bucket", digest_key(F.col("digest")).alias("key"))
        filters = keys.groupBy("bucket").applyInArrow(build, "bucket int, seed bigint, segment bigint, cells binary")
        return cls(rows, stored(filters, "filters"), buckets)

    def screened(self, groups: DataFrame) -> DataFrame:
        """``groups`` that the filters let through: all digests of the snapshot, and few others."""
        keyed = groups.select(
            "digest", digest_key(F.col("digest")).alias("key"),
            F.pmod(F.xxhash64("digest"), F.lit(self.buckets)).cast("int").alias("bucket"),
        )

        def screen(asked: pa.Table, held: pa.Table) -> pa.Table:
            if not asked.num_rows or not held.num_rows:
                return asked.select(["digest"]).slice(0, 0)
            cells = np.frombuffer(held.column("cells")[0].as_py(), np.uint16)
            one = FuseFilter(held.column("seed")[0].as_py(), held.column("segment")[0].as_py(), cells)
            found = one.contains(asked.column("key").to_numpy().view(np.uint64))
            return asked.select(["digest"]).filter(pa.array(found))

        together = keyed.groupBy("bucket").cogroup(self.filters.groupBy("bucket"))
        return together.applyInArrow(screen, "digest string")

    def matches(self, groups: DataFrame) -> DataFrame:
        """``digest, keep_id, n`` of the snapshot for the digests of ``groups`` that it holds."""
        positive = self.screened(groups)
        return self.rows.join(positive, "digest", "left_semi").select("digest", "keep_id", "n")

    def extended(self, groups: DataFrame) -> Snapshot:
        """The next snapshot: this one and a batch grouped within itself."""
        both = self.rows.select("digest", "keep_id", "n").unionByName(groups.select("digest", "keep_id", "n"))
        return Snapshot.of(both.groupBy("digest").agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("n")))


def grouped(rows: DataFrame) -> DataFrame:
    """Duplicates of a batch within itself; counts are combined before the shuffle."""
    return rows.groupBy("digest").agg(F.min("id").alias("keep_id"), F.count("*").alias("n"))


def checked(docs: DataFrame, text_col: str, repeated: DataFrame) -> DataFrame:
    """``digest`` for each repeated digest, after comparing its texts byte by byte.

    Repeated digests are stored as hashes of 8 bytes, so that their true size decides whether
    tasks look them up or texts are shuffled to them; a digest whose hash is that of a
    repeated one is counted too, which changes nothing. Texts are grouped by digest and by their bytes. A
    salt keeps a text with very many copies from being one task; copies in a task are combined
    before the shuffle. Two texts with one digest stop the job: they would need another digest.
    """
    texts = docs.select(F.sha2(normalised(text_col), 256).alias("digest"), normalised(text_col).alias("text"))
    wanted = stored(repeated.select(F.xxhash64("digest").alias("wanted")), "repeated")
    # Stored: what follows groups by digest too, and would otherwise keep the join's partitions as they are.
    texts = stored(texts.join(wanted, F.xxhash64("digest") == F.col("wanted"), "left_semi"), "repeated-texts")
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(_CHECK_SALTS))
    distinct = texts.withColumn("salt", salt).groupBy("digest", "text", "salt").agg(F.count("*").alias("n"))
    per_text = distinct.groupBy("digest", "text").agg(F.sum("n").alias("n"))
    clash = F.raise_error(F.concat(F.lit("two texts with digest "), F.col("digest")))
    per_digest = per_text.groupBy("digest").agg(F.count("*").alias("texts"), F.sum("n").alias("copies"))
    return per_digest.select("digest", F.when(F.col("texts") == 1, F.col("copies")).otherwise(clash.cast("bigint")).alias("copies"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, keep_id, group_size, kept, text_sha256`` for every row of ``docs``.

    Texts are equal if they are after each run of ASCII white space becomes one space;
    NULL counts as empty. Of equal texts the least id stays, NULL ids last; of several
    rows with that id one stays. Ids may have any type with an order. The rows come in two
    batches, by a bit of a hash of the id: the first becomes the snapshot that screens the second. An
    empty table gives an empty result. Other columns are not looked at.
    """
    rows = stored(digests(docs, id_col, text_col), "digests")
    late = F.xxhash64("id") < 0
    snapshot = Snapshot.of(grouped(rows.where(~late)))
    batch = stored(grouped(rows.where(late)), "batch")
    known = stored(snapshot.matches(batch), "known")
    merged = batch.unionByName(known).groupBy("digest").agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("n"))
    old = snapshot.rows.join(known, "digest", "left_anti").select("digest", "keep_id", "n")
    groups = stored(old.unionByName(merged), "groups")
    repeated = checked(docs, text_col, groups.where("n > 1")).withColumnRenamed("digest", "same")
    groups = groups.join(repeated, groups["digest"] == repeated["same"], "left").select(
        "digest", "keep_id", F.coalesce("copies", "n").alias("group_size")
    )
    # Both sides are stored, so that the join has shuffles of its own: large partitions can be split.
    groups = stored(groups, "classes")
    # Rows with equal id and text are alike but for one of them being kept.
    alike = stored(rows.groupBy("digest", "id").agg(F.count("*").alias("alike")), "alike")
    numbered = each_copy(stored(alike.join(groups, "digest"), "members"), "alike", "number")
    kept = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("number") == 0)
    return numbered.select(
        F.col("id").alias(id_col), "keep_id", "group_size", kept.alias("kept"), F.col("digest").alias("text_sha256")
    )
