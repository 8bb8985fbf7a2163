"""A training corpus from ``documents``: five stages, each over all that the last one kept.

Toxic documents go, one document of each group of near-duplicates stays, documents that
leak benchmark items go, sources are mixed to their weights (rows repeat, and the row at a
source's cut is shortened), and the last stage adds each row's shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aeroflow.llm import decontaminate, mixing, sharding, simhash, toxicity
from aeroflow.llm.common import stored, table
from aeroflow.llm.queries import MAX_BITS, SHINGLE
from aeroflow.session import prepare


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, table(prepare(spark), sf_dir, "labels"))
    return toxicity.accepted(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return simhash.keep_one(docs, shingle=SHINGLE, max_bits=MAX_BITS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(prepare(spark), sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.mixed(docs)


def add_shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return sharding.with_shard(docs, sharding.shard_map(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("sharding", add_shard),
]

# SQL has no model to learn and no fingerprints to link: tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
