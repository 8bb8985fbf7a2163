"""Mixing sources to target weights by cuts in a random order.

Each row has a random key made from its own content. Within a source, rows are
ordered by key; equal ranges of keys are buckets of about equal size, so a large
source simply has more of them. Word counts are summed for each bucket, a running
sum over buckets finds the one bucket in which the source's budget ends, and only
that bucket's rows are sorted to find the exact cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeroflow.llm.common import columns, stored, text_of, word_count

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
ROWS_PER_BUCKET = 8192
KEY_BITS = 60


def random_key(doc_id: Column, text: Column) -> Column:
    """A number below 2^60 that depends on id and text only."""
    seed = F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), text)
    return F.conv(F.substring(F.md5(seed), 1, KEY_BITS // 4), 16, 10).cast("bigint")


def _ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank`` from 0 in the order of ``source``, NULL last, by a range sort."""
    ordered = sources.repartitionByRange(F.col("source").asc_nulls_last())
    ordered = stored(ordered.withColumn("part", F.spark_partition_id()), "sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task
    parts = ordered.groupBy("part").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    within = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(within) - 1 + F.col("before")
    return ordered.join(parts.select("part", "before"), "part").withColumn("rank", rank).drop("part", "before")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sources (source, n_docs, source_size)`` with the words each should give.

    Weights repeat over the sources in the order of their names. All words of all
    sources are shared out by weight; what a source cannot give in ``max_epochs``
    rounds is shared among the others, until no source is above its limit.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = stored(_ranked(sources).withColumn("weight", weight), "weights")
    limit = F.col("source_size") * max_epochs
    full = F.lit(False)
    n_full, rate = -1, 0.0
    while True:  # each round fills at least one more source, in practice very many
        open_ = ~full
        total, given, shares, filled = ranked.agg(
            F.sum("source_size"),
            F.sum(F.when(full, limit).otherwise(0)),
            F.sum(F.when(open_, F.col("weight")).otherwise(0)),
            F.count(F.when(full, 1)),
        ).first()
        if filled == n_full or not total:
            break
        if shares:
            rate = (total - given) / shares
        n_full = filled
        full = full | (F.lit(rate) * F.col("weight") > limit)
    target = F.when(full, limit.cast("double")).otherwise(F.lit(rate) * F.col("weight"))
    return ranked.withColumn("target", F.least(target, limit.cast("double")))


class Mix:
    """The cuts of each source, and what they mean for each row.

    ``key_rows`` has ``source, size, key`` for every row. Sources are matched with
    NULL as a source of its own.
    """

    def __init__(self, key_rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> None:
        sources = key_rows.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
        budget = F.floor(F.col("target") + 0.5)
        epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
        planned = targets(sources, weights, max_epochs).withColumn("epochs", epochs.cast("bigint"))
        planned = planned.withColumn("rest", (budget - F.col("epochs") * F.col("source_size")).cast("bigint"))
        planned = planned.withColumn("buckets", F.ceil(F.col("n_docs") / ROWS_PER_BUCKET))
        self.planned = stored(planned.select("source", "source_size", "target", "epochs", "rest", "buckets"), "targets")
        self.cuts = stored(self._cuts(key_rows), "cuts")

    def _cuts(self, key_rows: DataFrame) -> DataFrame:
        plan = self.planned.withColumnRenamed("source", "of")
        rows = key_rows.join(plan, key_rows["source"].eqNullSafe(plan["of"])).drop("of")
        bucket = F.floor(F.col("key") / float(1 << KEY_BITS) * F.col("buckets")).cast("bigint")
        rows = rows.withColumn("bucket", bucket)
        sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
        order = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        upto = F.sum("words").over(order)
        sums = sums.withColumn("start", upto - F.col("words")).where(
            "start <= rest and rest < start + words"
        ).select(F.col("source").alias("of"), F.col("bucket").alias("at"), "start")
        inside = rows.join(sums, rows["source"].eqNullSafe(sums["of"]) & (rows["bucket"] == sums["at"]))
        # Rows of one key are copies of each other: they are cut together.
        ties = inside.groupBy("source", "bucket", "key").agg(
            F.sum("size").alias("words"), F.first("start").alias("start"), F.first("rest").alias("rest")
        )
        by_key = Window.partitionBy("source", "bucket").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
        ties = ties.withColumn("before", F.col("start") + F.sum("words").over(by_key) - F.col("words"))
        cut = ties.where("before <= rest and rest < before + words").select(
            F.col("source").alias("of"), F.col("key").alias("cut_key"),
            (F.col("rest") - F.col("before")).alias("cut_words"), F.col("words").alias("cut_size"),
        )
        plan = self.planned
        return plan.join(cut, plan["source"].eqNullSafe(cut["of"]), "left").select(
            F.col("source").alias("_source"), "source_size", "target", "epochs", "cut_key", "cut_words", "cut_size"
        )

    def apply(self, rows: DataFrame, source: str, key: str, size: str) -> DataFrame:
        """``rows`` with ``source_size, target, epochs`` and ``extra``: words of one more, partial round."""
        joined = rows.join(self.cuts, F.col(source).eqNullSafe(F.col("_source")))
        part = F.floor(F.col(size) * F.col("cut_words") / F.col("cut_size")).cast("bigint")
        extra = (
            F.when(F.col("cut_key").isNull(), F.lit(0))
            .when(F.col(key) < F.col("cut_key"), F.col(size))
            .when(F.col(key) == F.col("cut_key"), part)
            .otherwise(0)
        )
        return joined.withColumn("extra", extra.cast("bigint")).drop("_source", "cut_key", "cut_words", "cut_size")


def _key_rows(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    text = text_of(text_col)
    return docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
        word_count(text).alias("size"), random_key(F.col(id_col), text).alias("key"),
    )


def mix_plan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """What the mix takes of each row: ``id_col, source, size, source_size, target, epochs, taken``.

    ``size`` is the number of words, 0 for NULL and blank texts, of which the mix takes
    nothing. ``taken`` counts words, repeats included: ``epochs`` whole rounds, and
    one more up to the cut. The one row at the cut gives part of its words; equal rows at
    the cut share that part. NULL is a source like any other and comes last. An empty
    table gives an empty result. Other columns are not looked at. The order is a hash of
    id and text, so reruns agree.
    """
    rows = stored(_key_rows(docs, id_col, text_col, source_col), "mixkeys")
    placed = Mix(rows, weights, max_epochs).apply(rows, "source", "key", "size")
    return placed.select(
        F.col("id").alias(id_col), "source", "size", "source_size", "target", "epochs",
        (F.col("epochs") * F.col("size") + F.col("extra")).alias("taken"),
    )


def first_words(text: Column, n: Column) -> Column:
    """``text`` up to the end of its n-th word, spaces as they are."""
    parts = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")  # each ends with a word
    return F.array_join(F.slice(parts, 1, n.cast("int")), "")


def mixed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """The mixed corpus: rows of ``docs`` repeated, left out, or cut as in ``mix_plan``.

    All columns keep their values, but for the text of a row at the cut, which ends after
    its last word taken. Rows without words are in none of the rounds and are left out.
    """
    rows = stored(_key_rows(docs, id_col, text_col, source_col), "mixkeys")
    mix = Mix(rows, weights, max_epochs)
    text = text_of(text_col)
    packed = docs.select(
        F.struct(*columns(docs)).alias("_row"), random_key(F.col(id_col), text).alias("_key"),
        word_count(text).alias("_words"), F.col(source_col).cast("string").alias("_of"),
    )
    placed = mix.apply(packed, "_of", "_key", "_words")
    whole = F.array_repeat(F.col("_words"), F.col("epochs").cast("int"))
    copies = F.when(F.col("extra") > 0, F.concat(whole, F.array("extra"))).otherwise(whole)
    copies = F.when(F.col("_words") > 0, copies).otherwise(F.array().cast("array<bigint>"))
    body = placed.select("_row", "_words", F.explode(copies).alias("_taken"))
    whole_text = F.col("_row").getField(text_col)
    shortened = F.when(F.col("_taken") < F.col("_words"), first_words(whole_text, F.col("_taken"))).otherwise(whole_text)
    return body.select(*(
        (shortened if name == text_col else F.col("_row").getField(name)).alias(name) for name in docs.columns
    ))
