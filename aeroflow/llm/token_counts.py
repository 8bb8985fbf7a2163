"""Exact length histograms: how many documents have how many tokens.

Documents are encoded once; only their lengths are kept, and counted by length. From the
histogram, running sums answer exactly how many tokens the corpus has, which length a share
of the documents stays below, and how many tokens are left if every document
is cut at a context limit - for every limit at once.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aeroflow.llm.common import stored, text_of

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that belongs to the vocabulary above.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# One piece, whatever the text.
WHOLE = r"(?s).+"
# The pattern's engine follows white space step by step and runs out of stack on very long runs.
LONG_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{10000,}")
LENGTHS_PER_BLOCK = 4096


@functools.lru_cache(maxsize=2)
def encoding(vocabulary: bytes, pattern: str) -> tiktoken.Encoding:
    """From the lines of a rank file: a token in base 64 and its rank."""
    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines()) if token}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_count(text: str, words: tiktoken.Encoding, whole: tiktoken.Encoding) -> int:
    """Number of tokens of a text of any shape.

    Long runs of white space are cut out as the pattern cuts them: all but the last character before
    something else is one piece. ``words`` has the pattern, ``whole`` the pattern ``WHOLE``.
    """
    n, at = 0, 0
    for run in LONG_SPACE.finditer(text):
        stop = run.end() - (run.end() < len(text))
        n += len(words.encode_ordinary(text[at : run.start()])) + len(whole.encode_ordinary(text[run.start() : stop]))
        at = stop
    return n + len(words.encode_ordinary(text[at:]))


def token_lengths(docs: DataFrame, keys: list[str], text_col: str = "text", vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """``keys`` and ``n_tokens`` for every row; the vocabulary is read here and sent to the tasks.

    A ``pattern`` must take runs of white space as the given one does (``token_count``).
    """
    with open(vocabulary, "rb") as lines:
        held = docs.sparkSession.sparkContext.broadcast(lines.read())  # one file, whatever the corpus
    rows = docs.select(*(F.col(f"`{k}`") for k in keys), text_of(text_col).alias("_text"))
    fields = ", ".join(f"`{k}` {kind}" for k, kind in rows.dtypes[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, whole = encoding(held.value, pattern), encoding(held.value, WHOLE)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            lengths = np.fromiter((token_count(t.as_py(), words, whole) for t in texts), np.int64, len(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(lengths)], [*batch.schema.names[:-1], "n_tokens"])

    return rows.mapInArrow(run, f"{fields}{', ' if fields else ''}n_tokens bigint")


def histogram(docs: DataFrame, by: list[str] | None = None, text_col: str = "text", vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """``by, n_tokens, n_docs``, counted before the shuffle.

    NULL and empty texts have no tokens. Repeated rows count each time. NULL is a group of its
    own in ``by``. An empty table gives an empty result. Other columns are not looked at.
    """
    keys = list(by or ())
    lengths = token_lengths(docs, keys, text_col, vocabulary, pattern)
    return lengths.groupBy(*(f"`{k}`" for k in keys), "n_tokens").agg(F.count("*").alias("n_docs"))


def with_running_sums(counts: DataFrame) -> DataFrame:
    """The histogram over all groups with, for each length that occurs taken as a limit:

    ``docs_at_least`` and ``tokens_at_least``: documents of that length or more, and their tokens;
    ``truncated_total``: tokens left if every document is cut there; ``share_at_most``: share of
    the documents that stay whole. Sums run over blocks of lengths first, so no task has all
    lengths.
    """
    per_length = counts.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))
    rows = stored(per_length.withColumn("block", F.floor(F.col("n_tokens") / LENGTHS_PER_BLOCK)), "lengths")
    tokens = F.col("n_tokens") * F.col("n_docs")
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum(tokens).alias("t"))
    later = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)  # a row for each block
    after = blocks.select(
        "block", F.coalesce(F.sum("d").over(later), F.lit(0)).alias("docs_after"), F.coalesce(F.sum("t").over(later), F.lit(0)).alias("tokens_after")
    )
    longer = Window.partitionBy("block").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.join(after, "block").select(
        "n_tokens", "n_docs",
        (F.sum("n_docs").over(longer) + F.col("docs_after")).alias("docs_at_least"),
        (F.sum(tokens).over(longer) + F.col("tokens_after")).alias("tokens_at_least"),
    )
    total = rows.agg(F.sum("n_docs").alias("all_docs"), F.sum(tokens).alias("all_tokens"))
    cut = F.col("all_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")
    at_most = (F.col("all_docs") - F.col("docs_at_least") + F.col("n_docs")) / F.col("all_docs")
    # One row of totals.
    return summed.crossJoin(F.broadcast(total)).select(
        "n_tokens", "n_docs", "docs_at_least", "tokens_at_least", cut.alias("truncated_total"), at_most.alias("share_at_most")
    )


def truncated_totals(counts: DataFrame, limits: list[int]) -> dict[int, int]:
    """Tokens left for each of some context limits, whether documents of that length occur or not."""
    if not limits:
        return {}
    sums = [F.sum(F.least("n_tokens", F.lit(limit)) * F.col("n_docs")).alias(str(limit)) for limit in limits]
    row = counts.agg(*sums).first()
    return {limit: row[i] or 0 for i, limit in enumerate(limits)}


def quantile(counts: DataFrame, share: float) -> int | None:
    """Least length that at least ``share`` of the documents do not exceed; None without documents."""
    return with_running_sums(counts).where(F.col("share_at_most") >= share).agg(F.min("n_tokens")).first()[0]
