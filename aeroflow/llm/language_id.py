"""Language identification of web pages by combining several kinds of evidence.

The text of a page gives a likelihood for each language. The language that the markup declares,
the suffix of the address and the host are no proof, but they are evidence whose
worth can be counted: from the text alone every page gets soft shares of the languages,
and grouped sums of these say how often each declaration, suffix and host goes with
each language. A host's prior is drawn towards its suffix's, that one towards the corpus's,
the more the fewer pages there are; a page never counts for itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroflow.llm.common import stored, text_of

# Bound of the training sample of labelled texts.
TRAINING_ROWS = 20_000
BINS = 1 << 14
GRAM = 3
SMOOTHING = 0.5
# A text counts as at most this many independent runs of letters.
EFFECTIVE = 60.0
HOST_STRENGTH = 5.0
SUFFIX_STRENGTH = 20.0
DECLARED_STRENGTH = 2.0

_HIDDEN = re.compile(r"<(script|style|nav|head)\b.*?</\1\s*>|<!--.*?-->", re.DOTALL | re.IGNORECASE)
_TAG = re.compile(r"<[^>]*>")
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_DECLARED = re.compile(r"<html\b[^>]*\blang\s*=\s*[\"']?([A-Za-z]+)", re.IGNORECASE)
_HOST = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)")


def visible_text(html: str) -> str:
    return _TAG.sub(" ", _HIDDEN.sub(" ", html))


def declared_language(html: str) -> str | None:
    found = _DECLARED.search(html)
    return found[1].lower() if found else None


def host_of(url: str) -> str | None:
    found = _HOST.match(url)
    return found[1].lower().rstrip(".") or None if found else None


def suffix_of(host: str | None) -> str | None:
    return host.rpartition(".")[2] if host else None


def gram_bins(text: str) -> np.ndarray:
    """A number for each run of three characters of the text's letters, words apart."""
    letters = f" {_NOT_LETTERS.sub(' ', text.lower()).strip()} "
    codes = np.frombuffer(letters.encode("utf-32-le", errors="replace"), np.uint32).astype(np.uint64)
    if len(codes) < GRAM + 2:
        return np.empty(0, np.int64)
    h = np.zeros(len(codes) - GRAM + 1, np.uint64)
    for i in range(GRAM):
        h = (h ^ codes[i : i + len(h)]) * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(64 - 14)).astype(np.int64)


@dataclass
class TextModel:
    """Log-likelihood of each bin for each language, in the order of ``languages``."""

    languages: list[str]
    logs: np.ndarray

    def likelihoods(self, text: str) -> np.ndarray:
        bins = gram_bins(text)
        if not len(bins):
            return np.zeros(len(self.languages))
        sums = self.logs[:, bins].mean(axis=1) * min(len(bins), EFFECTIVE)
        return sums - sums.max()


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most: int = TRAINING_ROWS) -> TextModel:
    """From at most ``most`` rows with id, text and language: those whose ids come first by hash."""
    labelled = docs.where(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    single = labelled.groupBy(F.col(id_col).alias("_key")).agg(F.min(lang_col).alias("_lang"))
    chosen = stored(single.orderBy(F.xxhash64("_key"), "_key").limit(most), "labelled")
    texts = docs.select(F.col(id_col).alias("_key"), text_of(text_col).alias("_text"))
    # At most ``most`` rows of an id and a language.
    sample = texts.join(F.broadcast(chosen), "_key").select("_lang", "_text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = sums.setdefault(lang, np.zeros(BINS, np.int64))
                own += np.bincount(gram_bins(text), minlength=BINS)
        for lang, own in sums.items():
            bins = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(bins), pa.string()), pa.array(bins), pa.array(own[bins])], ["lang", "bin", "n"])

    counted = sample.mapInArrow(count, "lang string, bin bigint, n bigint")
    # A number for each language and each of a fixed number of bins.
    rows = counted.groupBy("lang", "bin").agg(F.sum("n").alias("n")).collect()
    languages = sorted({r["lang"] for r in rows})
    counts = np.full((len(languages), BINS), SMOOTHING)
    for r in rows:
        counts[languages.index(r["lang"]), r["bin"]] += r["n"]
    return TextModel(languages, np.log(counts / counts.sum(axis=1, keepdims=True)))


def _evidence(pages: DataFrame, model: TextModel, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """``id, host, suffix, declared, logs``: what each page says, and its text's log-likelihoods."""
    rows = pages.select(F.col(id_col).alias("id"), text_of(url_col).alias("url"), text_of(html_col).alias("html"))
    held = pages.sparkSession.sparkContext.broadcast(model)
    kind = dict(rows.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts = [host_of(u) for u in batch.column(1).to_pylist()]
            html = batch.column(2).to_pylist()
            logs = [held.value.likelihoods(visible_text(h)).tolist() for h in html]
            columns = [
                batch.column(0), pa.array(hosts, pa.string()), pa.array([suffix_of(h) for h in hosts], pa.string()),
                pa.array([declared_language(h) for h in html], pa.string()), pa.array(logs, pa.list_(pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "host", "suffix", "declared", "logs"])

    return rows.mapInArrow(run, f"id {kind}, host string, suffix string, declared string, logs array<double>")


def _each(n: int, value) -> Column:
    return F.array(*[value(i) for i in range(n)])


def _shares(logs: Column, n: int) -> Column:
    """Logarithms made into shares that sum to 1."""
    powers = F.transform(logs, lambda x: F.exp(x))
    total = F.aggregate(powers, F.lit(0.0), lambda a, x: a + x)
    return F.transform(powers, lambda x: x / total)


def languages_of(
    pages: DataFrame, model: TextModel, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """``id_col, host, suffix, declared, text_language, language, confidence`` for every page.

    ``text_language`` goes by the text alone, ``language`` by all evidence. A page without a declaration,
    or with an address that names no host, has NULL there, which counts like any other
    value; NULL and blank texts leave the decision to the rest. Of equal languages the first by
    name is taken. Repeated rows stay repeated. Without any language in the model,
    languages are NULL. An empty table gives an empty result. Other columns are not looked at.
    """
    n = len(model.languages)
    rows = stored(_evidence(pages, model, id_col, url_col, html_col), "evidence")
    if not n:
        none = F.lit(None)
        return rows.select(
            F.col("id").alias(id_col), "host", "suffix", "declared", none.cast("string").alias("text_language"),
            none.cast("string").alias("language"), none.cast("double").alias("confidence"),
        )
    rows = rows.withColumn("soft", _shares(F.col("logs"), n))

    def summed(*keys: str) -> DataFrame:
        """Soft pages of each language, summed before the shuffle, so a large host is one row for each task."""
        sums = _each(n, lambda i: F.sum(F.col("soft")[i]))
        return rows.groupBy(*keys).agg(sums.alias("sums"))

    def total(sums: Column) -> Column:
        return F.aggregate(sums, F.lit(0.0), lambda a, x: a + x)

    def drawn(sums: Column, towards: Column, strength: float) -> Column:
        return F.zip_with(sums, towards, lambda x, p: (x + strength * p) / (total(sums) + strength))

    # One row of one number for each language.
    overall = summed().select(_each(n, lambda i: (F.col("sums")[i] + 1) / (total(F.col("sums")) + n)).alias("overall"))
    suffixes = summed("suffix").crossJoin(F.broadcast(overall)).select(
        F.col("suffix").alias("of_suffix"), drawn(F.col("sums"), F.col("overall"), SUFFIX_STRENGTH).alias("suffix_prior")
    )
    hosts = summed("host", "suffix").select(F.col("host").alias("of_host"), F.col("suffix").alias("host_suffix"), F.col("sums").alias("host_sums"))
    hosts = hosts.join(suffixes, hosts["host_suffix"].eqNullSafe(suffixes["of_suffix"]))
    declared = summed("declared").crossJoin(F.broadcast(overall)).crossJoin(F.broadcast(summed().select(F.col("sums").alias("all_sums"))))
    share = total(F.col("sums")) / total(F.col("all_sums"))
    declared = declared.select(
        F.col("declared").alias("of_declared"),
        F.zip_with("sums", "all_sums", lambda x, a: F.log((x + DECLARED_STRENGTH * share) / (a + DECLARED_STRENGTH))).alias("declared_logs"),
    )
    joined = rows.join(hosts, rows["host"].eqNullSafe(hosts["of_host"])).join(declared, rows["declared"].eqNullSafe(declared["of_declared"]))
    others = F.zip_with("host_sums", "soft", lambda x, own: F.greatest(x - own, F.lit(0.0)))
    prior = F.transform(drawn(others, F.col("suffix_prior"), HOST_STRENGTH), lambda x: F.log(x))
    logs = F.zip_with(F.zip_with("logs", "declared_logs", lambda a, b: a + b), prior, lambda a, b: a + b)
    top = F.array_max("logs")
    joined = joined.withColumn("all_logs", logs)
    best = F.array_max("all_logs")
    shares = _shares(F.transform("all_logs", lambda x: x - best), n)
    names = F.array(*map(F.lit, model.languages))
    return joined.select(
        F.col("id").alias(id_col), "host", "suffix", "declared",
        F.element_at(names, F.array_position("logs", top).cast("int")).alias("text_language"),
        F.element_at(names, F.array_position("all_logs", best).cast("int")).alias("language"),
        F.array_max(shares).alias("confidence"),
    )
