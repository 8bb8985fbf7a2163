"""Toxic passages as maximum-scoring segments of word log-odds.

Words and their beginnings are counted in toxic and other labelled texts. A word's score is
its log-odds between the two, drawn towards zero by a Dirichlet prior; only reliable
scores are kept, every other word costs a little. All maximal segments of a text are found
in one pass. By the statistics of extreme values, a text of n words reaches a
segment of score S by chance with expectation K n exp(-lambda S); the evidence of the best
segment and of all significant ones is turned into a probability by a logistic curve.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroflow.llm.common import stored, text_of, unused_name
from aeroflow.llm.simhash import shingle_hashes

# Bounds of the classifier's training sample, and of what is kept of it.
TRAINING_ROWS = 40_000
LEAST_TEXTS = 3
LEAST_Z = 4.0
LEAST_SCORE = 1.5

HEAD = 4  # letters of the shortest beginning of a word that is counted
BEGINNINGS = (4, 5, 6, 7)
PRIOR_WORDS = 5_000.0
COST = 0.03  # of each word without a score
THRESHOLD = 0.3
SIGNIFICANT = 0.1  # expected number of chance segments below which one is reported

_WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def features_of(word: str) -> list[str]:
    """The word itself and, marked by a star, its beginnings."""
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)]


def maximal_segments(steps: list[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments of a sequence of ``(start, end, score)`` steps.

    Linear time: each segment is kept with the running totals before and after it, and
    merged back into the last one with a lower total before, if that one's total after
    is lower as well.
    """
    total = 0.0
    held: list[tuple[int, int, float, float]] = []
    for start, end, score in steps:
        if score <= 0:
            total += score
            continue
        left, right = total, total + score
        total = right
        first = start
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= left:
                j -= 1
            if j < 0 or held[j][3] >= right:
                held.append((first, end, left, right))
                break
            first, left = held[j][0], held[j][2]
            del held[j:]
    return [(a, b, after - before) for a, b, before, after in held]


@dataclass
class Model:
    scores: dict[str, float] = field(default_factory=dict)
    rate: float = 1.0  # lambda of the extreme-value law
    factor: float = 1.0  # its K
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)
    base: float = 0.0
    heads: frozenset[str] = frozenset()

    def __post_init__(self) -> None:
        self.heads = frozenset(f.rstrip("*")[:HEAD] for f in self.scores)

    def score_of(self, word: str) -> float | None:
        found = [s for f in features_of(word) if (s := self.scores.get(f)) is not None]
        return max(found) if found else None

    def passages(self, words: list[str]) -> list[tuple[int, int, float]]:
        """Maximal segments as ``(first word, word after the last, score)``."""
        heads, steps, at = self.heads, [], 0
        for i in [i for i, w in enumerate(words) if w[:HEAD] in heads]:
            if (score := self.score_of(words[i])) is not None:
                steps += [(at, i, -COST * (i - at)), (i, i + 1, score)]
                at = i + 1
        return maximal_segments(steps)

    def chance(self, n: int, score: float) -> float:
        """Expected number of segments of that score in n words."""
        return self.factor * max(n, 1) * math.exp(-self.rate * score)

    def evidence(self, words: list[str]) -> tuple[float, float]:
        """Of the best segment, and of all significant ones together; 0 if there is none."""
        gains = [-math.log(max(self.chance(len(words), s), 1e-300)) for _, _, s in self.passages(words)]
        return max([0.0, *gains]), math.log1p(sum(g for g in gains if g > 0))

    def probability(self, words: list[str]) -> float:
        best, total = self.evidence(words)
        if not self.scores:
            return self.base
        a, b, c = self.curve
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, a + b * best + c * total))))


def extreme_value_rate(probabilities: np.ndarray, scores: np.ndarray) -> float:
    """The positive solution of sum(p * exp(rate * s)) = 1, for scores of negative mean."""
    low, high = 0.0, 1.0
    value = lambda r: float(probabilities @ np.exp(r * scores)) - 1
    while value(high) < 0 and high < 64:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if value(mid) < 0 else (low, mid)
    return max(high, 1e-3)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic curve by Newton steps; the first column of x is 1."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -60, 60)))
        slope = x.T @ (y - p) - ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_labels(labels: DataFrame, id_col: str, label_col: str, most: int) -> DataFrame:
    """At most ``most`` labelled ids outside the held-out part, the first by hash."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
    single = known.groupBy(F.col(id_col).alias("_key")).agg(F.max(F.col(label_col).cast("int")).alias("_label"))
    return single.orderBy(F.xxhash64("_key"), "_key").limit(most)


def _sketch(texts: pd.Series) -> pd.Series:
    """The least hash of a run of words: the same for most near copies, for few other texts."""
    least = [shingle_hashes(t.encode(errors="replace"), 4).min(initial=np.iinfo(np.uint64).max) for t in texts]
    return pd.Series(np.array(least, np.uint64).view(np.int64))


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    most: int = TRAINING_ROWS,
) -> Model:
    """A model from labelled rows of ``docs``, at most ``most`` of them, none held out.

    Rows without id, text or label teach nothing. Without any toxic text the model finds
    nothing and gives every text the share of toxic labels (0 if there are no labels).
    """
    chosen = stored(training_labels(labels, id_col, label_col, most), "labels")
    texts = docs.select(F.col(id_col).alias("_key"), text_of(text_col).alias("_text"))
    # At most ``most`` rows of two numbers.
    sample = texts.join(F.broadcast(chosen), "_key")
    # Copies and near copies of a text would look like evidence from many texts: the first one stays.
    sample = sample.withColumn("_sketch", F.pandas_udf(_sketch, "bigint")("_text"))
    first = F.min_by("_text", F.struct("_key", F.xxhash64("_text")))
    sample = sample.groupBy("_sketch", "_label").agg(first.alias("_text"))
    sample = stored(sample.select("_text", "_label"), "sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen = [Counter(), Counter()], [Counter(), Counter()]
        total = [0, 0]
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                y = int(label > 0)
                own = Counter(words_of(text))
                total[y] += own.total()
                for word, n in own.items():
                    for f in features_of(word):
                        words[y][f] += n
                        seen[y][f] += 1
        names = list(words[0].keys() | words[1].keys())
        columns = [[c[f] for f in names] for c in (*words, *seen)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(["", *names]), *(pa.array([t, *c], pa.int64()) for t, c in zip([*total, 0, 0], columns, strict=True))],
            ["feature", "t0", "t1", "d0", "d1"],
        )

    counted = sample.mapInArrow(count, "feature string, t0 bigint, t1 bigint, d0 bigint, d1 bigint")
    sums = stored(counted.groupBy("feature").agg(*(F.sum(c).alias(c) for c in ("t0", "t1", "d0", "d1"))), "counts")
    n, positive = sample.agg(F.count("*"), F.sum((F.col("_label") > 0).cast("int"))).first()
    base = (positive or 0) / n if n else 0.0
    if not positive or positive == n:
        return Model(base=base)
    t0, t1 = sums.where("feature = ''").agg(F.sum("t0"), F.sum("t1")).first()
    prior = F.lit(PRIOR_WORDS) * (F.col("t0") + F.col("t1")) / float(t0 + t1)
    a, b = F.col("t1") + prior, F.col("t0") + prior
    odds = F.log(a / (float(t1) + PRIOR_WORDS)) - F.log(b / (float(t0) + PRIOR_WORDS))
    scored = sums.where(f"feature <> '' and d1 >= {LEAST_TEXTS}").withColumn("score", odds)
    # Evidence is counted in texts, as a word often comes back within one.
    share1, share0 = F.col("d1") / float(positive), (F.col("d0") + 0.5) / float(n - positive + 1)
    pooled = (F.col("d1") + F.col("d0") + 0.5) / float(n + 1)
    z = (share1 - share0) / F.sqrt(pooled * (1 - pooled) * (1 / float(positive) + 1 / float(n - positive)))
    kept = scored.withColumn("z", z).where(F.col("z") >= LEAST_Z).where(F.col("score") >= LEAST_SCORE).orderBy("feature").collect()
    if not kept:
        return Model(base=base)
    model = Model({r["feature"]: r["score"] for r in kept}, base=base)
    p = np.array([(r["t0"] + 0.5) / (t0 + 1) for r in kept if not r["feature"].endswith("*")] or [0.5 / (t0 + 1)])
    s = np.array([r["score"] for r in kept if not r["feature"].endswith("*")] or [max(model.scores.values())])
    rest = max(1 - p.sum(), 0.5)
    model.rate = extreme_value_rate(np.append(p, rest), np.append(s, -COST))
    points = sample.sparkSession.sparkContext.broadcast(model)

    def features(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = [points.value.evidence(words_of(t)) for t in part["_text"]]
            yield pd.DataFrame({"best": [x for x, _ in found], "total": [x for _, x in found], "label": part["_label"] > 0})

    # Three numbers for each of the bounded number of sample rows.
    fitted = sample.mapInPandas(features, "best double, total double, label boolean").toPandas()
    fitted = fitted.sort_values(["best", "total", "label"])  # sums in one order: reruns agree to the last digit
    x = np.column_stack([np.ones(len(fitted)), fitted["best"], fitted["total"]])
    model.curve = tuple(float(v) for v in logistic(x, fitted["label"].to_numpy(float)))
    return model


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score, n_passages`` for every row of ``docs``.

    ``score`` is the probability of a toxic label, from the text alone; NULL and blank texts have that
    of a text without any passage. Repeated rows stay repeated, NULL ids stay. An empty table
    gives an empty result. Other columns are not looked at.
    """
    rows = docs.select(F.col(id_col), text_of(text_col).alias("_text"))
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = held.value
        for batch in batches:
            score, passages = [], []
            for text in batch.column(1):
                words = words_of(text.as_py())
                score.append(one.probability(words))
                passages.append(sum(one.chance(len(words), s) <= SIGNIFICANT for _, _, s in one.passages(words)))
            columns = [batch.column(0), pa.array(score, pa.float64()), pa.array(passages, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "score", "n_passages"])

    kind = dict(docs.dtypes)[id_col]
    return rows.mapInArrow(run, f"`{id_col}` {kind}, score double, n_passages int")


def passages(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Significant passages: ``id_col, start, stop, score, expected, passage``; start and stop count words."""
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for key, text in zip(part["id"], part["text"], strict=True):
                words = words_of(text)
                for a, b, s in held.value.passages(words):
                    if (expected := held.value.chance(len(words), s)) <= SIGNIFICANT:
                        out.append((key, a, b, s, expected, " ".join(words[a:b])))
            yield pd.DataFrame(out, columns=[id_col, "start", "stop", "score", "expected", "passage"])

    kind = dict(docs.dtypes)[id_col]
    return rows.mapInPandas(run, f"`{id_col}` {kind}, start int, stop int, score double, expected double, passage string")


def accepted(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` scored below ``threshold``, all columns kept, in one pass over the table."""
    mark = unused_name("_body", docs.columns)
    rows = docs.withColumn(mark, text_of(text_col))
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            keep = [held.value.probability(words_of(t.as_py())) < threshold for t in texts]
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays(kept.columns[:-1], kept.schema.names[:-1])

    return rows.mapInArrow(run, docs.schema)
