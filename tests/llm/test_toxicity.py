import random
import zlib

import numpy as np
import pytest
from fixtures import CLASHING, SCHEMA, awkward_rows, clashing_rows

from aeroflow.llm import queries, toxicity
from aeroflow.llm.common import table


def brute_segments(scores):
    """All maximal segments by definition: no better part inside, not inside a longer such one."""
    n = len(scores)
    totals = np.concatenate([[0.0], np.cumsum(scores)])

    def good(i, j):
        return all(totals[i] < totals[k] for k in range(i + 1, j + 1)) and all(totals[k] < totals[j] for k in range(i, j))

    found = [(i, j) for i in range(n) for j in range(i + 1, n + 1) if good(i, j)]
    return [(i, j) for i, j in found if not any((a <= i and j <= b) and (a, b) != (i, j) for a, b in found)]


def test_segments_against_definition():
    rng = random.Random(6)
    for _ in range(400):
        scores = [rng.choice([-3, -2, -1, 1, 2, 4]) + rng.random() / 10 for _ in range(rng.randrange(14))]
        made = toxicity.maximal_segments([(i, i + 1, s) for i, s in enumerate(scores)])
        assert [(a, b) for a, b, _ in made] == brute_segments(scores)
        assert all(s == pytest.approx(sum(scores[a:b])) for a, b, s in made)


def test_extreme_value_rate_solves_its_equation():
    p, s = np.array([0.1, 0.9]), np.array([2.0, -1.0])
    rate = toxicity.extreme_value_rate(p, s)
    assert p @ np.exp(rate * s) == pytest.approx(1)


def test_query_on_held_out_rows(spark, sf_dir):
    found = queries.op4_toxicity(spark, sf_dir)
    assert found.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = {r["doc_id"]: r for r in found.collect()}
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, sf_dir, "labels").collect()}
    assert len(rows) == table(spark, sf_dir, "documents").count()
    for i, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
        assert r["predicted"] == int(r["score"] >= 0.3)
    tested = [(labels[i], r["predicted"]) for i, r in rows.items() if r["held_out"] and i in labels]
    hits = sum(y and p for y, p in tested)
    assert hits / max(1, sum(y for y, _ in tested)) >= 0.7
    assert hits / max(1, sum(p for _, p in tested)) >= 0.7


def labelled(spark, rows, schema):
    rng = random.Random(8)
    plain = [f"word{i}" for i in range(300)]
    more = []
    for i in range(100, 500):
        bad = i % 5 == 0
        text = [rng.choice(plain) for _ in range(60)]
        for at in rng.sample(range(60), 4 if bad else 0):
            text[at] = rng.choice(["awful", "nasty" + rng.choice("abcdef")])
        more.append((i, " ".join(text), *rows[0][2:]))
    labels = [(i, int(i % 5 == 0)) for i in range(100, 500)] + [(None, 1), (100, None), (105, 1), (105, 1), (99_999, 0)]
    return spark.createDataFrame(rows + more, schema), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_awkward_rows(spark):
    for schema, rows in ((SCHEMA, awkward_rows()), (CLASHING, clashing_rows())):
        docs, labels = labelled(spark, rows, schema)
        model = toxicity.train(docs, labels)
        assert "awful" in model.scores
        assert any(f.endswith("*") for f in model.scores)
        scored = {(r["doc_id"]): r["score"] for r in toxicity.scores(docs, model).collect()}
        assert all((scored[i] >= 0.3) == (i % 5 == 0) for i in range(100, 500))
        assert scored[3] == scored[4] == scored[5] < 0.3
        kept = toxicity.accepted(docs, model)
        assert kept.columns == docs.columns
        assert kept.count() == len(rows) + 320
        found = toxicity.passages(docs, model).collect()
        assert {r["doc_id"] for r in found} <= set(range(100, 500, 5))
        assert all("awful" in r["passage"] or "nasty" in r["passage"] for r in found)


def test_reruns_agree(spark, small_dir):
    docs, labels = table(spark, small_dir, "documents"), table(spark, small_dir, "labels")
    one, two = toxicity.train(docs, labels), toxicity.train(docs.repartition(7), labels)
    assert (one.scores, one.rate, one.curve) == (two.scores, two.rate, two.curve)


def test_without_labels(spark):
    docs = spark.createDataFrame(awkward_rows(), SCHEMA)
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = toxicity.train(docs, none)
    assert {r["score"] for r in toxicity.scores(docs, model).collect()} == {0.0}
    assert toxicity.accepted(docs, model).count() == docs.count()
    assert toxicity.scores(docs.limit(0), model).collect() == []


def test_held_out_labels_are_not_learned(spark, small_dir):
    labels = table(spark, small_dir, "labels")
    chosen = toxicity.training_labels(labels, "doc_id", "toxic", 50).collect()
    assert 0 < len(chosen) <= 50
    assert all(zlib.crc32(str(r["_key"]).encode()) % 4 != 2 for r in chosen)
