from collections import Counter, defaultdict

import pytest
from compare import connect, duck_rows, spark_rows
from fixtures import CLASHING, SCHEMA, awkward_rows, clashing_rows, words

from aeroflow.llm import mixing, queries


def brute_targets(sizes):
    """Target by source: shares by weight, cut at three times the size, shared again."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        shares = sum(weight[s] for s in order if s not in full)
        rate = (total - sum(3 * sizes[s] for s in full)) / shares if shares else 0
        over = {s for s in order if s not in full and rate * weight[s] > 3 * sizes[s]}
        if not over:
            return {s: 3 * sizes[s] if s in full else rate * weight[s] for s in order}
        full |= over


def test_matches_sql(spark, sf_dir):
    names, rows = spark_rows(queries.op8_mixing(spark, sf_dir))
    expected_names, expected = duck_rows(connect(sf_dir), queries.ORACLE_SQL["op8_mixing"])
    assert names == expected_names
    assert rows == expected


def test_awkward_rows(spark):
    for schema, rows in ((SCHEMA, awkward_rows()), (CLASHING, clashing_rows())):
        plan = mixing.mix_plan(spark.createDataFrame(rows, schema)).collect()
        assert len(plan) == len(rows)
        sizes = defaultdict(int)
        for r in rows:
            sizes[r[3]] += len(words(r[1]))
        targets = brute_targets(sizes)
        taken = defaultdict(int)
        for p in plan:
            assert p["source_size"] == sizes[p["source"]]
            assert p["target"] == pytest.approx(targets[p["source"]])
            assert 0 <= p["taken"] <= 3 * p["size"]
            taken[p["source"]] += p["taken"]
        for s, target in targets.items():
            assert abs(taken[s] - target) <= 3
        assert Counter((p["doc_id"], p["size"]) for p in plan) == Counter((r[0], len(words(r[1]))) for r in rows)


def test_reruns_agree(spark, small_dir):
    one, two = (spark_rows(queries.op8_mixing(spark, small_dir)) for _ in range(2))
    assert one == two


def test_many_buckets(spark, small_dir, monkeypatch):
    before = spark_rows(queries.op8_mixing(spark, small_dir))
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", 3)
    assert spark_rows(queries.op8_mixing(spark, small_dir)) == before


def test_mixed_rows_have_the_words_taken(spark):
    for schema, rows in ((SCHEMA, awkward_rows()), (CLASHING, clashing_rows())):
        docs = spark.createDataFrame(rows, schema)
        plan = mixing.mix_plan(docs).collect()
        out = mixing.mixed(docs)
        assert out.columns == docs.columns
        planned, made = defaultdict(int), defaultdict(int)
        for p in plan:
            planned[p["source"]] += p["taken"]
        for r in out.collect():
            made[r["source"]] += len(words(r["text"]))
        assert dict(made) == {s: n for s, n in planned.items() if n}


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mix_plan(empty).collect() == []
    assert mixing.mixed(empty).collect() == []


def test_only_blank_texts(spark):
    docs = spark.createDataFrame([(1, "", "en", "a", 0), (2, None, "en", "b", 0)], SCHEMA)
    assert [r["taken"] for r in mixing.mix_plan(docs).collect()] == [0, 0]
    assert mixing.mixed(docs).collect() == []


def test_first_words(spark):
    rows = [(" a  b\tc ", 2), ("a", 5), ("a b", 0), ("é\x0bß 🙂 x", 3), ("", 1), ("  ", 1), ("a b ", 2)]
    frame = spark.createDataFrame(rows, "t string, n bigint")
    found = frame.select(mixing.first_words(frame["t"], frame["n"])).collect()
    assert [r[0] for r in found] == [" a  b", "a", "", "é\x0bß 🙂 x"[:5], "", "  ", "a b"]
