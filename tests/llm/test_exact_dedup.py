import re

import numpy as np
import pytest
from compare import connect, duck_rows, spark_rows
from fixtures import CLASHING, SCHEMA, awkward_rows, clashing_rows

from aeroflow.llm import exact_dedup, queries
from aeroflow.llm.fuse import FuseFilter


def test_matches_sql(spark, sf_dir):
    names, rows = spark_rows(queries.op10_exact_dedup(spark, sf_dir))
    expected_names, expected = duck_rows(connect(sf_dir), queries.ORACLE_SQL["op10_exact_dedup"])
    assert names == expected_names
    assert rows == expected


def test_awkward_rows(spark):
    for schema, rows in ((SCHEMA, awkward_rows()), (CLASHING, clashing_rows())):
        found = exact_dedup.exact_duplicates(spark.createDataFrame(rows, schema)).collect()
        assert len(found) == len(rows)
        norm = [re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in rows]
        ids = {n: [r[0] for r, m in zip(rows, norm, strict=True) if m == n] for n in norm}
        expected = sorted(
            (str(r[0]), str(min([i for i in ids[n] if i is not None], default=None)), len(ids[n]))
            for r, n in zip(rows, norm, strict=True)
        )
        assert sorted((str(f["doc_id"]), str(f["keep_id"]), f["group_size"]) for f in found) == expected
        assert sum(f["kept"] for f in found) == len(ids)


def test_empty_table(spark):
    assert exact_dedup.exact_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_filter_finds_all_keys_and_few_others():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 3, 10, 1000, 100_000):
        keys = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        one = FuseFilter.build(np.concatenate([keys, keys[: n // 2]]))
        assert one.contains(keys).all()
        others = rng.integers(1 << 63, 1 << 64, 200_000, dtype=np.uint64)
        assert one.contains(others).mean() < 2e-4
    assert len(one.cells) * 16 < 22 * n


def test_snapshot_screens_and_extends(spark):
    rows = [(i, f"text {i % 70}", "en", "a", 1) for i in range(200)]
    docs = spark.createDataFrame(rows, SCHEMA)
    groups = exact_dedup.grouped(exact_dedup.digests(docs, "doc_id", "text"))
    snapshot = exact_dedup.Snapshot.of(groups)
    more = spark.createDataFrame([(i, f"text {i}", "en", "a", 1) for i in range(60, 90)], SCHEMA)
    batch = exact_dedup.grouped(exact_dedup.digests(more, "doc_id", "text"))
    assert snapshot.matches(batch).count() == 10
    assert snapshot.screened(batch).count() <= 11
    grown = snapshot.extended(batch)
    assert grown.rows.count() == 90
    assert grown.matches(groups).count() == 70


def test_several_buckets(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "KEYS_PER_BUCKET", 7)
    rows = [(i, f"text {i % 50}", "en", "a", 1) for i in range(120)]
    found = exact_dedup.exact_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {f["doc_id"] for f in found if f["kept"]} == set(range(50))
    assert all(f["keep_id"] == f["doc_id"] % 50 for f in found)


@pytest.mark.parametrize("kind", ["string", "int", "timestamp", "binary", "decimal(20,3)"])
def test_ids_of_any_ordered_type(spark, kind):
    ids = "timestamp_seconds(doc_id)" if kind == "timestamp" else "encode(string(doc_id), 'utf-8')" if kind == "binary" else f"cast(doc_id as {kind})"
    docs = spark.createDataFrame(awkward_rows(), SCHEMA).selectExpr(f"{ids} as doc_id", "text")
    found = exact_dedup.exact_duplicates(docs)
    assert found.schema["keep_id"].dataType == docs.schema["doc_id"].dataType
    rows = found.collect()
    assert len(rows) == len(awkward_rows())
    assert sum(r["kept"] for r in rows) == len({r["text_sha256"] for r in rows})
    assert all(r["kept"] <= (r["doc_id"] == r["keep_id"]) for r in rows)
