import random
import time

import numpy as np
import pytest
from fixtures import CLASHING, SCHEMA, awkward_rows, clashing_rows

from aeroflow.llm import decontaminate as dec
from aeroflow.llm import queries
from aeroflow.llm.common import table


def brute_tiles(item, doc, least):
    """Greedy string tiling by comparing every pair of starts."""
    free_a, free_b, out = [True] * len(item), [True] * len(doc), []
    while True:
        best, found = least, []
        for a in range(len(item)):
            for b in range(len(doc)):
                n = 0
                while a + n < len(item) and b + n < len(doc) and item[a + n] == doc[b + n] and free_a[a + n] and free_b[b + n]:
                    n += 1
                if n > best:
                    best, found = n, [(a, b)]
                elif n == best:
                    found.append((a, b))
        if not found:
            return out
        for a, b in found:
            if all(free_a[a : a + best]) and all(free_b[b : b + best]):
                free_a[a : a + best] = [False] * best
                free_b[b : b + best] = [False] * best
                out.append((a, b, best))


def brute_leaks(docs, items, threshold=0.8):
    out = []
    for doc_id, text in docs:
        doc = dec.words_of(text or "")
        grams = {n: {tuple(doc[i : i + n]) for i in range(len(doc) - n + 1)} for n in range(1, 6)}
        for item_id, item_text in items:
            item = dec.words_of(item_text or "")
            least = min(5, len(item))
            if not least or not any(tuple(item[i : i + least]) in grams[least] for i in range(len(item) - least + 1)):
                continue
            made = brute_tiles(item, doc, least)
            share = sum(n for *_, n in made) / len(item)
            if share >= threshold:
                out.append((doc_id, item_id, round(share, 9), len(made), max(n for *_, n in made)))
    return sorted(out, key=str)


def plain(df):
    return sorted(((r[0], r[1], round(r[2], 9), r[3], r[4]) for r in df.collect()), key=str)


def test_tiles_against_brute_force():
    rng = random.Random(4)
    for _ in range(150):
        item = [rng.randrange(4) for _ in range(rng.randrange(1, 25))]
        doc = [rng.randrange(4) for _ in range(rng.randrange(0, 60))]
        for least in (1, 2, 3):
            made = dec.tiles(np.array(item, np.uint64), np.array(doc, np.uint64), least)
            assert [(t.item_at, t.doc_at, t.length) for t in made] == brute_tiles(item, doc, least)


def test_coverage_of_reordered_passage():
    item = np.arange(1, 31, dtype=np.uint64)
    doc = np.concatenate([item[20:], np.arange(100, 140, dtype=np.uint64), item[:10], [np.uint64(7777)], item[10:20]])
    assert dec.coverage(item, doc, 5) == (1.0, 3, 10)
    assert dec.coverage(item, doc[:12], 5)[0] == pytest.approx(10 / 30)


def test_query_against_brute_force(spark, small_dir):
    docs = [tuple(r) for r in table(spark, small_dir, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in table(spark, small_dir, "benchmark").select("item_id", "text").collect()]
    assert plain(queries.op6_decontamination(spark, small_dir)) == brute_leaks(docs, items)


def shuffled_fixture(spark, rows, schema):
    rng = random.Random(9)
    base = [f"q{i}" for i in range(40)]
    items = [(1, " ".join(base)), (2, "one two"), (3, None), (4, " .,! "), (5, "One, TWO!"), (6, " ".join(base[:12]))]
    parts = [base[i : i + 8] for i in range(0, 40, 8)]
    rng.shuffle(parts)
    moved = " noise ".join(" ".join(p) for p in parts)
    extra = [(100, moved.upper()), (101, " ".join(base[:30])), (102, " ".join(base[:33])), (102, " ".join(base[:33]))]
    rest = rows[0][2:]
    rows = rows + [(i, t, *rest) for i, t in extra]
    return spark.createDataFrame(rows, schema), spark.createDataFrame(items, "item_id bigint, text string"), rows, items


def test_awkward_rows_by_either_way(spark):
    for schema, rows in ((SCHEMA, awkward_rows()), (CLASHING, clashing_rows())):
        docs, bench, rows, items = shuffled_fixture(spark, rows, schema)
        short = [(r[0], r[1] if len(r[1] or "") < 9000 else "long " * 50) for r in rows]
        expected = brute_leaks(short, items)
        assert (100, 1) in {(d, i) for d, i, *_ in expected}
        assert (101, 1) not in {(d, i) for d, i, *_ in expected}
        assert plain(dec.leaks(docs, bench)) == expected
        assert plain(dec.leaks(docs, bench, broadcast_bytes=0)) == expected
        leaked = {d for d, *_ in expected}
        left = sorted(str(r[0]) for r in rows if r[0] not in leaked)
        for way in (0, 1 << 20):
            kept = dec.clean(docs, bench, broadcast_bytes=way)
            assert kept.columns == docs.columns
            assert sorted(str(r["doc_id"]) for r in kept.collect()) == left


def test_empty_tables(spark):
    empty, bench = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "item_id bigint, text string")
    full = spark.createDataFrame(awkward_rows(), SCHEMA)
    for way in (0, 1 << 20):
        assert dec.leaks(empty, bench, broadcast_bytes=way).collect() == []
        assert dec.leaks(full, bench, broadcast_bytes=way).collect() == []
    assert dec.clean(full, bench).count() == full.count()


def test_texts_of_one_repeated_word():
    item, doc = np.full(200, 7, np.uint64), np.full(20_000, 7, np.uint64)
    started = time.perf_counter()
    assert dec.coverage(item, doc, 5) == (1.0, 1, 200)
    assert time.perf_counter() - started < 1
    # Two words in a pattern with many common runs of many lengths.
    rng = np.random.default_rng(3)
    item, doc = rng.integers(1, 3, 300).astype(np.uint64), rng.integers(1, 3, 20_000).astype(np.uint64)
    started = time.perf_counter()
    assert dec.coverage(item, doc, 5)[0] > 0.9
    assert time.perf_counter() - started < 2


def test_equal_hashes_of_unequal_runs_are_not_tiles(monkeypatch):
    monkeypatch.setattr(dec.Runs, "hashes", lambda self, length, starts: np.full(len(starts), length, np.uint64))
    rng = random.Random(11)
    for _ in range(60):
        item = [rng.randrange(3) for _ in range(rng.randrange(1, 14))]
        doc = [rng.randrange(3) for _ in range(rng.randrange(0, 30))]
        made = dec.tiles(np.array(item, np.uint64), np.array(doc, np.uint64), 2)
        assert [(t.item_at, t.doc_at, t.length) for t in made] == brute_tiles(item, doc, 2)


@pytest.mark.parametrize("kind", ["int", "string", "smallint", "decimal(10,2)", "date"])
def test_item_ids_of_any_type(spark, kind):
    text = "alpha beta gamma delta epsilon zeta"
    docs = spark.createDataFrame([(1, text), (2, "nothing of it")], "doc_id int, text string")
    day = {"date": "'2024-01-31'"}.get(kind, "'7'")
    bench = spark.createDataFrame([(text,)], "text string").selectExpr(f"cast({day} as {kind}) as item_id", "text")
    expected = [(1, bench.first()["item_id"], 1.0, 1, 6)]
    for way in (0, 1 << 20):
        found = dec.leaks(docs, bench, broadcast_bytes=way)
        assert found.schema["item_id"].dataType == bench.schema["item_id"].dataType
        assert plain(found) == expected


def test_items_with_a_common_beginning(spark):
    start = " ".join(f"please{i}" for i in range(12))
    items = [(i, start + " " + " ".join(f"i{i}x{j}" for j in range(40))) for i in range(30)]
    docs = [(i, start + f" and then what nobody asked {i}") for i in range(40)]
    docs += [(100 + i, items[i][1]) for i in range(0, 30, 7)] + [(200, " ".join(items[3][1].split()[::-1]))]
    frames = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    expected = brute_leaks(docs, items)
    assert [d for d, *_ in expected] == [100, 107, 114, 121, 128]
    for way in (0, 1 << 20):
        assert plain(dec.leaks(*frames, broadcast_bytes=way)) == expected
    seeds = dec._seeds(frames[1], "_item", 5, lambda n: [min(5, n)], False)
    shared = seeds.groupBy("seed").count().where("count = 30").select("seed")
    assert shared.count() == 8
    assert dec._rarest_seeds(seeds, 5, 0.8).join(shared, "seed").isEmpty()
