import hashlib
import random

import numpy as np
import pytest
from fixtures import CLASHING, SCHEMA, awkward_rows, clashing_rows, words

from aeroflow.llm import queries, repeats, rlz_dedup
from aeroflow.llm.common import table


def brute(rows, window=20):
    """(id, words, removed, sha256) of rows of (id, text), which are in order."""
    seen, out = set(), []
    for i, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for at in range(len(w) - window + 1):
            key = tuple(w[at : at + window])
            if key in seen:
                gone[at : at + window] = [True] * window
            seen.add(key)
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r[0], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect()), key=str)


@pytest.fixture(autouse=True)
def small_chunks(monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 60_000)


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))


def test_query_against_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    found = queries.op7_rlz_dedup(spark, sf_dir)
    assert found.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert got(found) == brute(by_id(rows))


def test_awkward_rows(spark):
    for schema, rows in ((SCHEMA, awkward_rows()), (CLASHING, clashing_rows())):
        docs = spark.createDataFrame(rows, schema)
        found = rlz_dedup.without_repeats(docs)
        assert got(found) == brute(by_id([r[:2] for r in rows]))
        assert all(hashlib.sha256(r["kept_text"].encode()).hexdigest() == r["kept_sha256"] for r in found.collect())


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert rlz_dedup.without_repeats(empty).collect() == []
    assert rlz_dedup.duplicate_spans(empty).collect() == []


def test_few_words_repeat_very_often(spark):
    rng = random.Random(11)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(60)))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    for window in (1, 2, 5, 9):
        assert got(rlz_dedup.without_repeats(docs, window=window)) == brute(rows, window)


def test_passages_across_documents(spark):
    rng = random.Random(12)
    passages = [[f"p{i}_{j}" for j in range(60)] for i in range(5)]
    rows = []
    for i in range(400):
        w = [f"d{i}_{j}" for j in range(rng.randrange(30))]
        a = rng.randrange(30)
        w += rng.choice(passages)[a : a + rng.randrange(15, 45)] + [f"e{i}_{j}" for j in range(rng.randrange(30))]
        rows.append((rng.randrange(1 << 40), " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    assert got(rlz_dedup.without_repeats(docs)) == brute(sorted(rows))


def test_factors_name_their_source(spark):
    rows = [(1, " ".join(f"a{i}" for i in range(50))), (2, " ".join(["x", *(f"a{i}" for i in range(10, 45)), "y"]))]
    found = rlz_dedup.duplicate_spans(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert [tuple(r) for r in found] == [(2, 1, 36, 1, 10)]


def test_range_hash_depends_on_bytes_only():
    text = np.frombuffer(b"xxabcabcyyabc", np.uint8)
    h = repeats.RangeHash(text)
    starts, stops = np.array([2, 5, 10, 0]), np.array([5, 8, 13, 3])
    values = h(starts, stops)
    assert values[0] == values[1] == values[2] != values[3]


def test_blocks_do_not_change_anchors(monkeypatch):
    rng = np.random.default_rng(3)
    text = rng.integers(97, 100, 20_000).astype(np.uint8)
    units = repeats.Units(text, np.arange(4), np.array([7_000, 7_000, 7_050, 20_000]))
    shape = repeats.Shape(100, 32)
    whole = repeats.anchors(units, shape)
    monkeypatch.setattr(repeats, "BLOCK", 777)
    parts = repeats.anchors(units, shape)

    def per_window(a):
        return sorted((w, int(p), int(h)) for p, f, t, h in zip(a.place, a.first, a.last, a.hash, strict=True) for w in range(f, t + 1))

    assert per_window(whole) == per_window(parts)
    assert len(per_window(whole)) == 7_000 - 99 + 12_950 - 99


def test_sliding_min():
    x = np.array([5, 3, 8, 1, 9, 2, 7, 7, 4])
    for width in range(1, 9):
        assert repeats.sliding_min(x, width).tolist() == [min(x[i : i + width]) for i in range(len(x) - width + 1)]


def test_regular_words_that_differ_stay(spark):
    # The Thue-Morse sequence and its exchange have equal polynomial sums modulo 2^64.
    first = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    same = " ".join(f"w{i}" for i in range(19))
    rows = [(1, f"{first} {same}"), (2, f"{first.translate(str.maketrans('ab', 'ba'))} {same}"), (3, f"{first} {same}")]
    found = rlz_dedup.without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["n_removed"] for r in found} == {1: 0, 2: 0, 3: 20}


def test_words_of_two_letters_as_brute_force(spark):

    pick = random.Random(9)
    rows = [(i, " ".join("".join(pick.choice("ab") for _ in range(pick.randrange(1, 3))) for _ in range(pick.randrange(400)))) for i in range(40)]
    found = rlz_dedup.without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), window=6).collect()
    seen, want = set(), {}
    for i, text in rows:
        words = text.split()
        gone = [False] * len(words)
        for at in range(len(words) - 5):
            window = tuple(words[at : at + 6])
            if window in seen:
                gone[at : at + 6] = [True] * 6
            seen.add(window)
        want[i] = sum(gone)
    assert {r["doc_id"]: r["n_removed"] for r in found} == want


def test_unequal_windows_with_equal_hashes_are_found_out(spark):
    rng = random.Random(21)
    rows = [(i % 50, " ".join(rng.choice("abcd") for _ in range(rng.randrange(80)))) for i in range(60)] + [(None, "a b c d a b c d")] * 3
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    expected = got(rlz_dedup.without_repeats(docs, window=5))
    # Hashes of 3 bits match nearly everything: the words then differ, and the next attempt counts.
    assert got(rlz_dedup.without_repeats(docs, window=5, attempts=(3, 3, 96))) == expected
    with pytest.raises(RuntimeError, match="equal hashes"):
        rlz_dedup.without_repeats(docs, window=5, attempts=(3,))


def test_pieces_cover_spans_and_are_few():
    text = np.frombuffer(b"0123456789" * 30, np.uint8)
    units = repeats.Units(text, np.array([4]), np.array([300]))
    rng = np.random.default_rng(2)
    spans = np.zeros(200, repeats.SPAN)
    spans["at"] = rng.integers(0, 60, 200)
    spans["start"] = spans["at"] + 100
    spans["stop"] = spans["start"] + rng.integers(20, 60, 200)
    for one in spans:
        wanted = repeats._wanted(units, spans[:0], 16) + repeats._wanted(units, np.array([one]), 16)
        places = {p for w in wanted for p in range(w["at"], w["at"] + 16)}
        assert places == set(range(one["at"], one["at"] + one["stop"] - one["start"]))
        assert repeats._missing(units, [{**w, "id": 4} for w in wanted], 16) == 0
        assert repeats._missing(units, [{**w, "id": 5} for w in wanted], 16) == len(wanted)
    assert len({(w["at"]) for w in repeats._wanted(units, spans, 16)}) <= 120


def test_nothing_stays_in_the_catalog(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "a b c")], "doc_id bigint, text string")
    before = {t.name for t in spark.catalog.listTables()}
    found = rlz_dedup.without_repeats(docs, window=2)
    assert {t.name for t in spark.catalog.listTables()} == before
    assert sorted(r["n_removed"] for r in found.collect()) == [0, 3]
