import hashlib
import random

import numpy as np
import pytest
from fixtures import CLASHING, SCHEMA, awkward_rows, clashing_rows

from aeroflow.llm import lcp_merge, queries, repeats, suffix_dedup
from aeroflow.llm.common import table


def brute(rows, window=100):
    """(id, bytes, removed, spans, sha256) of rows of (id, text), which are in order."""
    seen, out = set(), []
    for i, text in rows:
        b = (text or "").encode()
        gone = [False] * len(b)
        for at in range(len(b) - window + 1):
            key = b[at : at + window]
            if key in seen:
                gone[at : at + window] = [True] * window
            else:
                seen.add(key)
        spans = sum(g and not (at and gone[at - 1]) for at, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r[0], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()), key=str)


@pytest.fixture(autouse=True)
def small_chunks(monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 60_000)


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))


def test_query_against_brute_force(spark, small_dir):
    rows = [tuple(r) for r in table(spark, small_dir, "documents").select("doc_id", "text").collect()]
    found = queries.op2_suffix_dedup(spark, small_dir)
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert got(found) == brute(by_id(rows))


def test_awkward_rows(spark):
    for schema, rows in ((SCHEMA, awkward_rows()), (CLASHING, clashing_rows())):
        docs = spark.createDataFrame(rows, schema)
        assert got(suffix_dedup.without_repeats(docs)) == brute(by_id([r[:2] for r in rows]))


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert suffix_dedup.without_repeats(empty).collect() == []
    assert suffix_dedup.repeated_spans(empty).collect() == []


def passages(n, seed):
    rng = random.Random(seed)
    shared = ["".join(rng.choice("abcdefgh \0é") for _ in range(90)) for _ in range(4)]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(60)))
        for _ in range(rng.randrange(3)):
            a = rng.randrange(60)
            text += rng.choice(shared)[a : a + rng.randrange(10, 90)] + rng.choice(["", "x", "yz"])
        rows.append((rng.randrange(1 << 40), text))
    return rows


@pytest.mark.parametrize("window", [2, 7, 30, 100])
@pytest.mark.parametrize("hot", [1, 10_000])
def test_passages_across_documents(spark, window, hot):
    rows = passages(300, window)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    assert got(suffix_dedup.without_repeats(docs, window=window, hot=hot)) == brute(sorted(rows), window)


def test_spans_are_maximal(spark):
    a, b = "0123456789" * 12, "".join(chr(97 + i % 26) for i in range(113))
    rows = [(1, a), (2, b), (3, "p" + b[:105] + "-" + b + "q")]
    found = suffix_dedup.repeated_spans(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(tuple(r) for r in found) == [(1, 10, 120), (3, 1, 106), (3, 107, 220)]


def test_loser_tree_merges_runs_with_their_prefixes():
    rng = random.Random(13)
    for n_runs in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted(bytes(rng.choice(b"\0ab") for _ in range(rng.randrange(9))) for _ in range(rng.randrange(40))) for _ in range(n_runs)]
        coded = []
        for run in runs:
            width = max(map(len, run), default=0) or 1
            rows = np.array([list(s.ljust(width, b"\0")) for s in run], np.uint8).reshape(len(run), width)
            lengths = np.array([len(s) for s in run], np.int64)
            lcp, tail = lcp_merge.front_coded(rows, lengths)
            assert [s for _, s in lcp_merge.decoded(lcp, lengths, tail.tobytes())] == run
            coded.append(lcp_merge.decoded(lcp, lengths, tail.tobytes()))
        out = list(lcp_merge.merged(coded))
        assert [s for _, _, s in out] == sorted(s for run in runs for s in run)
        assert [(s, r) for r, _, s in out] == sorted((s, r) for r, run in enumerate(runs) for s in run)
        for (_, _, x), (_, shared, y) in zip(out, out[1:], strict=False):
            assert shared == lcp_merge.common_prefix(x, y, 0)


def test_slices_do_not_change_answers(monkeypatch):
    rng = np.random.default_rng(14)
    text = rng.integers(97, 99, 3_000).astype(np.uint8)
    units = repeats.Units(text, np.arange(3), np.array([900, 2_000, 3_000]))
    shape = suffix_dedup.shape_of(12)
    suffixes = suffix_dedup.Suffixes.of(units, repeats.anchors(units, shape), shape)
    (_, n, block), = suffixes.blocks(units, 1)
    whole = suffix_dedup.resolve_suffixes(12, shape.gram)([0], [n], [block])
    monkeypatch.setattr(suffix_dedup, "SLICE", 50)
    assert suffix_dedup.resolve_suffixes(12, shape.gram)([0], [n], [block]) == whole


def test_hot_windows_with_equal_hashes_are_found_out(spark):
    rows = passages(80, 7)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    found = suffix_dedup.without_repeats(docs, window=7, hot=1, attempts=(4, 96))
    assert got(found) == brute(sorted(rows), 7)
    with pytest.raises(RuntimeError, match="equal hashes"):
        suffix_dedup.without_repeats(docs, window=7, hot=1, attempts=(4,))
