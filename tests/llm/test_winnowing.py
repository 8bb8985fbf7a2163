from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from fixtures import CLASHING, SCHEMA, awkward_rows, clashing_rows

from aeroflow.llm import queries, winnowing
from aeroflow.llm.winnowing import Winnow, against_next, edited, fingerprints

MASK = (1 << 64) - 1


def spread(x):
    x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ x >> 27) * 0x94D049BB133111EB) & MASK
    return x ^ x >> 31


def turned(x, by):
    by %= 64
    return (x << by | x >> (64 - by)) & MASK


def plain(text, gram, window):
    """Hash and place of each kept run, window by window."""
    points = [ord(c) + 1 for c in text]
    gram = min(gram, len(points))
    if not points:
        return []
    hashes = []
    for i in range(len(points) - gram + 1):
        h = 0
        for j, point in enumerate(points[i : i + gram]):
            h ^= turned(spread(point), -j)
        hashes.append(spread(h))
    width = min(window, len(hashes))
    kept = set()
    for i in range(len(hashes) - width + 1):
        kept.add(max(j for j in range(i, i + width) if hashes[j] == min(hashes[i : i + width])))
    return [(hashes[j], j) for j in sorted(kept)]


def texts(seed):
    pick = random.Random(seed)
    for alphabet in ("a", "ab", "abcdefgh ", "aé🙂 \n"):
        for n in (0, 1, 2, 4, 5, 6, 11, 12, 13, 40, 300):
            yield "".join(pick.choice(alphabet) for _ in range(n))


@pytest.mark.parametrize(("gram", "window"), [(1, 1), (5, 8), (5, 7), (8, 1), (64, 3), (winnowing.GRAM, winnowing.WINDOW)])
@pytest.mark.parametrize("block", [winnowing.BLOCK, 16])
def test_as_window_by_window(monkeypatch, gram, window, block):
    monkeypatch.setattr(winnowing, "BLOCK", block)
    for text in texts(gram * 100 + window):
        found = Winnow(gram, window).fingerprint(text)
        assert list(zip(found.hashes.tolist(), found.places.tolist(), strict=True)) == plain(text, gram, window), text


def test_shared_passage_keeps_a_hash_at_its_place():
    pick, winnow = random.Random(4), Winnow()
    for _ in range(50):
        passage = "".join(pick.choice("abcdef ") for _ in range(winnow.gram + winnow.window - 1))
        before, after = pick.randrange(200), pick.randrange(200)
        one = "".join(pick.choice("ghijkl ") for _ in range(before)) + passage + "rest"
        two = "".join(pick.choice("mnopqr ") for _ in range(after)) + passage
        kept = {h: p for h, p in zip(*map(np.ndarray.tolist, (winnow.fingerprint(one).hashes, winnow.fingerprint(one).places)), strict=True)}
        found = winnow.fingerprint(two)
        assert any(kept.get(h) == p - after + before for h, p in zip(found.hashes.tolist(), found.places.tolist(), strict=True))


def test_bad_lengths():
    for gram, window in ((0, 1), (65, 1), (8, 0)):
        with pytest.raises(ValueError):
            Winnow(gram, window)


def expected(rows, order_of):
    """``order_of`` gives the places of rows of one id, which a hash orders."""
    winnow = Winnow()
    rows = [(i, t or "") for i, t in rows]
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), order_of[r[1]]))
    out = []
    for at, (doc_id, text) in enumerate(rows):
        other = rows[(at + 1) % len(rows)][1]
        n = len(text) // 3
        changed = text[: len(text) - n] + other[:n]
        prints = [winnow.fingerprint(t) for t in (text, changed, other)]
        sets = [set(p.hashes.tolist()) for p in prints]
        near = [len(sets[0] & s) / len(sets[0] | s) if sets[0] | s else 1.0 for s in sets[1:]]
        digest = hashlib.sha256(changed.encode()).hexdigest()
        out.append((doc_id, len(text), digest, prints[0].digits(), prints[1].digits(), *near))
    return sorted(out, key=str)


def check(spark, found, rows):
    distinct = sorted({t or "" for _, t in rows})
    hashed = spark.createDataFrame([(t,) for t in distinct], "t string").selectExpr("t", "xxhash64(t) h")
    order_of = {r["t"]: r["h"] for r in hashed.collect()}
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert sorted((tuple(r) for r in found.select(*names).collect()), key=str) == expected(rows, order_of)


@pytest.mark.parametrize("parts", ["1", "4", "30"])
def test_awkward_rows(spark, parts):
    rows = awkward_rows()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        check(spark, against_next(spark.createDataFrame(rows, SCHEMA).repartition(3)), [r[:2] for r in rows])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_many_copies_of_one_row(spark):
    rows = [(3, "the same text of a document " * 4)] * 40 + [(None, None)] * 30 + [(i, f"number {i} " * 9) for i in range(20)]
    check(spark, against_next(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)), rows)


def test_clashing_names_empty_table_single_row(spark):
    rows = clashing_rows()
    check(spark, against_next(spark.createDataFrame(rows, CLASHING)), [r[:2] for r in rows])
    assert against_next(spark.createDataFrame([], SCHEMA)).count() == 0
    check(spark, against_next(spark.createDataFrame([(1, "abc" * 50)], "doc_id bigint, text string")), [(1, "abc" * 50)])


def test_fingerprints_of_all_rows(spark):
    rows = awkward_rows()
    found = fingerprints(spark.createDataFrame(rows, SCHEMA)).collect()
    got = sorted(((r["doc_id"], r["n_chars"], [h % 2**64 for h in r["hashes"]], r["places"]) for r in found), key=str)
    want = [(r[0], Winnow().fingerprint(r[1] or ""), len(r[1] or "")) for r in rows]
    assert got == sorted(((i, n, p.hashes.tolist(), p.places.tolist()) for i, p, n in want), key=str)


def test_edit():
    assert edited("abcdefg", "xyz") == "abcdexy"
    assert edited("abcdefghi", "x") == "abcdefx"
    assert edited("ab", "xyz") == "ab"
    assert edited("", "xyz") == ""


def test_query_on_whole_table(spark, small_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = queries.op12_winnowing(spark, small_dir)
    check(spark, found, rows)
    means = found.selectExpr("avg(near_edited) e", "avg(near_next) n").first()
    assert means["e"] > 0.4 and means["n"] < 0.1
