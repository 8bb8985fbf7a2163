import random

import numpy as np
import xxhash
from fixtures import CLASHING, SCHEMA, awkward_rows, clashing_rows, components, words

from aeroflow.llm import queries, simhash
from aeroflow.llm.common import table


def brute_fingerprint(text, shingle=4):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = words(lowered)
    parts = [" ".join(w[i : i + shingle]) for i in range(len(w) - shingle + 1)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, max_bits=4):
    """Sorted (id, fingerprint, component) for rows of (id, text)."""
    fps = [brute_fingerprint(t) for _, t in rows]
    member = components(set(fps), lambda a, b: (a ^ b).bit_count() <= max_bits)
    least = {}
    for (i, _), fp in zip(rows, fps, strict=True):
        for m in member[fp]:
            if i is not None:
                least[m] = min(i, least.get(m, i))
    return [(i, f"{fp:016x}", least.get(fp)) for (i, _), fp in zip(rows, fps, strict=True)]


def ordered(rows):
    return sorted(map(tuple, rows), key=str)


def test_query_against_brute_force(spark, small_dir):
    rows = table(spark, small_dir, "documents").select("doc_id", "text").collect()
    found = queries.op1_simhash(spark, small_dir)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    assert ordered(found.collect()) == ordered(brute([tuple(r) for r in rows]))


def test_awkward_rows(spark):
    for schema, rows in ((SCHEMA, awkward_rows()), (CLASHING, clashing_rows())):
        found = simhash.near_duplicates(spark.createDataFrame(rows, schema))
        got = [(r[0], f"{r[1] & (1 << 64) - 1:016x}", r[2]) for r in found.collect()]
        assert ordered(got) == ordered(brute([r[:2] for r in rows]))


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.keep_one(empty).collect() == []


def test_keep_one_keeps_one_row_of_each_group(spark):
    for schema, rows in ((SCHEMA, awkward_rows()), (CLASHING, clashing_rows())):
        docs = spark.createDataFrame(rows, schema)
        kept = simhash.keep_one(docs)
        assert kept.columns == docs.columns
        expected = brute([r[:2] for r in rows])
        fps = {brute_fingerprint(r[1]) for r in rows}
        member = components(fps, lambda a, b: (a ^ b).bit_count() <= 4)
        groups = {tuple(sorted(m)) for m in member.values()}
        got = kept.collect()
        assert len(got) == len(groups)
        of = {tuple(r[:2]): e[2] for r, e in zip(rows, expected, strict=True)}
        assert all(of[(r["doc_id"], r["text"])] == r["doc_id"] for r in got)


def _near(rng, center, bits):
    for b in rng.sample(range(64), bits):
        center ^= 1 << b
    return center


def test_every_link_is_found(spark):
    rng = random.Random(1)
    centers = [rng.getrandbits(64) for _ in range(60)]
    values = set(centers)
    for c in centers:
        for bits in range(1, 7):
            values.add(_near(rng, c, bits))
    for max_bits in (0, 1, 2, 3, 4, 5, 7):
        signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
        edges = simhash.links(spark.createDataFrame(signed, "fingerprint bigint"), max_bits).collect()
        pairs = {frozenset((r.u & (1 << 64) - 1, r.v & (1 << 64) - 1)) for r in edges}
        assert len(pairs) == len(edges)
        assert all(max((a ^ b).bit_count() for a, b in [tuple(p)]) <= max_bits for p in pairs)
        member = components(values, lambda a, b, k=max_bits: (a ^ b).bit_count() <= k)
        joined = components(values, lambda a, b: frozenset((a, b)) in pairs)
        assert {v: sorted(m) for v, m in member.items()} == {v: sorted(m) for v, m in joined.items()}


def test_large_group_is_divided_without_losing_links(monkeypatch):
    rng = random.Random(2)
    center = rng.getrandbits(64)
    values = np.array(sorted({_near(rng, center, rng.randrange(9)) for _ in range(700)}), np.uint64)
    for limit in (10, 10_000):
        monkeypatch.setattr(simhash, "LARGE_GROUP", limit)
        edges = simhash.group_edges(values, (1 << 64) - 1, 4)
        joined = components(set(values.tolist()), lambda a, b, e={frozenset(x) for x in edges}: frozenset((a, b)) in e)
        member = components(set(values.tolist()), lambda a, b: (a ^ b).bit_count() <= 4)
        assert {v: sorted(m) for v, m in member.items()} == {v: sorted(m) for v, m in joined.items()}


def test_dense_group_gives_few_edges(spark):
    rng = random.Random(3)
    center = rng.getrandbits(64)
    values = {_near(rng, center, 2) for _ in range(900)} | {center}
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    n = simhash.links(spark.createDataFrame(signed, "fingerprint bigint"), 4).count()
    assert n < 64 * len(values)
