"""Near-duplicates by SimHash, found through one-wildcard segment variants.

A fingerprint of 64 bits is cut into ``max_bits // 2 + 1`` segments. Two
fingerprints that differ in at most ``max_bits`` bits then have a segment that
differs in at most one. For each segment and each of its bits, the segment without
that bit is a signature; equal signatures bring such pairs together, and the whole
fingerprints are compared. Copies share a fingerprint and are one row throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeroflow.llm.common import batches_of, columns, stored, text_of
from aeroflow.llm.components import components

BITS = 64
SEED = 42
# Groups up to this size are compared by shifted vectors, larger ones by search.
SMALL_GROUP = 16
# Groups over this size are first divided by blocks of the bits that are still free.
LARGE_GROUP = 4096
_BLOCK = 255  # rows whose bits fit into a byte when summed


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """XXH64 of each run of ``shingle`` words; of the whole text if it has fewer."""
    words = text.lower().split()  # of bytes: ASCII letters, ASCII white space
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([digest(joined, SEED)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
    stops = ends[shingle - 1 :].tolist()
    return np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, len(starts)
    )


def majority_bits(hashes: np.ndarray) -> int:
    """Each bit that is set in over half of the hashes; zero for none."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), _BLOCK * 256):
        part = hashes[at : at + _BLOCK * 256]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        whole = len(bits) // _BLOCK * _BLOCK
        if whole:
            counts += bits[:whole].reshape(-1, _BLOCK, BITS).sum(1, dtype=np.uint8).sum(0, dtype=np.int64)
        counts += bits[whole:].sum(0, dtype=np.uint8)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint(text: bytes, shingle: int) -> int:
    return majority_bits(shingle_hashes(text, shingle))


def fingerprints(docs: DataFrame, key_cols: list[str], text_col: str, shingle: int) -> DataFrame:
    """``key_cols`` and ``fingerprint`` (its 64 bits as a signed bigint) for every row.

    NULL and blank texts have the fingerprint zero.
    """
    rows = docs.select(*key_cols, text_of(text_col).cast("binary").alias("_text"))
    kept = rows.drop("_text").schema.add("fingerprint", T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            values = np.fromiter((fingerprint(t.as_py(), shingle) for t in texts), np.uint64, len(texts))
            columns = [*batch.columns[:-1], pa.array(values.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "fingerprint"])

    return rows.mapInArrow(run, kept)


def segments(max_bits: int) -> list[tuple[int, int]]:
    """First bit and width of each segment."""
    n = max_bits // 2 + 1
    cuts = [round(i * BITS / n) for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def variant_masks(max_bits: int) -> list[tuple[int, int, int]]:
    """Segment, wildcard bit and mask of the bits that must agree, for each variant."""
    out = []
    for s, (first, width) in enumerate(segments(max_bits)):
        segment = ((1 << width) - 1) << first
        out += [(s, bit, segment & ~(1 << bit)) for bit in range(first, first + width)]
    return out


def _canonical(x: np.ndarray, variant: np.ndarray, max_bits: int) -> np.ndarray:
    """Whether pairs with differing bits ``x`` are first met in this variant.

    That is the first segment with at most one differing bit, with that bit as the
    wildcard, or the segment's first bit if none differs. So no pair counts twice.
    """
    masks = variant_masks(max_bits)
    segment_of = np.array([s for s, _, _ in masks])[variant]
    bit_of = np.array([1 << b for _, b, _ in masks], np.uint64)[variant]
    first = np.array([segments(max_bits)[s][0] for s, _, _ in masks])[variant]
    ok = np.ones(len(x), bool)
    for s, (at, width) in enumerate(segments(max_bits)):
        inside = x & np.uint64(((1 << width) - 1) << at)
        earlier = segment_of > s
        ok &= ~(earlier & (np.bitwise_count(inside) <= 1))
        here = segment_of == s
        wildcard = np.where(inside == 0, np.uint64(1) << first.astype(np.uint64), inside)
        ok &= ~here | (wildcard == bit_of)
    return ok


def _spanning(values: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Edges that connect what links within ``max_bits`` connect, one for each value at most."""
    edges = []
    rest = values
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        frontier = [root]
        while frontier and len(rest):
            near = np.bitwise_count(rest ^ frontier.pop()) <= max_bits
            found, rest = rest[near], rest[~near]
            edges += [(int(root), int(v)) for v in found]
            frontier += list(found)
    return edges


def group_edges(values: np.ndarray, free: int, max_bits: int) -> list[tuple[int, int]]:
    """Spanning edges of one group; ``free`` are the bits in which its members may differ.

    A large group is divided once more: of ``max_bits + 1`` blocks of the free bits,
    two linked members agree in one.
    """
    if len(values) <= LARGE_GROUP:
        return _spanning(values, max_bits)
    bits = [b for b in range(BITS) if free >> b & 1]
    edges = []
    for block in np.array_split(np.array(bits, np.uint64), max_bits + 1):
        mask = np.bitwise_or.reduce(np.uint64(1) << block)
        order = np.argsort(values & mask, kind="stable")
        sorted_values = values[order]
        cuts = np.flatnonzero(np.diff(sorted_values & mask)) + 1
        for part in np.split(sorted_values, cuts):
            if len(part) > 1:
                edges += _spanning(part, max_bits)
    return edges


def _edges_of(variant: np.ndarray, value: np.ndarray, fp: np.ndarray, max_bits: int) -> list[np.ndarray]:
    """Edges from whole groups of rows sorted by variant and value."""
    n = len(fp)
    new = np.ones(n, bool)
    new[1:] = (variant[1:] != variant[:-1]) | (value[1:] != value[:-1])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, n))
    group = np.repeat(np.arange(len(starts)), sizes)
    out = []
    small = sizes <= SMALL_GROUP
    for lag in range(1, int(sizes[small].max(initial=1))):
        i = np.flatnonzero((group[lag:] == group[:-lag]) & small[group[lag:]])
        x = fp[i] ^ fp[i + lag]
        i = i[np.bitwise_count(x) <= max_bits]
        i = i[_canonical(fp[i] ^ fp[i + lag], variant[i], max_bits)]
        out.append(np.stack([fp[i], fp[i + lag]], 1))
    masks = variant_masks(max_bits)
    for g in np.flatnonzero(~small):
        members = fp[starts[g] : starts[g] + sizes[g]]
        free = (1 << BITS) - 1 ^ masks[variant[starts[g]]][2]
        if edges := group_edges(members, free, max_bits):
            out.append(np.array(edges, np.uint64))
    return out


def links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """Edges ``(u, v)`` that connect all distinct fingerprints within ``max_bits`` of each other.

    Every link is found; within a dense group only edges that span it are returned.
    """
    masks = variant_masks(max_bits)
    variants = F.posexplode(F.array(*[F.col("fingerprint").bitwiseAND(_signed(m)) for _, _, m in masks]))
    signatures = distinct.select(variants.alias("variant", "value"), "fingerprint")
    together = signatures.repartition("variant", "value").sortWithinPartitions("variant", "value")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)]
        for part in batches_of(batches, 200_000):
            columns = [c.to_numpy() for c in part.columns]
            rows = [
                np.concatenate([held[0], columns[0].astype(np.int64)]),
                np.concatenate([held[1], columns[1]]),
                np.concatenate([held[2], columns[2].view(np.uint64)]),
            ]
            last = (rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1])
            whole = int(np.argmax(last))  # the last group may go on in the next batch
            held = [r[whole:] for r in rows]
            yield from emit([r[:whole] for r in rows])
        yield from emit(held)

    def emit(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if len(rows[0]) < 2:
            return
        for edges in _edges_of(*rows, max_bits):
            if len(edges):
                columns = [pa.array(np.ascontiguousarray(edges[:, i]).view(np.int64)) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays(columns, ["u", "v"])

    return together.mapInArrow(run, "u bigint, v bigint")


def _classified(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int) -> DataFrame:
    """Every row as ``_id, fingerprint, root, component_id``; root is a fingerprint of the component."""
    named = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_body"))
    rows = stored(fingerprints(named, ["_id"], "_body", shingle), "fingerprints")
    distinct = stored(rows.groupBy("fingerprint").agg(F.min("_id").alias("first_id")), "distinct")
    linked = components(links(distinct.select("fingerprint"), max_bits))
    rooted = distinct.join(linked, distinct["fingerprint"] == linked["node"], "left").select(
        "fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rows.join(rooted.join(least, "root").drop("first_id"), "fingerprint")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4
) -> DataFrame:
    """``id_col``, ``fingerprint`` (bigint) and ``component_id`` for every row of ``docs``.

    ``component_id`` is the least id among all rows whose fingerprints are reached
    through links of at most ``max_bits`` differing bits. NULL and blank texts have the
    fingerprint zero and link like any other. Repeated rows stay repeated; NULL ids
    count as larger than any id (a component of NULL ids only has component NULL). An
    empty table gives an empty result. Other columns of ``docs`` are not looked at.
    """
    return _classified(docs, id_col, text_col, shingle, max_bits).select(
        F.col("_id").alias(id_col), "fingerprint", "component_id"
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4
) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, all columns kept.

    The row with the least id stays (NULL ids come last). Where that id is NULL or
    occurs more than once in the table, the row of the group with that id whose
    columns hash least stays, once.
    """
    classes = stored(_classified(docs, id_col, text_col, shingle, max_bits), "classes")
    ids = classes.groupBy("_id").agg(F.count("*").alias("n"))
    least = classes.groupBy("root").agg(F.min("component_id").alias("_id"))
    firsts = least.join(ids, least["_id"].eqNullSafe(ids["_id"])).select("root", least["_id"], "n")
    firsts = stored(firsts, "firsts")
    plain = firsts.where("n = 1 and _id is not null").select(F.col("_id").alias(id_col))
    # The ids that stay are most of all ids: a plan that sends them everywhere would not last.
    kept = docs.join(plain.hint("merge"), id_col, "left_semi").select(*columns(docs))
    doubtful = firsts.where("n > 1 or _id is null").select(F.col("root").alias("_root"), F.col("_id").alias("_first"))
    if doubtful.isEmpty():
        return kept
    wanted = doubtful.select("_first").distinct()
    body = docs.select(F.struct(*columns(docs)).alias("_row"), F.col(id_col).alias("_id"), F.col(text_col).alias("_body"))
    body = body.join(wanted, body["_id"].eqNullSafe(wanted["_first"]), "left_semi")
    rows = fingerprints(body, ["_row", "_id"], "_body", shingle)
    roots = classes.select("fingerprint", "root").distinct()
    rows = rows.join(roots, "fingerprint")
    rows = rows.join(doubtful, (rows["root"] == doubtful["_root"]) & rows["_id"].eqNullSafe(doubtful["_first"]))
    chosen = rows.groupBy("root").agg(F.min_by("_row", F.xxhash64(F.to_json("_row"))).alias("_row"))
    return kept.unionByName(chosen.select("_row.*"))
