"""Benchmark decontamination by greedy string tiling.

Words are compared without case and punctuation. A seed is the rolling hash of a run of
``least`` words. Documents that share a seed with a benchmark item are matched against it: the
longest unmarked common runs are marked as tiles, again and again. The greatest length that
is left is searched for with rolling (Karp-Rabin) hashes of all unmarked runs of a length, each from
one running sum; runs with equal hashes are compared word code by word code before they are marked. An
item is leaked if the tiles cover enough of it, wherever in the document they lie.
"""

from __future__ import annotations

import re
from collections import defaultdict, deque
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from aeroflow.llm.common import stored, text_of, unused_name

LEAST_MATCH = 5
COVERAGE = 0.8
# A benchmark whose texts are larger than this is joined by shuffles instead.
BROADCAST_BYTES = 16 << 20

_WORD = re.compile(r"\w+")
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def word_codes(words: list[str], known: dict[str, int]) -> np.ndarray:
    """A 64-bit code for each word; ``known`` remembers those already hashed."""
    digest = xxhash.xxh64_intdigest
    out = np.empty(len(words), np.uint64)
    for i, w in enumerate(words):
        code = known.get(w)
        if code is None:
            code = known[w] = digest(w)
        out[i] = code
    return out


def _powers(base: int, n: int) -> np.ndarray:
    """``base`` to the powers 0 to n - 1, modulo 2^64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Runs:
    """Word codes of a text, and the hashes of its runs of any length."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * _powers(_BASE, len(codes)), out=self.sums[1:])
        # Takes a run's sum back to the powers 0, 1, ..., wherever the run begins.
        self.back = _powers(_INVERSE, len(codes))
        self._seeds: dict[int, np.ndarray] = {}

    def __len__(self) -> int:
        return len(self.codes)

    def hashes(self, length: int, starts: np.ndarray) -> np.ndarray:
        h = (self.sums[starts + length] - self.sums[starts]) * self.back[starts]
        return h ^ h >> np.uint64(29)

    def seeds(self, length: int) -> np.ndarray:
        """Hashes of all runs of ``length``, worked out once."""
        if length not in self._seeds:
            self._seeds[length] = self.hashes(length, np.arange(max(len(self) - length + 1, 0)))
        return self._seeds[length]


def run_hashes(codes: np.ndarray, length: int) -> np.ndarray:
    """Polynomial hash of each run of ``length`` words, modulo 2^64."""
    return Runs(codes).seeds(length)


@dataclass(frozen=True)
class Tile:
    item_at: int
    doc_at: int
    length: int


def tiles(item: np.ndarray, doc: np.ndarray, least: int) -> list[Tile]:
    """Greedy string tiling: non-overlapping common runs, the longest first.

    Of runs of one length, the one that begins first in the item, then in the document, goes first.
    Tiles of different lengths do not overlap in the item, so there are at most about sqrt(2 m) lengths
    for an item of m words; each takes some log m passes over the hashes.
    """
    return _tiles(Runs(item), Runs(doc), least)


def _tiles(item: Runs, doc: Runs, least: int) -> list[Tile]:
    item_free, doc_free = np.ones(len(item), bool), np.ones(len(doc), bool)
    out: list[Tile] = []
    length = min(len(item), len(doc)) + 1
    while length := _longest(item, doc, item_free, doc_free, least, length - 1):
        out += _mark(item, doc, item_free, doc_free, length)
    return out


def _longest(item: Runs, doc: Runs, item_free: np.ndarray, doc_free: np.ndarray, least: int, most: int) -> int:
    """The greatest length up to ``most`` of which unmarked runs have equal hashes, 0 if below ``least``.

    A common run of some length has common runs of all smaller lengths in it: no true one is longer.
    """

    def shared(length: int) -> bool:
        a = item.hashes(length, _unmarked_runs(item_free, length))
        return bool(len(a)) and bool(np.isin(doc.hashes(length, _unmarked_runs(doc_free, length)), a).any())

    if most < least or not shared(least):
        return 0
    low, high = least, most
    while low < high:
        middle = (low + high + 1) // 2
        if shared(middle):
            low = middle
        else:
            high = middle - 1
    return low


def _mark(item: Runs, doc: Runs, item_free: np.ndarray, doc_free: np.ndarray, length: int) -> Iterator[Tile]:
    """Marks common runs of ``length``, in the order of the item and then the document."""
    at, bt = _unmarked_runs(item_free, length), _unmarked_runs(doc_free, length)
    item_hashes, doc_hashes = item.hashes(length, at), doc.hashes(length, bt)
    met = np.isin(doc_hashes, item_hashes)
    places: dict[int, deque[int]] = defaultdict(deque)
    for b, h in zip(bt[met].tolist(), doc_hashes[met].tolist(), strict=True):
        places[h].append(b)
    for a, h in zip(at.tolist(), item_hashes.tolist(), strict=True):
        if h not in places or not item_free[a : a + length].all():
            continue
        held = places[h]
        while held and not doc_free[held[0] : held[0] + length].all():
            held.popleft()  # marked for good
        for b in held:
            if doc_free[b : b + length].all() and np.array_equal(item.codes[a : a + length], doc.codes[b : b + length]):
                item_free[a : a + length] = False
                doc_free[b : b + length] = False
                yield Tile(a, b, length)
                break


def _unmarked_runs(free: np.ndarray, length: int) -> np.ndarray:
    """Starts of runs of ``length`` that are wholly unmarked."""
    total = np.concatenate([[0], np.cumsum(free)])
    return np.flatnonzero(total[length:] - total[:-length] == length) if len(free) >= length else np.empty(0, int)


def coverage(item: np.ndarray, doc: np.ndarray, least: int) -> tuple[float, int, int]:
    """Share of the item's words in tiles, number of tiles, longest tile.

    An item with fewer than ``least`` words needs all of them in a row. Parts of the document
    out of reach of any common run are left out before tiling; they cannot be in a tile.
    """
    return _coverage(Runs(item), Runs(doc), least)


def _coverage(item: Runs, doc: Runs, least: int) -> tuple[float, int, int]:
    least = min(least, len(item))
    if not least:
        return 0.0, 0, 0
    common = np.isin(doc.seeds(least), item.seeds(least))
    if not common.any():
        return 0.0, 0, 0
    covered = np.zeros(len(doc) + 1, np.int64)
    starts = np.flatnonzero(common)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + least, -1)
    inside = np.cumsum(covered[:-1]) > 0
    # A gap between kept parts is one word that no item has.
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    short = np.where(inside, doc.codes, np.uint64(0))[keep]
    made = _tiles(item, Runs(short), least)
    marked = sum(t.length for t in made)
    return marked / len(item), len(made), max((t.length for t in made), default=0)


class _Benchmark:
    """Items as word codes, with an index from seed to items."""

    def __init__(self, rows: list[tuple[int, str]], least: int) -> None:
        self.least = least
        self.known: dict[str, int] = {}
        self.items: list[tuple[object, Runs]] = []
        seeds: dict[int, set[int]] = defaultdict(set)
        self.shortest = sorted({min(least, n) for n in (len(words_of(t or "")) for _, t in rows) if n})
        for item_id, text in rows:
            codes = word_codes(words_of(text or ""), self.known)
            if len(codes):
                item = Runs(codes)
                for h in item.seeds(min(least, len(codes))).tolist():
                    seeds[h].add(len(self.items))
                self.items.append((item_id, item))
        self.seed = np.array(sorted(seeds), np.uint64)
        self.of = seeds

    def candidates(self, doc: Runs) -> list[int]:
        """Items that share a seed with the document."""
        out: set[int] = set()
        for n in self.shortest:
            h = doc.seeds(n)
            if len(h) and len(self.seed):
                at = np.minimum(np.searchsorted(self.seed, h), len(self.seed) - 1)
                for x in np.unique(h[self.seed[at] == h]).tolist():
                    out |= self.of[x]
        return sorted(out)


def _shares(bench: _Benchmark, text: str, known: dict[str, int]) -> Iterator[tuple[object, float, int, int]]:
    """Item, coverage, number of tiles and longest tile of each item that shares a seed with the text."""
    doc = Runs(word_codes(words_of(text), known))
    for i in bench.candidates(doc):
        item_id, item = bench.items[i]
        yield item_id, *_coverage(item, doc, bench.least)


_PAIR = "item_id {kind}, coverage double, n_tiles int, longest int"


def leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text: str = "text", least: int = LEAST_MATCH, threshold: float = COVERAGE, broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``id_col, item_id, coverage, n_tiles, longest`` for each document and benchmark item it leaks.

    ``coverage`` is the share of the item's words in tiles of ``least`` words or more; pairs of
    ``threshold`` or more are returned. NULL and blank texts and items match nothing; an item
    with fewer than ``least`` words must occur as a whole. Repeated rows give repeated pairs. Ids may
    have any atomic type. Empty tables give an empty result. Other columns are not looked at. Benchmarks up to
    ``broadcast_bytes`` of text go to every task; larger ones are joined on seeds.
    """
    items = benchmark.select(F.col(item_col).alias("item_id"), text_of(item_text).alias("item_text"))
    rows = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    size = items.agg(F.sum(F.octet_length("item_text") + 16)).first()[0] or 0
    if size <= broadcast_bytes:
        found = _by_broadcast(rows, items, least, threshold)
    else:
        found = _by_join(rows, items, least, threshold)
    return found.select(F.col("_id").alias(id_col), "item_id", "coverage", "n_tiles", "longest")


def _pairs_schema(rows: DataFrame, items: DataFrame) -> str:
    kinds = dict(rows.dtypes) | dict(items.dtypes)
    return f"_id {kinds['_id']}, " + _PAIR.format(kind=kinds["item_id"])


def _to_batch(found: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _arrow_schema(id_type: pa.DataType, item_type: pa.DataType) -> pa.Schema:
    return pa.schema([("_id", id_type), ("item_id", item_type), ("coverage", pa.float64()), ("n_tiles", pa.int32()), ("longest", pa.int32())])


def _by_broadcast(rows: DataFrame, items: DataFrame, least: int, threshold: float) -> DataFrame:
    held = rows.sparkSession.sparkContext.broadcast([tuple(r) for r in items.collect()])
    item_type = to_arrow_type(items.schema["item_id"].dataType)
    schema = _pairs_schema(rows, items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench = _Benchmark(held.value, least)
        for batch in batches:
            found = []
            known = dict(bench.known)
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found += [(doc_id, *pair) for pair in _shares(bench, text.as_py(), known) if pair[1] >= threshold]
            yield _to_batch(found, _arrow_schema(batch.schema.field(0).type, item_type))

    return rows.mapInArrow(run, schema)


def _seeds(frame: DataFrame, keys: str, least: int, lengths: Callable[[int], Iterable[int]], distinct: bool) -> DataFrame:
    """``key, seed`` for the runs of each text that have one of the ``lengths`` for its number of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, seeds, known = [], [], {}
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                doc = Runs(word_codes(words_of(text.as_py()), known))
                h = np.concatenate([doc.seeds(n) for n in lengths(len(doc)) if n] or [np.empty(0, np.uint64)])
                h = np.unique(h) if distinct else h
                ids += [key] * len(h)
                seeds.append(h)
            both = np.concatenate(seeds) if seeds else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(both.view(np.int64))], ["key", "seed"])

    return frame.mapInArrow(run, "key bigint, seed bigint").withColumnRenamed("key", keys)


def _rarest_seeds(item_seeds: DataFrame, least: int, threshold: float) -> DataFrame:
    """Of each item's places, enough that a document which leaks it has the seed of one of them.

    A tile of t words holds at least t / ``least`` seeds, so a leak shares some number of
    the item's places at least; all but that number less one are looked for, those whose seeds
    are in the fewest items. A passage that many items have in common so makes no pairs by itself.
    """
    per_item = Window.partitionBy("_item")  # as many rows as the item has words
    used = item_seeds.groupBy("seed").agg(F.count_distinct("_item").alias("items"))
    ranked = item_seeds.join(used, "seed").select(
        "_item", "seed", F.count("*").over(per_item).alias("places"),
        F.row_number().over(per_item.orderBy("items", "seed")).alias("rank"),
    )
    needed = F.greatest(F.lit(1), F.ceil((F.col("places") + least - 1) * threshold / least - 1e-9))
    return ranked.where(F.col("rank") <= F.col("places") - needed + 1).select("_item", "seed").distinct()


def _by_join(rows: DataFrame, items: DataFrame, least: int, threshold: float) -> DataFrame:
    """The same for a benchmark of any size: seeds are joined, then texts of candidate pairs.

    Documents are told apart by a number, as their ids may repeat; it is stored with
    them, so that it stays the same. Items with few words are looked for under runs of
    their own length, in documents as well, if there are such items.
    """
    numbered = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    item_rows = stored(items.withColumn("_item", F.monotonically_increasing_id()), "items")
    places = _seeds(item_rows.select("_item", "item_text"), "_item", least, lambda n: [min(least, n)], False)
    item_seeds = stored(_rarest_seeds(stored(places, "places"), least, threshold), "seeds")
    few = item_rows.where(F.regexp_count("item_text", F.lit(r"(?U)\w+")) < least).limit(1).count() > 0
    lengths = range(1, least + 1) if few else [least]
    doc_seeds = _seeds(numbered.select("_row", "_text"), "_row", least, lambda n: lengths, True)
    pairs = doc_seeds.join(item_seeds, "seed").select("_row", "_item").distinct()
    both = numbered.join(pairs, "_row").join(item_rows, "_item").select("_id", "_text", "item_id", "item_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, known = [], {}
            for doc_id, text, item_id, item_text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                item = word_codes(words_of(item_text), known)
                share, n, longest = coverage(item, word_codes(words_of(text), known), least)
                if share >= threshold:
                    found.append((doc_id, item_id, share, n, longest))
            yield _to_batch(found, _arrow_schema(batch.schema.field(0).type, batch.schema.field(2).type))

    return both.mapInArrow(run, _pairs_schema(rows, items))


def clean(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_text: str = "text",
    least: int = LEAST_MATCH, threshold: float = COVERAGE, broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows of ``docs`` that leak no benchmark item, all columns kept.

    A row's text alone decides; NULL and blank texts stay. With a benchmark small enough for every task
    this is one pass without any join; otherwise leaking texts are found first and joined by digest.
    """
    items = benchmark.select(F.monotonically_increasing_id().alias("item_id"), text_of(item_text).alias("item_text"))
    size = items.agg(F.sum(F.octet_length("item_text") + 16)).first()[0] or 0
    if size > broadcast_bytes:
        text, mark = F.sha2(text_of(text_col), 256), unused_name("_digest", docs.columns)
        texts = docs.select(text.alias("_id"), text_of(text_col).alias("_text"))
        leaked = stored(_by_join(texts, items, least, threshold), "leaked")
        return docs.join(leaked.select(F.col("_id").alias(mark)).distinct(), text == F.col(mark), "left_anti")
    body = unused_name("_body", docs.columns)
    held = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in items.collect()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench = _Benchmark(held.value, least)
        for batch in batches:
            known = dict(bench.known)
            texts = batch.column(batch.num_columns - 1)
            keep = [not any(share >= threshold for _, share, _, _ in _shares(bench, t.as_py(), known)) for t in texts]
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays(kept.columns[:-1], kept.schema.names[:-1])

    return docs.withColumn(body, text_of(text_col)).mapInArrow(run, docs.schema)
