"""Repeated windows of a corpus, found by anchors and exchanged in packed blocks.

A window is a run of ``window`` units (bytes or words) of one document. Of the
shorter runs of ``gram`` units inside it, the one with the least hash is its anchor.
Equal windows have equal anchors at equal places, so only windows whose anchor occurs
again need a closer look: most of a corpus never leaves its task.

Documents are packed into chunks, stored once. A chunk sends each bucket of the hash space
one sorted block of its distinct hashes, and gets back one block with a flag for each.
A block holds a hash once, however often the chunk has it, so that a passage with
copies in every document is a few rows for each chunk, not a group of its own.

Where windows are told apart by their hashes, what follows from it is compared in full: the
units of each repeated span are sent to the chunk it names as source. If any differ, the
exchange is made again with other hash functions.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroflow.llm.common import stored, text_of
from aeroflow.session import fresh_dir

CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 128 << 20  # of text for each bucket of the hash space
BLOCK = 1 << 18  # windows that are looked at together
_PLACE_BITS = 22  # for places within a block and the longest window
LAST_ID = np.iinfo(np.int64).max  # stands for NULL, which comes last

CHUNK_SCHEMA = "chunk bigint, ids binary, ends binary, text binary"

_rng = np.random.default_rng(20_11)
# Bits of a window's hash in each attempt; every attempt has two hash functions of its own.
ATTEMPTS = (96, 96, 96)
_VALUES = _rng.integers(0, 1 << 64, (2 * len(ATTEMPTS), 256), dtype=np.uint64) | np.uint64(1)
_BASES = _rng.integers(0, 1 << 61, 2 * len(ATTEMPTS), dtype=np.uint64) * np.uint64(8) + np.uint64(5)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ h >> np.uint64(32)
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return h ^ h >> np.uint64(29)


class RangeHash:
    """Hash of any range of units from running sums, modulo 2^64.

    The sum of value(unit) * base^place over a range, divided by base^start, depends on the
    range's units only. (The base is odd and has an inverse.) Such sums collide for some regular
    ranges of 1,024 units and more, so ranges must be short and units well hashed.
    """

    def __init__(self, values: np.ndarray, which: int = 0) -> None:
        base = _BASES[which]
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * _powers(base, len(values)), out=self.sums[1:])
        self.back = _powers(inverse, len(values) + 1)

    def __call__(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        length = (stop - start).astype(np.uint64)
        return mixed((self.sums[stop] - self.sums[start]) * self.back[start] + length)

    def runs(self, length: int) -> np.ndarray:
        """Hashes of the ranges of one length, from every place."""
        return mixed((self.sums[length:] - self.sums[:-length]) * self.back[:-length] + np.uint64(length))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of ``width``, by doubling."""
    have, out = 1, x
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


@dataclass(frozen=True)
class Shape:
    """Length of windows and of the runs their anchors are chosen from, in units."""

    window: int
    gram: int

    @property
    def choices(self) -> int:
        return self.window - self.gram + 1

    @property
    def piece(self) -> int:
        """Length in which repeated spans are compared; none is shorter than a window."""
        return max(1, self.window * 4 // 5)


@dataclass
class Units:
    """The units of a chunk: ``starts`` and ``stops`` of each in ``text``; documents end at ``ends`` (in units).

    For bytes, ``starts`` is None: unit i is byte i.
    """

    text: np.ndarray
    ids: np.ndarray
    ends: np.ndarray
    starts: np.ndarray | None = None
    stops: np.ndarray | None = None

    def values(self, first: int, last: int, which: int = 0) -> np.ndarray:
        """A hash of each unit from ``first`` to ``last`` (exclusive), by one of the functions.

        A word's is the sum of a mixed value for each byte and its place in the word, so that words
        whose bytes are merely exchanged, in whatever pattern, differ.
        """
        if self.starts is None or self.stops is None:
            return _VALUES[which][self.text[first:last]]
        if last <= first:
            return np.empty(0, np.uint64)
        starts, stops = self.starts[first:last], self.stops[first:last]
        base, end = int(starts[0]), int(stops[-1])
        places = np.arange(base, end) - np.repeat(starts, np.diff(starts, append=end))
        byte = self.text[base:end].astype(np.uint64) | places.astype(np.uint64) << np.uint64(8)
        sums = np.zeros(end - base + 1, np.uint64)
        np.cumsum(mixed(mixed(byte + _VALUES[which][0]) ^ _VALUES[which][1]), out=sums[1:])
        return mixed(sums[stops - base] - sums[starts - base] + (stops - starts).astype(np.uint64))

    def __len__(self) -> int:
        return int(self.ends[-1]) if len(self.ends) else 0

    @property
    def begins(self) -> np.ndarray:
        return np.concatenate([[0], self.ends[:-1]]) if len(self.ends) else np.empty(0, np.int64)

    def span(self, raw: bytes, first: int, stop: int) -> bytes:
        """The bytes from unit ``first`` to ``stop`` (exclusive, not empty) of one document."""
        if self.starts is None or self.stops is None:
            return raw[first:stop]
        return raw[self.starts[first] : self.stops[stop - 1]]


@dataclass
class Anchors:
    """Runs of windows with one anchor: ``first``..``last`` window, place and hash of the anchor, document."""

    place: np.ndarray
    first: np.ndarray
    last: np.ndarray
    hash: np.ndarray
    doc: np.ndarray


def anchors(units: Units, shape: Shape) -> Anchors:
    """The anchors of all windows of a chunk, block by block."""
    parts: list[list[np.ndarray]] = [[] for _ in range(5)]
    n = len(units)
    for at in range(0, max(0, n - shape.window + 1), BLOCK):
        stop = min(n - shape.window + 1, at + BLOCK)
        h = RangeHash(units.values(at, stop + shape.window - 1)).runs(shape.gram)
        low = np.uint64((1 << _PLACE_BITS) - 1)
        least = sliding_min(h & ~low | np.arange(len(h), dtype=np.uint64), shape.choices)
        place = at + (least & low).astype(np.int64)
        window = np.arange(at, stop)
        low_doc, high_doc = np.searchsorted(units.ends, [at, stop - 1], side="right")
        ends = units.ends[low_doc : high_doc + 1]
        held = np.diff(np.minimum(ends, stop), prepend=at)
        doc = np.repeat(np.arange(low_doc, high_doc + 1), held)
        inside = window + shape.window <= np.repeat(ends, held)
        window, place, doc = window[inside], place[inside], doc[inside]
        if not len(window):
            continue
        new = np.ones(len(window), bool)
        new[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(window)) - 1
        for part, value in zip(parts, (place[first], window[first], window[last], h[place[first] - at], doc[first]), strict=True):
            part.append(value)
    return Anchors(*(np.concatenate(p) if p else np.empty(0, np.uint64 if i == 3 else np.int64) for i, p in enumerate(parts)))


def pack(value: np.ndarray | bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(bytes(value) if isinstance(value, bytes) else value.tobytes())


def unpack(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


@dataclass
class Chunks:
    """Packed documents in a table that is bucketed by chunk, so that joins leave it where it is."""

    rows: DataFrame
    buckets: int
    spark: SparkSession

    @classmethod
    def of(cls, docs: DataFrame, id_col: str, text_col: str, joined: bool) -> Chunks:
        """``joined`` texts have their words joined by single spaces."""
        spark, limit = docs.sparkSession, CHUNK_BYTES
        rows = docs.select(F.col(id_col).cast("bigint").alias("id"), text_of(text_col).cast("binary").alias("text"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            task = TaskContext.get().partitionId() << 32
            made, ids, texts, size = 0, [], [], 0

            def chunk() -> pa.RecordBatch:
                order = sorted(range(len(ids)), key=ids.__getitem__)
                ordered = [texts[i] for i in order]
                ends = np.cumsum([len(t) for t in ordered], dtype=np.int64)
                row = [task + made], [np.array([ids[i] for i in order], np.int64).tobytes()], [ends.tobytes()], [pack(b"".join(ordered))]
                kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
                return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds, strict=True)], ["chunk", "ids", "ends", "text"])

            for batch in batches:
                for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    text = text.as_py()
                    ids.append(LAST_ID if key is None else key)
                    texts.append(b" ".join(text.split()) if joined else text)
                    size += len(texts[-1])
                    if size >= limit:
                        yield chunk()
                        made, ids, texts, size = made + 1, [], [], 0
            if ids:
                yield chunk()

        name = f"llm_chunks_{uuid.uuid4().hex}"
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        writer = rows.mapInArrow(run, CHUNK_SCHEMA).write.format("parquet").option("path", fresh_dir(spark, "llm-chunks"))
        writer.bucketBy(parts, "chunk").saveAsTable(name)
        chunks = spark.table(name)
        # The frame knows folder and buckets by now; the files stay, as the folder was given.
        spark.sql(f"drop table {name}")
        size = chunks.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        return cls(chunks, max(parts, -(-3 * size // BUCKET_BYTES)), spark)

    def send(self, blocks: Callable[..., Iterator[tuple[int, int, bytes]]], *answers: DataFrame) -> DataFrame:
        """``(bucket, chunk, n, block)`` from each chunk and its answers so far."""
        buckets, n_answers = self.buckets, len(answers)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    got = [row[f"answer{i}"] for i in range(n_answers)]
                    for bucket, n, block in blocks(row, buckets, *map(_by_bucket, got)):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([bucket], pa.int32()), pa.array([row["chunk"]], pa.int64()), pa.array([n], pa.int64()), pa.array([block], pa.binary())],
                            ["bucket", "chunk", "n", "block"],
                        )

        return self.with_answers(*answers).mapInArrow(run, "bucket int, chunk bigint, n bigint, block binary")

    def with_answers(self, *answers: DataFrame) -> DataFrame:
        out = self.rows
        for i, answer in enumerate(answers):
            out = out.join(answer.withColumnRenamed("answer", f"answer{i}"), "chunk", "left")
        return out


def answered(sent: DataFrame, resolve: Callable[[list[int], list[int], list[bytes]], list[bytes]], name: str) -> DataFrame:
    """``(chunk, answer)``: what ``resolve`` says of each block, from all blocks of its bucket together.

    ``resolve`` gets chunk ids, numbers of entries and blocks, in the order of chunk ids. Its
    answers are stored, as later steps must see the same ones.
    """

    def run(part: pa.Table) -> pa.Table:
        part = part.sort_by("chunk")
        back = resolve(part.column("chunk").to_pylist(), part.column("n").to_pylist(), part.column("block").to_pylist())
        return pa.table({"chunk": part.column("chunk"), "bucket": part.column("bucket"), "flags": pa.array(back, pa.binary())})

    answers = sent.groupBy("bucket").applyInArrow(run, "chunk bigint, bucket int, flags binary")
    listed = answers.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "flags")).alias("answer"))
    return stored(listed, name)


def _by_bucket(answer: list | None) -> dict[int, bytes]:
    return {a["bucket"]: a["flags"] for a in answer or ()}


def split(hashes: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Bucket and indexes of sorted distinct hashes; a bucket's indexes stay in order."""
    bucket = (hashes % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int(bucket[part[0]]), part


def joined_flags(hashes: np.ndarray, buckets: int, answers: dict[int, bytes], bits: int = 1) -> np.ndarray:
    """Flags of all hashes, from the answers to the blocks that ``split`` makes: ``bits`` for each hash."""
    out = np.zeros((len(hashes), bits), bool)
    for bucket, part in split(hashes, buckets):
        flags = np.unpackbits(np.frombuffer(answers[bucket], np.uint8), count=bits * len(part))
        out[part] = flags.reshape(bits, -1).T.astype(bool)
    return out


# First step: which anchors occur again.

_KEPT = 5  # bytes of a hash that tell anchors of a bucket apart; a mix-up only costs time


def anchor_blocks(hashes: np.ndarray, buckets: int) -> Iterator[tuple[int, int, bytes]]:
    for bucket, part in split(hashes, buckets):
        top = (hashes[part] >> np.uint64(64 - 8 * _KEPT)).view(np.uint8).reshape(-1, 8)[:, :_KEPT]
        yield bucket, len(part), np.ascontiguousarray(top).tobytes()


def repeated_anchors(hot: int) -> Callable[[list[int], list[int], list[bytes]], list[bytes]]:
    """Two flags for each hash: it is in several chunks; it is in more than ``hot``."""

    def resolve(_: list[int], counts: list[int], blocks: list[bytes]) -> list[bytes]:
        tops = []
        for n, block in zip(counts, blocks, strict=True):
            wide = np.zeros((n, 8), np.uint8)
            wide[:, :_KEPT] = np.frombuffer(block, np.uint8).reshape(n, _KEPT)
            tops.append(wide.view(np.uint64).ravel())
        # Two hashes of one chunk may have the same kept bytes: then they count twice.
        values, times = np.unique(np.concatenate(tops), return_counts=True)
        values, times = values[times > 1], times[times > 1]
        out = []
        for top in tops:
            at = np.minimum(np.searchsorted(values, top), max(len(values) - 1, 0))
            met = values[at] == top if len(values) else np.zeros(len(top), bool)
            often = met & (times[at] > hot) if len(values) else met
            out.append(np.packbits(np.concatenate([met, often])).tobytes())
        return out

    return resolve


# Second step for single windows: which of them start earlier elsewhere.

ENTRY = np.dtype([("low", "<u4"), ("id", "<i8"), ("at", "<u4")])


@dataclass
class Windows:
    """Windows of a chunk by hash: ``first`` has one of each, the earliest, sorted by hash."""

    start: np.ndarray  # of all windows looked at, in units
    doc: np.ndarray
    offset: np.ndarray  # within the document
    group: np.ndarray  # index into the distinct hashes
    first: np.ndarray  # index of the earliest window of each group
    high: np.ndarray  # hash of each group
    low: np.ndarray

    @classmethod
    def of(cls, units: Units, starts: np.ndarray, docs: np.ndarray, window: int, attempt: int = 0, bits: int = ATTEMPTS[0]) -> Windows:
        """``starts`` in the order of documents and places, which is that of ids within a chunk."""
        high, low = (np.empty(len(starts), np.uint64) for _ in range(2))
        for at in range(0, len(starts), BLOCK):
            part = starts[at : at + BLOCK]
            base, end = int(part.min()), int(part.max()) + window
            for which, out in enumerate((high, low), 2 * attempt):
                out[at : at + BLOCK] = RangeHash(units.values(base, end, which), which)(part - base, part - base + window)
        high >>= np.uint64(max(0, 64 - bits))
        low = (low & np.uint64((1 << max(0, bits - 64)) - 1)).astype(np.uint32)
        order = np.lexsort((low, high))  # stable: earlier windows first
        new = np.ones(len(order), bool)
        new[1:] = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
        first = order[new]
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(new) - 1
        return cls(starts, docs, starts - units.begins[docs], group, first, high[first], low[first])

    def blocks(self, units: Units, buckets: int) -> Iterator[tuple[int, int, bytes]]:
        for bucket, part in split(self.high, buckets):
            entries = np.empty(len(part), ENTRY)
            entries["low"] = self.low[part]
            entries["id"] = units.ids[self.doc[self.first[part]]]
            entries["at"] = self.offset[self.first[part]]
            yield bucket, len(part), self.high[part].tobytes() + pack(entries)

    def spans(self, units: Units, window: int, chunk: int, buckets: int, answers: dict[int, bytes]) -> np.ndarray:
        """Windows that start earlier, strung together where their earliest starts follow each other."""
        earlier = np.zeros(len(self.first), bool)
        ids = units.ids[self.doc[self.first]]
        at = self.offset[self.first].copy()
        chunks = np.full(len(self.first), chunk)
        for bucket, part in split(self.high, buckets):
            raw = unpack(answers[bucket])
            flags = np.unpackbits(np.frombuffer(raw, np.uint8, -(-len(part) // 8)), count=len(part)).astype(bool)
            given = np.frombuffer(raw[-(-len(part) // 8) :], SOURCE)
            found = part[flags]
            earlier[found] = True
            ids[found], at[found], chunks[found] = given["id"], given["at"], given["chunk"]
        own = self.first[self.group] == np.arange(len(self.start))
        found = np.flatnonzero(earlier[self.group] | ~own)
        group = self.group[found]
        start, doc, ids, at, chunks = self.start[found], self.doc[found], ids[group], at[group], chunks[group]
        new = np.ones(len(found), bool)
        new[1:] = (
            (start[1:] != start[:-1] + 1) | (doc[1:] != doc[:-1]) | (ids[1:] != ids[:-1])
            | (chunks[1:] != chunks[:-1]) | (at[1:] != at[:-1] + 1)
        )
        first = np.flatnonzero(new)
        out = np.empty(len(first), SPAN)
        out["doc"], out["start"], out["id"], out["at"], out["chunk"] = doc[first], start[first], ids[first], at[first], chunks[first]
        out["stop"] = start[np.append(first, len(found))[1:] - 1] + window
        return out


SOURCE = np.dtype([("id", "<i8"), ("at", "<u4"), ("chunk", "<i8")])
# Units ``start`` to ``stop`` of a chunk, in its document ``doc``, also stand at ``at`` of document ``id`` of ``chunk``.
SPAN = np.dtype([("doc", "<i8"), ("start", "<i8"), ("stop", "<i8"), ("id", "<i8"), ("at", "<i8"), ("chunk", "<i8")])


def earliest_windows(chunks: list[int], counts: list[int], blocks: list[bytes]) -> list[bytes]:
    """For each entry whether another chunk has it earlier, and for these the earliest source.

    Entries of one id in several chunks (repeated ids) are in the order of chunks.
    """
    high = np.concatenate([np.frombuffer(b, np.uint64, n) for n, b in zip(counts, blocks, strict=True)])
    entries = np.concatenate([np.frombuffer(unpack(b[8 * n :]), ENTRY) for n, b in zip(counts, blocks, strict=True)])
    of = np.repeat(np.arange(len(chunks)), counts)
    order = np.lexsort((of, entries["id"], entries["low"], high))
    new = np.ones(len(order), bool)
    h, low = high[order], entries["low"][order]
    new[1:] = (h[1:] != h[:-1]) | (low[1:] != low[:-1])
    first = np.empty(len(order), np.int64)
    first[order] = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    named = np.array(chunks, np.int64)
    out, at = [], 0
    for n in counts:
        source = first[at : at + n]
        found = source != np.arange(at, at + n)
        given = np.empty(int(found.sum()), SOURCE)
        given["id"], given["at"] = entries["id"][source[found]], entries["at"][source[found]]
        given["chunk"] = named[of[source[found]]]
        out.append(pack(np.packbits(found).tobytes() + given.tobytes()))
        at += n
    return out


# Third step: spans are compared with their sources, unit by unit.

_FOUND = "chunk bigint, spans binary, wanted array<struct<chunk: bigint, id: bigint, at: bigint, units: binary>>"
_WANTED = pa.list_(pa.struct([("chunk", pa.int64()), ("id", pa.int64()), ("at", pa.int64()), ("units", pa.binary())]))


def _wanted(units: Units, spans: np.ndarray, piece: int) -> list[dict]:
    """The spans in pieces of one length, each with the place where its source has it.

    Pieces begin where the span does, at fixed places of the source, and where the span's last piece must. However
    many spans have one source, at most as many different pieces are asked of it as it has units.
    """
    at, last = spans["at"], spans["at"] + (spans["stop"] - spans["start"]) - piece
    low = at // piece + 1
    inside = np.maximum((last - 1) // piece - low + 1, 0)
    every = np.arange(len(spans))
    middle = np.repeat(every, inside)
    step = np.arange(len(middle)) - np.repeat(np.cumsum(inside) - inside, inside)
    of = np.concatenate([every, middle, every])
    source = np.concatenate([at, (low[middle] + step) * piece, last])
    place = spans["start"][of] + source - at[of]
    raw = units.text.tobytes()
    pieces = (
        (chunk, key, where, units.span(raw, own, own + piece))
        for chunk, key, where, own in zip(spans["chunk"][of].tolist(), spans["id"][of].tolist(), source.tolist(), place.tolist(), strict=True)
    )
    return [dict(zip(("chunk", "id", "at", "units"), p, strict=True)) for p in set(pieces)]


def _missing(units: Units, asked: list[dict], piece: int) -> int:
    """How many of the pieces asked for are not there. One of several documents with an id is enough."""
    raw, begins = units.text.tobytes(), units.begins
    lengths = units.ends - begins
    known: dict[tuple[int, int], set[bytes]] = {}
    missing = 0
    for want in asked:
        key = want["id"], want["at"]
        if key not in known:
            low, high = np.searchsorted(units.ids, key[0], "left"), np.searchsorted(units.ids, key[0], "right")
            long = low + np.flatnonzero(lengths[low:high] >= key[1] + piece)
            known[key] = {units.span(raw, b + key[1], b + key[1] + piece) for b in begins[long].tolist()}
        missing += want["units"] not in known[key]
    return missing


def settled(
    chunks: Chunks, units_of: Callable[[dict], Units], parse: Callable[..., tuple[np.ndarray, np.ndarray]],
    piece: int, *answers: DataFrame,
) -> DataFrame | None:
    """``(chunk, answer)``: packed spans of each chunk, or None if some are not what their sources have.

    ``parse`` gives, of a chunk's row, its units and its answers, the spans that rest on hashes alone, which are compared,
    and starts and stops of others. ``answer`` has starts and stops of all. Equal pieces are
    merged before they are sent to the chunks.
    """
    n_answers = len(answers)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                units = units_of(row)
                spans, sure = parse(row, units, *(_by_bucket(row[f"answer{i}"]) for i in range(n_answers)))
                columns = [
                    pa.array([row["chunk"]], pa.int64()), pa.array([pack(np.concatenate([spans, sure]))], pa.binary()),
                    pa.array([_wanted(units, spans, piece)], _WANTED),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["chunk", "spans", "wanted"])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                missing = _missing(units_of(row), row["asked"], piece)
                yield pa.RecordBatch.from_arrays([pa.array([missing], pa.int64())], ["missing"])

    found = stored(chunks.with_answers(*answers).mapInArrow(find, _FOUND), "spans")
    wanted = found.select(F.explode("wanted").alias("w")).select("w.*").distinct()
    asked = wanted.groupBy("chunk").agg(F.collect_list(F.struct("id", "at", "units")).alias("asked"))
    missing = chunks.rows.join(asked, "chunk").mapInArrow(look, "missing bigint").agg(F.sum("missing")).first()[0]
    return None if missing else found.select("chunk", F.col("spans").alias("answer"))


def spans_of(answer: bytes) -> np.ndarray:
    return np.frombuffer(unpack(answer), SPAN)


def covered(n: int, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Which of n units lie in one of the spans."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, stops, -1)
    return np.cumsum(change[:-1]) > 0
