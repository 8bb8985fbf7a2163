"""Repeated byte strings by a distributed merge sort of suffixes.

Suffixes are sorted where they may matter: at anchors (see ``repeats``) that occur more
than once. Each chunk sorts its suffixes, as far as windows reach, and sends them as front-coded runs.
The receiving task merges the runs of a bucket with a loser tree that keeps common
prefixes and never compares them again, and so has the common prefix of each suffix with
the next. Two windows around an anchor are equal if the suffixes from the anchor share
enough bytes to the right, and the strings before it, sorted alike, enough to the left.

An anchor that is in very many chunks would make a group that grows with the corpus.
The windows around such anchors are sent one by one, by their own hashes instead, and what is found
so is then compared with its source byte by byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from aeroflow.llm import lcp_merge, repeats
from aeroflow.llm.repeats import ATTEMPTS, LAST_ID, SPAN, Anchors, Chunks, Shape, Units, Windows

WINDOW = 100
HOT_CHUNKS = 2_000
SLICE = 200_000  # suffixes that are resolved together
_NONE = 255


def shape_of(window: int) -> Shape:
    if not 1 < window < _NONE:
        raise ValueError("a window has 2 to 254 bytes")
    return Shape(window, max(1, window * 2 // 5))


def bytes_of(row: dict) -> Units:
    text = np.frombuffer(repeats.unpack(row["text"]), np.uint8)
    return Units(text, np.frombuffer(row["ids"], np.int64), np.frombuffer(row["ends"], np.int64))


def _words(rows: np.ndarray) -> list[np.ndarray]:
    """The columns of rows of bytes as big-endian numbers, eight bytes each, the last first."""
    padded = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    padded[:, : rows.shape[1]] = rows
    return list(padded.view(">u8").astype(np.uint64).T[::-1])


def _around(text: np.ndarray, place: np.ndarray, length: np.ndarray, width: int, step: int) -> np.ndarray:
    """``length`` bytes from each place on, forwards, or backwards from the byte before; padded with zeros."""
    offset = np.arange(width)
    at = place[:, None] + offset if step > 0 else place[:, None] - 1 - offset
    out = text[np.clip(at, 0, len(text) - 1)]
    out[offset >= length[:, None]] = 0
    return out


@dataclass
class Suffixes:
    """Anchored suffixes of a chunk, sorted; ``first`` are those that differ from the one before."""

    place: np.ndarray
    doc: np.ndarray
    right: np.ndarray
    left: np.ndarray
    right_length: np.ndarray  # also says how near to the anchor the last window starts
    left_length: np.ndarray  # distance of the first window
    hash: np.ndarray
    first: np.ndarray
    group: np.ndarray  # index into the first ones

    @classmethod
    def of(cls, units: Units, found: Anchors, shape: Shape) -> Suffixes:
        width, reach = shape.window, shape.choices - 1
        right_length, left_length = found.last + width - found.place, found.place - found.first
        if not len(found.place):
            empty = np.empty(0, np.int64)
            return cls(empty, empty, np.empty((0, width), np.uint8), np.empty((0, reach), np.uint8), empty, empty, np.empty(0, np.uint64), np.empty(0, bool), empty)
        right = _around(units.text, found.place, right_length, width, 1)
        left = _around(units.text, found.place, left_length, reach, -1)
        # Earlier places first among equals.
        order = np.lexsort((found.place, left_length, *(_words(left) if reach else ()), right_length, *_words(right)))
        right, left, right_length, left_length = right[order], left[order], right_length[order], left_length[order]
        new = np.ones(len(order), bool)
        new[1:] = (
            (right[1:] != right[:-1]).any(1) | (left[1:] != left[:-1]).any(1)
            | (right_length[1:] != right_length[:-1]) | (left_length[1:] != left_length[:-1])
        )
        return cls(found.place[order], found.doc[order], right, left, right_length, left_length, found.hash[order], new, np.cumsum(new) - 1)

    def parts(self, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
        """Bucket and indexes of the distinct suffixes in it, in order."""
        sent = np.flatnonzero(self.first)
        bucket = (self.hash[sent] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        for part in np.split(order, cuts):
            if len(part):
                yield int(bucket[part[0]]), sent[part]

    def blocks(self, units: Units, buckets: int) -> Iterator[tuple[int, int, bytes]]:
        for bucket, part in self.parts(buckets):
            lcp, tail = lcp_merge.front_coded(self.right[part], self.right_length[part])
            before = self.left[part][np.arange(self.left.shape[1]) < self.left_length[part][:, None]]
            columns = (
                lcp, self.right_length[part].astype(np.uint8), self.left_length[part].astype(np.uint8),
                units.ids[self.doc[part]], self.place[part].astype(np.uint32), np.array([len(tail)], np.int64), tail, before,
            )
            yield bucket, len(part), b"S" + repeats.pack(b"".join(c.tobytes() for c in columns))

    def spans(self, buckets: int, answers: dict[int, bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
        """Repeated bytes around each anchor as starts and stops, from the answers and from copies within the chunk."""
        near, far = (np.full(len(self.place), _NONE, np.uint8) for _ in range(2))
        for bucket, part in self.parts(buckets):
            given = np.frombuffer(repeats.unpack(answers[bucket]), np.uint8).reshape(2, len(part))
            near[part], far[part] = given
        copy = ~self.first
        near[copy] = window - self.right_length[copy]
        far[copy] = self.left_length[copy]
        found = far != _NONE
        return self.place[found] - far[found], self.place[found] - near[found].astype(np.int64) + window


@dataclass
class _Run:
    lcp: np.ndarray
    right_length: np.ndarray
    left_length: np.ndarray
    ids: np.ndarray
    place: np.ndarray
    tail: bytes
    before: np.ndarray

    @classmethod
    def of(cls, n: int, block: bytes) -> _Run:
        raw = repeats.unpack(block[1:])
        at = 0

        def take(kind: type, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, count, at)
            at += out.nbytes
            return out

        lcp, right_length, left_length = (take(np.uint8, n) for _ in range(3))
        ids, place, size = take(np.int64, n), take(np.uint32, n), int(take(np.int64, 1)[0])
        tail = raw[at : at + size]
        return cls(lcp, right_length, left_length, ids, place, tail, np.frombuffer(raw, np.uint8, -1, at + size))


def _padded(lengths: np.ndarray, flat: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(lengths), width), np.uint8)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _resolved(lcp: np.ndarray, gram: np.ndarray, rank: np.ndarray, right_length: np.ndarray, left: np.ndarray, left_length: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Nearest and farthest window start before each anchor that also starts earlier.

    Suffixes are in order; ``lcp`` is their common prefix with the one before, ``gram`` numbers those with
    one anchor, ``rank`` is the order of documents and places.
    """
    n = len(lcp)
    near, far = np.full(n, _NONE, np.uint8), np.full(n, _NONE, np.uint8)
    order = np.lexsort((left_length, *(_words(left) if left.shape[1] else ()), gram))
    left_lcp = lcp_merge.neighbour_prefix(left[order], left_length[order])
    apart = np.ones(n, bool)
    apart[1:] = gram[order][1:] != gram[order][:-1]
    first_gap = window - right_length
    for d in range(int(left_length.max(initial=0)) + 1):
        right_class = np.cumsum(lcp < window - d)
        left_class = np.empty(n, np.int64)
        left_class[order] = np.cumsum(apart | (left_lcp < d))
        has = np.flatnonzero((first_gap <= d) & (d <= left_length))
        pair = np.unique(right_class[has] * (n + 1) + left_class[has], return_inverse=True)[1]
        by = np.sort(pair * (n + 1) + rank[has])
        later = by[1:][by[1:] // (n + 1) == by[:-1] // (n + 1)] % (n + 1)
        where = np.empty(n, np.int64)
        where[rank[has]] = has
        found = where[later]
        near[found] = np.minimum(near[found], d)
        far[found] = d
    return near, far


def resolve_suffixes(window: int, gram: int) -> Callable[[list[int], list[int], list[bytes]], list[bytes]]:
    def resolve(chunks: list[int], counts: list[int], blocks: list[bytes]) -> list[bytes]:
        runs = [_Run.of(n, b) for n, b in zip(counts, blocks, strict=True)]
        total = sum(counts)
        base = np.concatenate([[0], np.cumsum(counts)])
        at, lcp = np.empty(total, np.int64), np.empty(total, np.int64)
        following = base[:-1].tolist()
        for i, (run, shared, _) in enumerate(lcp_merge.merged([lcp_merge.decoded(r.lcp, r.right_length, r.tail) for r in runs])):
            at[i], lcp[i] = following[run], shared
            following[run] += 1
        right_length = np.concatenate([r.right_length for r in runs]).astype(np.int64)
        left_length = np.concatenate([r.left_length for r in runs]).astype(np.int64)
        left = np.concatenate([_padded(r.left_length, r.before, int(left_length.max(initial=0))) for r in runs])
        ids, place = np.concatenate([r.ids for r in runs]), np.concatenate([r.place for r in runs])
        of = np.repeat(np.arange(len(runs)), counts)
        near, far = (np.full(total, _NONE, np.uint8) for _ in range(2))
        new = lcp < gram
        new[:1] = True
        starts = np.append(np.flatnonzero(new), total)
        begin = 0
        while begin < len(starts) - 1:  # slices of whole groups
            end = max(begin + 1, int(np.searchsorted(starts, starts[begin] + SLICE, side="right")) - 1)
            part = at[starts[begin] : starts[end]]
            group = np.cumsum(new[starts[begin] : starts[end]])
            rank = np.empty(len(part), np.int64)
            rank[np.lexsort((place[part], of[part], ids[part]))] = np.arange(len(part))
            got = _resolved(lcp[starts[begin] : starts[end]], group, rank, right_length[part], left[part], left_length[part], window)
            near[part], far[part] = got
            begin = end
        return [
            repeats.pack(near[a : a + n].tobytes() + far[a : a + n].tobytes())
            for a, n in zip(base[:-1].tolist(), counts, strict=True)
        ]

    return resolve


class _Parsed:
    """The steps shared by the results, up to the answers that tell repeated bytes."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, window: int, hot: int, attempts: Sequence[int]) -> None:
        shape = self.shape = shape_of(window)
        self.chunks = Chunks.of(docs, id_col, text_col, joined=False)

        def send_anchors(row: dict, buckets: int) -> Iterator[tuple[int, int, bytes]]:
            return repeats.anchor_blocks(np.unique(repeats.anchors(bytes_of(row), shape).hash), buckets)

        first = repeats.answered(self.chunks.send(send_anchors), repeats.repeated_anchors(hot), "anchors")
        for attempt, bits in enumerate(attempts):
            found = self._spans(first, attempt, bits)
            if found is not None:
                self.found = found
                return
        raise RuntimeError("unequal windows have equal hashes by every hash function")

    def _spans(self, first: DataFrame, attempt: int, bits: int) -> DataFrame | None:
        shape, buckets = self.shape, self.chunks.buckets

        def send_suffixes(row: dict, buckets: int, first: dict[int, bytes]) -> Iterator[tuple[int, int, bytes]]:
            units = bytes_of(row)
            suffixes, windows = _candidates(units, shape, buckets, first, attempt, bits)
            yield from suffixes.blocks(units, buckets)
            for bucket, n, block in windows.blocks(units, buckets):
                yield buckets + bucket, n, b"W" + block

        def resolve(chunks: list[int], counts: list[int], blocks: list[bytes]) -> list[bytes]:
            if blocks[0][:1] == b"W":
                return repeats.earliest_windows(chunks, counts, [b[1:] for b in blocks])
            return resolve_suffixes(shape.window, shape.gram)(chunks, counts, blocks)

        def parse(row: dict, units: Units, first: dict[int, bytes], second: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
            suffixes, windows = _candidates(units, shape, buckets, first, attempt, bits)
            hot = windows.spans(units, shape.window, row["chunk"], buckets, {b - buckets: a for b, a in second.items()})
            starts, stops = suffixes.spans(buckets, second, shape.window)
            sure = np.zeros(len(starts), SPAN)
            sure["start"], sure["stop"] = starts, stops
            return hot, sure

        second = repeats.answered(self.chunks.send(send_suffixes, first), resolve, "suffixes")
        return repeats.settled(self.chunks, bytes_of, parse, shape.piece, first, second)

    def results(self, rows_of: Callable[[Units, np.ndarray], pa.RecordBatch], schema: str) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    units, found = bytes_of(row), repeats.spans_of(row["answer0"])
                    yield rows_of(units, repeats.covered(len(units), found["start"], found["stop"]))

        return self.chunks.with_answers(self.found).mapInArrow(run, schema)


def _candidates(units: Units, shape: Shape, buckets: int, first: dict[int, bytes], attempt: int, bits: int) -> tuple[Suffixes, Windows]:
    """Suffixes at anchors that occur again, and the windows of those that are in very many chunks."""
    found = repeats.anchors(units, shape)
    hashes, of, times = np.unique(found.hash, return_inverse=True, return_counts=True)
    flags = repeats.joined_flags(hashes, buckets, first, 2)
    hot, wanted = flags[of, 1], (flags[:, 0] | (times > 1))[of]
    some = wanted & ~hot
    part = Anchors(*(getattr(found, f)[some] for f in ("place", "first", "last", "hash", "doc")))
    begin, length = found.first[hot], (found.last - found.first + 1)[hot]
    starts = np.repeat(begin - (np.cumsum(length) - length), length) + np.arange(length.sum())
    return Suffixes.of(units, part, shape), Windows.of(units, starts, np.repeat(found.doc[hot], length), shape.window, attempt, bits)


def _edges(units: Units, gone: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and stop of each maximal removed run within a document, and the document's first byte."""
    first = units.begins
    bound = np.zeros(len(gone) + 1, bool)
    bound[units.ends] = bound[first] = True
    up = gone.copy()
    up[1:] &= ~gone[:-1] | bound[1:-1]
    down = gone.copy()
    down[:-1] &= ~gone[1:] | bound[1:-1]
    return np.flatnonzero(up), np.flatnonzero(down) + 1, first


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, hot: int = HOT_CHUNKS,
    attempts: Sequence[int] = ATTEMPTS,
) -> DataFrame:
    """Maximal runs of repeated bytes: ``id_col, start, stop`` in bytes of the text's UTF-8."""

    def rows_of(units: Units, gone: np.ndarray) -> pa.RecordBatch:
        starts, stops, first = _edges(units, gone)
        doc = np.searchsorted(units.ends, starts, side="right")
        ids = pa.array(units.ids[doc], pa.int64(), mask=units.ids[doc] == LAST_ID)
        return pa.RecordBatch.from_arrays([ids, pa.array(starts - first[doc]), pa.array(stops - first[doc])], [id_col, "start", "stop"])

    return _Parsed(docs, id_col, text_col, window, hot, attempts).results(rows_of, f"`{id_col}` bigint, start bigint, stop bigint")


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, hot: int = HOT_CHUNKS,
    attempts: Sequence[int] = ATTEMPTS,
) -> DataFrame:
    """``id_col, n_bytes, n_removed, n_spans, kept, kept_sha256`` for every row of ``docs``.

    Removed is each byte of the text's UTF-8 in a string of ``window`` bytes that also starts earlier: in a
    document with a smaller id, or earlier in the same one. ``kept`` has the other bytes (a
    character may be cut); ``n_spans`` counts maximal removed runs. Ids are integers; NULL ids come
    last, rows with equal ids follow the order in which they are stored, and a repeated row
    repeats the first. NULL counts as empty; short texts lose nothing. An empty table gives
    an empty result. Other columns are not looked at. ``hot`` and ``attempts`` (bits of hashes by which
    windows at hot anchors are first matched) change no result; if unequal windows had equal
    hashes in all attempts, the job stops.
    """

    def rows_of(units: Units, gone: np.ndarray) -> pa.RecordBatch:
        starts, _, first = _edges(units, gone)
        lost = np.concatenate([[0], np.cumsum(gone)])
        spans = np.searchsorted(starts, units.ends) - np.searchsorted(starts, first)
        kept = [units.text[a:b][~gone[a:b]].tobytes() for a, b in zip(first.tolist(), units.ends.tolist(), strict=True)]
        columns = [
            pa.array(units.ids, pa.int64(), mask=units.ids == LAST_ID), pa.array(units.ends - first), pa.array(lost[units.ends] - lost[first]),
            pa.array(spans.astype(np.int64)), pa.array(kept, pa.binary()), pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, [id_col, "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    return _Parsed(docs, id_col, text_col, window, hot, attempts).results(
        rows_of, f"`{id_col}` bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, kept_sha256 string"
    )
