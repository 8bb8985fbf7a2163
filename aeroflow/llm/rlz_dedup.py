"""Duplicate spans of words by relative Lempel-Ziv factors.

Every document is a reference for later ones. The reference index has the earliest start of
each window of words that may occur again. A document is parsed from left to right:
where a window is in the index, the factor follows its source word by word as long as
the index agrees; where the source changes, a new factor begins. Windows that straddle the
boundary of two factors are looked up as well, so nothing between them is missed. Factors
of a window's length or more are duplicate spans, after the block that holds the source has
compared their words with its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from aeroflow.llm import repeats
from aeroflow.llm.repeats import ATTEMPTS, LAST_ID, SPAN, Chunks, Shape, Units, Windows

WINDOW = 20


def shape_of(window: int) -> Shape:
    return Shape(window, max(1, window // 2))


def words_of(row: dict) -> Units:
    """The words of a chunk's texts, which have single spaces between words."""
    raw = repeats.unpack(row["text"])
    text = np.frombuffer(raw, np.uint8)
    byte_ends = np.frombuffer(row["ends"], np.int64)
    ids = np.frombuffer(row["ids"], np.int64)
    if not len(text):
        return Units(text, ids, np.zeros(len(ids), np.int64), np.empty(0, np.int64), np.empty(0, np.int64))
    space = text == 0x20
    starts = ~space
    starts[1:] &= space[:-1]
    begin = np.concatenate([[0], byte_ends[:-1]])
    starts[begin[begin < byte_ends]] = True  # texts follow each other without a space
    at = np.flatnonzero(starts)
    stops = np.append(at[1:], len(text))
    stops = stops - (text[stops - 1] == 0x20)
    return Units(text, ids, np.searchsorted(at, byte_ends), at, stops)


def _candidates(units: Units, shape: Shape, buckets: int, first: dict[int, bytes], attempt: int, bits: int) -> Windows:
    """Windows whose anchor occurs more than once, in this chunk or in another."""
    found = repeats.anchors(units, shape)
    hashes, of, times = np.unique(found.hash, return_inverse=True, return_counts=True)
    wanted = (repeats.joined_flags(hashes, buckets, first, 2)[:, 0] | (times > 1))[of]
    first_window, length = found.first[wanted], (found.last - found.first + 1)[wanted]
    starts = np.repeat(first_window - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum()) if len(length) else np.empty(0, np.int64)
    return Windows.of(units, starts, np.repeat(found.doc[wanted], length), shape.window, attempt, bits)


class _Parsed:
    """Steps shared by the results: chunks, and their factors."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, window: int, attempts: Sequence[int]) -> None:
        self.shape = shape_of(window)
        self.chunks = Chunks.of(docs, id_col, text_col, joined=True)
        shape = self.shape

        def send_anchors(row: dict, buckets: int) -> Iterator[tuple[int, int, bytes]]:
            return repeats.anchor_blocks(np.unique(repeats.anchors(words_of(row), shape).hash), buckets)

        first = repeats.answered(self.chunks.send(send_anchors), repeats.repeated_anchors(1 << 62), "anchors")
        for attempt, bits in enumerate(attempts):
            found = self._factors(first, attempt, bits)
            if found is not None:
                self.factors = found
                return
        raise RuntimeError("unequal windows have equal hashes by every hash function")

    def _factors(self, first: DataFrame, attempt: int, bits: int) -> DataFrame | None:
        shape, buckets = self.shape, self.chunks.buckets

        def send_windows(row: dict, buckets: int, first: dict[int, bytes]) -> Iterator[tuple[int, int, bytes]]:
            units = words_of(row)
            return _candidates(units, shape, buckets, first, attempt, bits).blocks(units, buckets)

        def parse(row: dict, units: Units, first: dict[int, bytes], second: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
            windows = _candidates(units, shape, buckets, first, attempt, bits)
            return windows.spans(units, shape.window, row["chunk"], buckets, second), np.empty(0, SPAN)

        second = repeats.answered(self.chunks.send(send_windows, first), repeats.earliest_windows, "windows")
        return repeats.settled(self.chunks, words_of, parse, shape.piece, first, second)

    def results(self, rows_of: Callable[[Units, np.ndarray], pa.RecordBatch], schema: str) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    yield rows_of(words_of(row), repeats.spans_of(row["answer0"]))

        return self.chunks.with_answers(self.factors).mapInArrow(run, schema)


def _id_array(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == LAST_ID)


def duplicate_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, attempts: Sequence[int] = ATTEMPTS
) -> DataFrame:
    """The factors: ``id_col, start, stop, source_id, source_start``, in words.

    Words ``start`` to ``stop`` (exclusive) of a document also stand at ``source_start`` of the document
    ``source_id``, an earlier one or the same. Factors may overlap. ``attempts`` are bits of hashes
    that windows are first matched by, for each attempt; they change no result.
    """

    def rows_of(units: Units, found: np.ndarray) -> pa.RecordBatch:
        base = units.begins[found["doc"]]
        columns = [
            _id_array(units.ids[found["doc"]]), pa.array(found["start"] - base), pa.array(found["stop"] - base),
            _id_array(found["id"]), pa.array(found["at"].copy()),
        ]
        return pa.RecordBatch.from_arrays(columns, [id_col, "start", "stop", "source_id", "source_start"])

    parsed = _Parsed(docs, id_col, text_col, window, attempts)
    return parsed.results(rows_of, f"`{id_col}` bigint, start bigint, stop bigint, source_id bigint, source_start bigint")


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, attempts: Sequence[int] = ATTEMPTS
) -> DataFrame:
    """``id_col, n_words, n_removed, kept_text, kept_sha256`` for every row of ``docs``.

    Removed are words in a window of ``window`` words that also starts earlier: in a document with a
    smaller id, or earlier in the same one. ``kept_text`` has the other words, joined by one space.
    Ids are integers; NULL ids come last, rows with equal ids follow the order in which they are
    stored, and a repeated row repeats the first. NULL, blank and short texts lose
    nothing. An empty table gives an empty result. Other columns are not looked at. ``attempts``
    as for ``duplicate_spans``; if unequal windows had equal hashes in all of them, the job stops.
    """

    def rows_of(units: Units, found: np.ndarray) -> pa.RecordBatch:
        gone = repeats.covered(len(units), found["start"], found["stop"])
        totals = np.concatenate([[0], np.cumsum(gone)])
        first = units.begins
        raw = units.text.tobytes()
        texts = []
        for a, b in zip(first.tolist(), units.ends.tolist(), strict=True):
            if totals[b] == totals[a]:
                texts.append(raw[units.starts[a] : units.stops[b - 1]] if b > a else b"")
            else:
                kept = a + np.flatnonzero(~gone[a:b])
                texts.append(b" ".join([raw[x:y] for x, y in zip(units.starts[kept].tolist(), units.stops[kept].tolist(), strict=True)]))
        columns = [
            _id_array(units.ids), pa.array(units.ends - first), pa.array(totals[units.ends] - totals[first]),
            pa.array(texts, pa.binary()).cast(pa.string()), pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, [id_col, "n_words", "n_removed", "kept_text", "kept_sha256"])

    parsed = _Parsed(docs, id_col, text_col, window, attempts)
    return parsed.results(rows_of, f"`{id_col}` bigint, n_words bigint, n_removed bigint, kept_text string, kept_sha256 string")
