"""Document fingerprints by winnowing.

Every run of ``gram`` code points has a rolling hash. Of each window of ``window`` neighbouring
hashes the least is kept, the rightmost of equal ones, with its position. Two texts that share
a passage of ``gram + window - 1`` code points or more therefore keep a hash in common, at
corresponding places; a passage shorter than ``gram`` alone never gives one.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroflow.llm.common import size_in_bytes, stored, text_of

GRAM = 24
WINDOW = 40
RANGE_BYTES = 128 << 20
BLOCK = 1 << 18  # windows that are looked at together

_U = np.uint64


def _spread(x: np.ndarray) -> np.ndarray:
    """A fixed mixing of 64 bits, one to one."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _turned(x: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Bits of each value rotated left."""
    by = by & _U(63)
    return (x << by) | (x >> ((_U(64) - by) & _U(63)))


@dataclass(frozen=True)
class Fingerprint:
    """Kept hashes and their positions in the text, in order of position."""

    hashes: np.ndarray
    places: np.ndarray

    def digits(self) -> str:
        """16 hexadecimal digits of each hash and 8 of its position, in order; empty for an empty text."""
        packed = np.empty(len(self.hashes), [("hash", ">u8"), ("place", ">u4")])
        packed["hash"], packed["place"] = self.hashes, self.places
        return packed.tobytes().hex()

    def likeness(self, other: Fingerprint) -> float:
        """Distinct hashes in both, of those in either; 1 for two empty fingerprints."""
        mine, theirs = set(self.hashes.tolist()), set(other.hashes.tolist())
        either = len(mine | theirs)
        return len(mine & theirs) / either if either else 1.0


@dataclass(frozen=True)
class Winnow:
    """Length of the hashed runs and number of neighbouring hashes of which one is kept."""

    gram: int = GRAM
    window: int = WINDOW

    def __post_init__(self) -> None:
        # Beyond 64 code points, rotations of one code point would cancel out.
        if not (1 <= self.gram <= 64 and self.window >= 1):
            raise ValueError("gram is 1 to 64, window at least 1")

    def rolling(self, values: np.ndarray) -> np.ndarray:
        """Cyclic polynomial hash of the run of ``gram`` values from each place.

        The hash is the exclusive or of the values, each rotated by its place in the run. Rolled
        on, it takes in the next value and lets go of the first: running sums of values rotated by
        their place in the text do that for all runs together.
        """
        place = np.arange(len(values) + 1, dtype=np.uint64)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.bitwise_xor.accumulate(_turned(values, _U(0) - place[:-1]), out=sums[1:])
        return _spread(_turned(sums[self.gram :] ^ sums[: -self.gram], place[: -self.gram]))

    def _least(self, hashes: np.ndarray) -> np.ndarray:
        """Place of the least hash of each window, the rightmost of equal ones."""
        width = min(self.window, len(hashes))
        best, at, have = hashes, np.arange(len(hashes)), 1
        while have < width:
            step = min(have, width - have)
            left, right = best[:-step], best[step:]
            take = right <= left
            best, at = np.where(take, right, left), np.where(take, at[step:], at[:-step])
            have += step
        return at

    def fingerprint(self, text: str) -> Fingerprint:
        """Of a whole text, block by block. A text shorter than ``gram`` is hashed as one run; an empty one has no hash."""
        points = np.frombuffer(text.encode("utf-32-le"), "<u4")
        if not len(points):
            return Fingerprint(np.empty(0, np.uint64), np.empty(0, np.int64))
        if len(points) < self.gram:
            short = Winnow(len(points), 1).rolling(_spread(points.astype(np.uint64) + _U(1)))
            return Fingerprint(short, np.zeros(1, np.int64))
        hashes, places = [], []
        windows = max(1, len(points) - self.gram - self.window + 2)
        for start in range(0, windows, BLOCK):
            stop = min(start + BLOCK, windows)
            part = points[start : stop + self.gram + self.window - 2]
            rolled = self.rolling(_spread(part.astype(np.uint64) + _U(1)))
            at = self._least(rolled)
            at = at[np.flatnonzero(np.diff(at, prepend=-1))]  # neighbouring windows mostly keep one hash
            if places and places[-1][-1] == start + at[0]:
                at = at[1:]
            if len(at):
                hashes.append(rolled[at])
                places.append(start + at)
        return Fingerprint(np.concatenate(hashes), np.concatenate(places))


def edited(text: str, other: str, parts: int = 3) -> str:
    """``text`` with its last ``len // parts`` code points replaced by the first as many (or all) of ``other``."""
    n = len(text) // parts
    return text[: len(text) - n] + other[:n]


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64()}
_PRINTED = "doc_id bigint, n_chars bigint, hashes array<bigint>, places array<bigint>"
_COMPARED = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, n_kept bigint"
)
_ROWS_OUT = 256


def _batches(rows: Iterator[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    fields = [c.split() for c in schema.split(", ")]
    while held := list(itertools.islice(rows, _ROWS_OUT)):
        columns = zip(zip(*held, strict=True), fields, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, _ARROW[t]) for c, (_, t) in columns], [n for n, _ in fields])


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), text_of(f"`{text_col}`").alias("text"))


def _rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """One row at a time in Python, as texts can be long."""
    for batch in batches:
        for row in zip(*[batch.column(n) for n in names], strict=True):
            yield tuple(value.as_py() for value in row)


def fingerprints(docs: DataFrame, winnow: Winnow = Winnow(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_chars, hashes, places)`` of every row, without a shuffle.

    Equal texts have equal fingerprints. NULL is the empty text, which has no hash; repeated rows
    and NULL ids stay; an empty table gives no rows. Ids are integers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS_OUT):
                part = batch.slice(at, _ROWS_OUT)
                texts = part.column("text").to_pylist()
                made = [winnow.fingerprint(t) for t in texts]
                columns = [
                    part.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([m.hashes.view(np.int64) for m in made], pa.list_(pa.int64())),
                    pa.array([m.places for m in made], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_chars", "hashes", "places"])

    return _texts(docs, id_col, text_col).mapInArrow(run, _PRINTED)


def _compared(winnow: Winnow, doc: tuple[int | None, str, Fingerprint], other: str, theirs: Fingerprint) -> tuple:
    doc_id, text, mine = doc
    changed = edited(text, other)
    kept = winnow.fingerprint(changed)
    digest = hashlib.sha256(changed.encode()).hexdigest()
    return doc_id, len(text), digest, mine.digits(), kept.digits(), mine.likeness(kept), mine.likeness(theirs), len(mine.hashes)


_KEY = ("no_id", "down", "hash")  # the order of documents: ids fall, none comes last


def _keyed(docs: DataFrame) -> DataFrame:
    down = F.coalesce(F.bitwise_not("doc_id"), F.lit(0))
    return docs.withColumns({"no_id": F.isnull("doc_id"), "down": down, "hash": F.xxhash64("text")})


def _sortable(no_id: np.ndarray, down: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Keys as byte strings of one length that sort as the keys do."""
    out = np.empty(len(down), [("no_id", "u1"), ("down", ">u8"), ("hash", ">u8")])
    sign = _U(1 << 63)
    out["no_id"], out["down"], out["hash"] = no_id, down.view(np.uint64) ^ sign, hashed.view(np.uint64) ^ sign
    return out.view("S17").ravel()


def _cuts(keys: DataFrame) -> np.ndarray:
    """The first key of each of some ranges of about equal length: a shuffle partition's, or of 128 MB of text."""
    size = keys.agg(F.sum("bytes")).first()[0] or 0
    least = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = keys.repartitionByRange(max(least, size // RANGE_BYTES), *_KEY)
    firsts = ranged.groupBy(F.spark_partition_id()).agg(F.min(F.struct(*_KEY)).alias("first")).select("first.*").collect()
    columns = [np.array([r[c] for r in firsts], t) for c, t in zip(_KEY, (bool, np.int64, np.int64), strict=True)]
    return np.sort(_sortable(*columns))


def against_next(docs: DataFrame, winnow: Winnow = Winnow(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint against that of an edit and that of the next document.

    The next document is the one with the next lower id, after the last one the first. Rows without
    id come after all others, rows of one id in the order of a hash of their text; repeated rows
    stay, each the next of the one before. A single row is its own next. The edit takes the
    beginning of the next document (``edited``). NULL is the empty text. An empty table gives no rows.
    Ids are integers. ``near_edited`` and ``near_next`` are 0 to 1 (``Fingerprint.likeness``).

    Ids and text hashes are sorted first, and cut into ranges; then texts go to their ranges, once, and
    the first row of a range to the end of the range before as well. Rows of one id and text
    are counted before that, so that no id or text is too frequent for one task.
    """
    rows = _keyed(_texts(docs, id_col, text_col))
    counted = rows.groupBy(*_KEY).agg(F.count("*").alias("copies"), F.sum(size_in_bytes(F.col("text"))).alias("bytes"))
    keys = stored(counted, "document-keys")
    cuts = _cuts(keys)
    ranges = max(1, len(cuts))

    @F.arrow_udf("int")
    def place(no_id: pa.Array, down: pa.Array, hashed: pa.Array) -> pa.Array:
        """Twice the number of a key's range, and 1 more for the first key of one."""
        sought = _sortable(*(c.to_numpy(zero_copy_only=False) for c in (no_id, down, hashed)))
        found = np.searchsorted(cuts, sought, "right") - 1
        return pa.array(2 * found + (cuts[found] == sought), pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def compared() -> Iterator[tuple]:
            held, done = None, False
            for doc_id, text, copies, closing in _rows(batches, "doc_id", "text", "copies", "closing"):
                if done:  # a further text with the next range's first key
                    continue
                kept = winnow.fingerprint(text)
                if held is not None:
                    yield _compared(winnow, held, text, kept)
                held, done = (doc_id, text, kept), closing
                if copies > 1 and not closing:
                    yield from itertools.repeat(_compared(winnow, held, text, kept), copies - 1)

        return _batches(compared(), _COMPARED)

    repeated = stored(keys.where("copies > 1").select(*_KEY), "repeated-keys")
    once = rows.join(repeated, [*_KEY], "left_anti").withColumn("copies", F.lit(1).cast("bigint"))
    again = rows.join(repeated, [*_KEY], "left_semi").groupBy(*_KEY, "doc_id", "text").agg(F.count("*").alias("copies"))
    placed = once.unionByName(again).withColumn("place", place(*_KEY))
    here = F.struct(F.floor(F.col("place") / 2).cast("int").alias("range"), F.lit(False).alias("closing"))
    before = F.struct(F.pmod(here["range"] - 1, F.lit(ranges)).alias("range"), F.lit(True).alias("closing"))
    sent = placed.withColumn("to", F.explode(F.when(F.col("place") % 2 == 1, F.array(here, before)).otherwise(F.array(here))))
    named = sent.select("doc_id", "text", "copies", "to.range", "to.closing", *_KEY)
    in_order = named.repartitionById(ranges, "range").sortWithinPartitions("closing", *_KEY, "text")
    return in_order.select("doc_id", "text", "copies", "closing").mapInArrow(run, _COMPARED)
