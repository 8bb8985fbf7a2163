"""Phrases that keep together: best-first branch and bound over phrase prefixes.

Phrases grow word by word from the left. A phrase's score is its count against the counts of its
two parts, for the worst cut; a cut after the first word gives ``scale * a * n / (l * r)``
with ``r >= a``, so no phrase that begins with a word scores above ``scale * n / count(word)``.
Prefixes are expanded from the greatest bound down, a limited batch in each round, and phrases are
settled by exact counts, until no bound reaches the score of the last place.

Texts are tokenized once, into chunks of word numbers. A round sends its batch to all
tasks and reads the chunks, so what is sent has a fixed size, whatever the corpus.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aeroflow.llm.common import stored, text_of
from aeroflow.llm.repeats import pack, unpack

# Fixed values of the contract.
SEPARATORS = "[.,;:!?\\x0A-\\x0D]"
SPACES = "[\\x20\\x09]+"
SCALE = 1000
NO_LANGUAGE = "und"

CHUNK_BYTES = 4 << 20
PREFIXES = 1 << 15  # expanded in one round
TASKS = 8  # that choose the best of all open ones
SHARE = 8  # prefixes of one round have at most this part of all words, if more than one
SETTLED = 1 << 14  # phrases settled in one round
NUMBERED = 1 << 10  # groups in which words are numbered
_NONE = -1  # where no frequent word stands: the end of a piece, or a rare word


@dataclass(frozen=True)
class Rules:
    """Least count and greatest length of phrases, and how many are wanted of each language."""

    least: int = 100
    longest: int = 5
    top: int = 2000


# Tokenizing.


def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, their counts, and the texts as numbers of words, pieces parted by -1."""
    pieces = pc.split_pattern_regex(pc.ascii_lower(texts), SEPARATORS).flatten()
    listed = pc.split_pattern_regex(pieces, SPACES)
    words, piece = listed.flatten(), pc.list_parent_indices(listed)
    there = pc.not_equal(words, "")
    words, piece = words.filter(there), piece.filter(there).to_numpy()
    if not len(words):
        return words, np.empty(0, np.int64), np.empty(0, np.int32)
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int32)
    counts = np.bincount(codes, minlength=len(coded.dictionary))
    return coded.dictionary, counts, np.insert(codes, np.flatnonzero(np.diff(piece)) + 1, _NONE)


_CHUNK = pa.schema({"chunk": pa.int64(), "lang": pa.string(), "words": pa.list_(pa.string()), "counts": pa.list_(pa.int64()), "codes": pa.binary()})


def _chunks(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(NO_LANGUAGE))
    rows = docs.select(lang.alias("lang"), text_of(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = itertools.count(TaskContext.get().partitionId() << 32)
        held, size = defaultdict(list), 0

        def chunk(lang: str, texts: list[str]) -> pa.RecordBatch:
            words, counts, codes = tokens(pa.array(texts, pa.large_string()))
            row = {"chunk": next(number), "lang": lang, "words": words.to_pylist(), "counts": counts, "codes": pack(codes.tobytes())}
            return pa.RecordBatch.from_pylist([row], _CHUNK)

        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
                held[lang.as_py()].append(text.as_py())
                size += len(held[lang.as_py()][-1])
                if size >= CHUNK_BYTES:
                    yield from itertools.starmap(chunk, held.items())
                    held, size = defaultdict(list), 0
        yield from itertools.starmap(chunk, held.items())

    schema = "chunk bigint, lang string, words array<string>, counts array<bigint>, codes binary"
    return stored(rows.mapInArrow(run, schema), "phrase-chunks")


def _vocabulary(counted: DataFrame, least: int) -> DataFrame:
    """``(word_id, lang, word, f)`` of frequent words; ids are numbers from 0, with few gaps."""
    group = F.pmod(F.xxhash64("lang", "word"), F.lit(NUMBERED))
    frequent = counted.where(F.col("f") >= least).withColumn("group", group)
    place = F.row_number().over(Window.partitionBy("group").orderBy("lang", "word")) - 1
    return stored(frequent.select((place * NUMBERED + F.col("group")).alias("word_id"), "lang", "word", "f"), "vocabulary")


def _numbered(chunks: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``(word_ids, codes)`` of each chunk: only frequent words, rare ones being -1."""
    # Rare words stay, without a number: as many rows leave the join as enter it.
    found = chunks.select("chunk", "lang", F.posexplode("words").alias("place", "word")).join(vocabulary, ["lang", "word"], "left")
    known = found.groupBy("chunk").agg(F.collect_list(F.struct("place", "word_id")).alias("known"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for known, n_words, codes in zip(batch.column("known"), batch.column("n_words"), batch.column("codes"), strict=True):
                frequent = known.values.filter(known.values.field("word_id").is_valid())
                place, word = frequent.field("place").to_numpy(), frequent.field("word_id").to_numpy()
                order = np.argsort(word)
                numbers = np.full(n_words.as_py() + 1, _NONE, np.int32)  # the last one is for -1
                numbers[place[order]] = np.arange(len(order), dtype=np.int32)
                kept = numbers[np.frombuffer(unpack(codes.as_py()), np.int32)]
                kept = kept[(kept >= 0) | (np.concatenate([kept[1:], kept[-1:]]) >= 0)]
                arrays = [pa.array([word[order]], pa.list_(pa.int64())), pa.array([pack(kept.tobytes())], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["word_ids", "codes"])

    named = chunks.where(F.size("words") > 0).select("chunk", F.size("words").alias("n_words"), "codes").join(known, "chunk")
    return stored(named.mapInArrow(run, "word_ids array<bigint>, codes binary"), "phrase-numbers")


# One round over the chunks.


class Batch:
    """Phrases to look for, as a trie of word ids: some to be expanded, some to be probed.

    Level k holds the sorted keys of all wanted phrases' first k + 1 words: the place of the first k
    on the level above, and the word.
    """

    def __init__(self, expand: Sequence[tuple[int, ...]], probe: Sequence[tuple[int, ...]]) -> None:
        every = [*expand, *probe]
        self.keys: list[np.ndarray] = []
        self.wanted: list[tuple[np.ndarray, np.ndarray]] = []
        place = np.zeros(len(every), np.int64)
        lengths = np.array([len(p) for p in every], np.int64)
        for level in range(max(lengths, default=0)):
            here = np.flatnonzero(lengths > level)
            words = np.array([every[i][level] for i in here], np.int64)
            keys, at = np.unique(place[here] << 32 | words, return_inverse=True)
            place[here] = at
            ends = here[lengths[here] == level + 1]
            wanted = np.full(len(keys), -1, np.int64), np.full(len(keys), -1, np.int64)
            grown = ends < len(expand)
            wanted[0][place[ends[grown]]] = ends[grown]
            wanted[1][place[ends[~grown]]] = ends[~grown] - len(expand)
            self.keys.append(keys)
            self.wanted.append(wanted)

    def _known(self, level: int, key: np.ndarray) -> np.ndarray:
        """Place of each key on a level, -1 for those that are not there."""
        place = np.minimum(np.searchsorted(self.keys[level], key), len(self.keys[level]) - 1)
        return np.where(self.keys[level][place] == key, place, -1)

    def look(self, word_ids: np.ndarray, codes: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Counts in one chunk, as the columns of ``_FOUND``."""
        text = np.concatenate([[_NONE], codes, [_NONE]])
        ids = np.append(word_ids, _NONE)  # also for -1
        node = self._known(0, ids)[text]
        for level, (expand, probe) in enumerate(self.wanted):
            if level:
                word = ids[text[at + level]]
                node = np.where(word >= 0, self._known(level, node << 32 | word), -1)
            met = np.flatnonzero(node >= 0)
            at = met if level == 0 else at[met]
            node = node[met]
            if not len(at):
                return
            yield from self._grown(expand[node], text[at + level + 1], ids)
            yield from self._probed(probe[node], ids[text[at - 1]], ids[text[at + level + 1]])

    @staticmethod
    def _grown(which: np.ndarray, following: np.ndarray, ids: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        there = (which >= 0) & (following >= 0)
        if there.any():
            keys, counts = np.unique(which[there] * len(ids) + following[there], return_counts=True)
            none = np.full(len(keys), _NONE, np.int64)
            yield np.ones(len(keys), bool), keys // len(ids), ids[keys % len(ids)], counts, none, none, none, none

    @staticmethod
    def _probed(which: np.ndarray, before: np.ndarray, after: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        there = np.flatnonzero(which >= 0)
        if len(there):
            there = there[np.argsort(which[there], kind="stable")]
            which = which[there]
            starts = np.flatnonzero(np.diff(which, prepend=-1))
            ends = [f.reduceat(side[there], starts) for side in (before, after) for f in (np.minimum, np.maximum)]
            none = np.full(len(starts), _NONE, np.int64)
            yield np.zeros(len(starts), bool), which[starts], none, np.diff(starts, append=len(which)), *ends


_FOUND = "grown boolean, which bigint, word_id bigint, f bigint, before_least bigint, before_most bigint, after_least bigint, after_most bigint"
_FOUND_NAMES = [c.split()[0] for c in _FOUND.split(", ")]


def _look(numbers: DataFrame, batch: Batch, least: int) -> DataFrame:
    """Counts over all chunks: frequent continuations of expanded phrases, all probed phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for ids, codes in zip(rows.column("word_ids"), rows.column("codes"), strict=True):
                for columns in batch.look(ids.values.to_numpy(), np.frombuffer(unpack(codes.as_py()), np.int32)):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], _FOUND_NAMES)

    sides = [(F.min if c.endswith("least") else F.max)(c).alias(c) for c in _FOUND_NAMES[4:]]
    summed = numbers.mapInArrow(run, _FOUND).groupBy("grown", "which", "word_id").agg(F.sum("f").alias("f"), *sides)
    return stored(summed.where((F.col("f") >= least) | ~F.col("grown")), "phrase-counts")


# The search.


@dataclass(frozen=True)
class Open:
    """A phrase with its count, those of its first and last word, and its bound for a language of one word."""

    phrase: tuple[int, ...]
    lang: str
    f: int
    first: int
    last: int
    share: float


_OPEN = ("phrase", "lang", "f", "first", "last", "share")


@dataclass(frozen=True)
class Scored:
    """A phrase with the counts of the parts of its worst cut."""

    lang: str
    phrase: tuple[int, ...]
    a: int
    left: int
    right: int
    n: int
    score: int


def parts(phrase: tuple[int, ...]) -> Iterator[tuple[tuple[int, ...], tuple[int, ...]]]:
    return ((phrase[:k], phrase[k:]) for k in range(1, len(phrase)))


def worst_cut(lang: str, phrase: tuple[int, ...], counts: dict[tuple[int, ...], int], n: int) -> Scored:
    """The cut with the least floored score, of equal ones the first; in whole numbers of any size."""
    a = counts[phrase]
    cuts = [(SCALE * a * n // (counts[left] * counts[right]), counts[left], counts[right]) for left, right in parts(phrase)]
    score, left, right = min(cuts, key=lambda cut: cut[0])
    return Scored(lang, phrase, a, left, right, n, score)


class Places:
    """The best phrases of each language so far: as many as are wanted, and all that tie with the last."""

    def __init__(self, top: int) -> None:
        self.top = top
        self.best: dict[str, list[Scored]] = defaultdict(list)

    def add(self, found: Sequence[Scored]) -> None:
        for lang in {s.lang for s in found}:
            best = self.best[lang] + [s for s in found if s.lang == lang]
            best.sort(key=lambda s: (-s.score, -s.a))
            if len(best) > self.top:
                last = best[self.top - 1]
                best = [s for s in best if (s.score, s.a) >= (last.score, last.a)]
            self.best[lang] = best

    def floor(self, lang: str) -> int:
        """The score a phrase must reach to have a place."""
        best = self.best[lang]
        return best[self.top - 1].score if len(best) >= self.top else 0


def _after(rows: DataFrame, taken: list[Open]) -> DataFrame:
    """Rows that come after the taken ones, which were the first in order."""
    if not taken:
        return rows
    last = taken[-1]
    later = F.col("phrase") > F.array(*[F.lit(w).cast("bigint") for w in last.phrase])
    return rows.where((F.col("share") < last.share) | ((F.col("share") == last.share) & later))


class Search:
    """The rounds. Open prefixes and unsettled phrases are stored tables; a round takes the best of both.

    ``share`` is a bound for a language of one word: times ``SCALE`` and the words of the language, no
    phrase with the prefix scores more.
    """

    def __init__(self, numbers: DataFrame, vocabulary: DataFrame, sizes: dict[str, int], rules: Rules) -> None:
        self.numbers, self.vocabulary, self.sizes, self.rules = numbers, vocabulary, sizes, rules
        self.places = Places(rules.top)

    def run(self) -> Places:
        words = self.vocabulary.select(F.array("word_id").alias("phrase"), "lang", "f", F.col("f").alias("first"), F.col("f").alias("last"))
        prefixes = words.withColumn("share", 1 / F.col("f"))
        phrases = prefixes.limit(0)
        while True:
            grown = self._best(prefixes, PREFIXES, sum(self.sizes.values()) // SHARE)
            settled = self._best(phrases, SETTLED, None)
            if not grown and not settled:
                return self.places
            # Counts of single words are at hand.
            probe = sorted({part for s in settled for cut in parts(s.phrase) for part in (s.phrase, *cut) if len(part) > 1})
            found = _look(self.numbers, Batch([g.phrase for g in grown], probe), self.rules.least)
            self._settle(settled, probe, found)
            children = self._children(grown, found)
            longer = children.where(F.size("phrase") < self.rules.longest).withColumn("share", 1 / F.col("first"))
            prefixes = self._promising(longer.unionByName(_after(prefixes, grown)), "open-prefixes")
            phrases = self._promising(children.unionByName(_after(phrases, settled)), "open-phrases")

    def _promising(self, rows: DataFrame, name: str) -> DataFrame:
        """Rows whose bound reaches the last place of their language; a hair is added for rounding."""
        known = [(lang, float(SCALE * n), float(self.places.floor(lang))) for lang, n in self.sizes.items()]
        floors = rows.sparkSession.createDataFrame(known, "lang string, scale double, floor double")
        kept = rows.join(floors, "lang").where(F.col("share") * F.col("scale") * (1 + 1e-9) >= F.col("floor"))
        return stored(kept.select(*_OPEN), name)

    def _best(self, rows: DataFrame, limit: int, words: int | None) -> list[Open]:
        """The rows of the greatest bounds: at most ``limit``, with ``words`` in all, but one at least."""
        # Each task sends its first rows to the driver, so there are few tasks.
        first = rows.select(*_OPEN).coalesce(TASKS).orderBy(F.col("share").desc(), "phrase").limit(limit).collect()
        taken, total = [], 0
        for phrase, *rest in first:
            taken.append(Open(tuple(phrase), *rest))
            total += taken[-1].f
            if words is not None and total > words and len(taken) > 1:
                return taken[:-1]
        return taken

    def _settle(self, settled: list[Open], probe: list[tuple[int, ...]], found: DataFrame) -> None:
        """Scores phrases. One whose neighbours on a side are always the same word is part of a longer one."""
        counts: dict[tuple[int, ...], int] = {}
        part_of_longer = set()
        for r in found.where(~F.col("grown")).collect():
            counts[probe[r["which"]]] = r["f"]
            sides = ((r["before_least"], r["before_most"]), (r["after_least"], r["after_most"]))
            if any(least == most != _NONE for least, most in sides):
                part_of_longer.add(probe[r["which"]])
        for s in settled:
            counts[s.phrase[:1]], counts[s.phrase[-1:]] = s.first, s.last
        kept = [s for s in settled if len(s.phrase) == self.rules.longest or s.phrase not in part_of_longer]
        self.places.add([worst_cut(s.lang, s.phrase, counts, self.sizes[s.lang]) for s in kept])

    def _children(self, grown: list[Open], found: DataFrame) -> DataFrame:
        """Frequent continuations, with bounds from the cuts after the first and before the last word."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in batches:
                parents = [grown[i] for i in rows.column("which").to_pylist()]
                words = rows.column("word_id").to_pylist()
                columns = [
                    pa.array([[*p.phrase, w] for p, w in zip(parents, words, strict=True)], pa.list_(pa.int64())),
                    pa.array([p.lang for p in parents], pa.string()), rows.column("f"), pa.array([p.first for p in parents], pa.int64()),
                    pa.array([p.f for p in parents], pa.int64()), rows.column("word_id"),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["phrase", "lang", "f", "first", "before", "word_id"])

        schema = "phrase array<bigint>, lang string, f bigint, first bigint, before bigint, word_id bigint"
        made = found.where("grown").select("which", "word_id", "f").mapInArrow(run, schema)
        named = made.join(self.vocabulary.select("word_id", F.col("f").alias("last")), "word_id")
        share = F.least(1 / F.col("first"), F.col("f") / (F.col("before").cast("double") * F.col("last")))
        return stored(named.withColumn("share", share).select(*_OPEN), "grown-phrases")


_RESULT = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, rules: Rules = Rules(), text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's best phrases, by falling score.

    A to Z become small; pieces end at ``.,;:!?`` and at line ends, words at spaces and tabs. All counts
    are of one language (NULL: ``und``), over whole texts; NULL texts are empty. ``n`` counts words, ``a``
    the places where the phrase stands in a piece, ``l`` and ``r`` those of its two parts, cut where
    ``score = floor(1000 * a * n / (l * r))`` is least (of equal ones after the fewest words). Candidates
    have 2 to ``longest`` words and ``a >= least``; one that stands only within a longer candidate
    is dropped. Ties go to the greater ``a``, then to the phrase first in byte order. A
    language without candidates has no rows, and so has an empty table; repeated rows count each time.

    In the driver: the prefixes and phrases of one round, at most 32,768 and 16,384 with their counts,
    and the places of each language with all phrases that tie with the last one. A text is held
    in a task, with about 30 times its bytes.
    """
    chunks = _chunks(docs, text_col, lang_col)
    each = chunks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("e")).select("lang", "e.words", "e.counts")
    counted = stored(each.groupBy("lang", F.col("words").alias("word")).agg(F.sum("counts").alias("f")), "word-counts")
    sizes = {r["lang"]: r["n"] for r in counted.groupBy("lang").agg(F.sum("f").alias("n")).collect()}
    vocabulary = _vocabulary(counted, rules.least)
    places = Search(_numbered(chunks, vocabulary), vocabulary, sizes, rules).run()

    rows = [(s.lang, list(s.phrase), s.a, s.left, s.right, s.n, s.score) for best in places.best.values() for s in best]
    best = docs.sparkSession.createDataFrame(rows, "lang string, ids array<bigint>, a bigint, l bigint, r bigint, n bigint, score bigint")
    spelled = best.select("*", F.posexplode("ids").alias("place", "word_id")).join(vocabulary.select("word_id", "word"), "word_id")
    words = F.sort_array(F.collect_list(F.struct("place", "word")))
    spelled = spelled.groupBy("lang", "ids", "a", "l", "r", "n", "score").agg(F.array_join(words["word"], " ").alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = spelled.withColumn("rank", F.row_number().over(order).cast("bigint"))
    return ranked.where(F.col("rank") <= rules.top).select(*_RESULT)
