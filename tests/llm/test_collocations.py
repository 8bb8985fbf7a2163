from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from compare import connect, duck_rows, spark_rows
from fixtures import CLASHING, SCHEMA, awkward_rows, clashing_rows

from aeroflow.llm import collocations, queries
from aeroflow.llm.collocations import Places, Rules, Scored, worst_cut

NAMES = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, rules):
    counts, sizes = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(SMALL)):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for m in range(1, rules.longest + 1):
                counts.setdefault(lang, Counter()).update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        frequent = {p: c for p, c in f.items() if c >= rules.least and len(p) > 1}
        dropped = {p[i:j] for p, c in frequent.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and 100 * c >= 100 * f[p[i:j]]}
        found = []
        for p, a in frequent.items():
            if p not in dropped:
                score, k = min((1000 * a * sizes[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[: rules.top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, sizes[lang], -score))
    return sorted(out)


def found(frame):
    return sorted(tuple(r) for r in frame.select(*NAMES).collect())


def random_rows(seed, n):
    pick = random.Random(seed)
    common = [f"w{i}" for i in range(30)] + ["The", "of", "é", "🙂"]
    idioms = ["kick the bucket today now", "by and large", "by and by", "a a a a a a", "x y", "New York city", "york city hall"]
    rows = []
    for i in range(n):
        words = []
        for _ in range(pick.randrange(60)):
            words.append(pick.choice(idioms) if pick.random() < 0.2 else pick.choice(common[: 1 + pick.randrange(len(common))]))
            if pick.random() < 0.1:
                words[-1] += pick.choice([".", ",", "!", "\n", "\r", "\x0b", "  ", "\t"])
        rows.append((" ".join(words), pick.choice(["en", "en", "en", "de", None, "und"])))
    return rows


@pytest.mark.parametrize("rules", [Rules(5, 5, 2000), Rules(3, 5, 7), Rules(20, 2, 5)])
def test_as_counting_everything(spark, rules):
    rows = random_rows(rules.top, 150)
    frame = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    assert found(collocations.collocations(frame, rules)) == plain(rows, rules)


@pytest.mark.parametrize(("prefixes", "settled", "share"), [(7, 5, 100), (1000, 3, 2)])
def test_size_of_a_round_does_not_matter(spark, monkeypatch, prefixes, settled, share):
    monkeypatch.setattr(collocations, "PREFIXES", prefixes)
    monkeypatch.setattr(collocations, "SETTLED", settled)
    monkeypatch.setattr(collocations, "SHARE", share)
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 500)
    rules, rows = Rules(12, 4, 3), random_rows(8, 30)
    frame = spark.createDataFrame(rows, "text string, lang string")
    assert found(collocations.collocations(frame, rules)) == plain(rows, rules)


def test_rounds_leave_hopeless_prefixes_closed(spark, monkeypatch):
    grown = []
    init = collocations.Batch.__init__

    def spy(self, expand, probe):
        grown.extend(expand)
        init(self, expand, probe)

    monkeypatch.setattr(collocations.Batch, "__init__", spy)
    monkeypatch.setattr(collocations, "PREFIXES", 40)
    rules, rows = Rules(2, 5, 3), [(t, "en") for t, _ in random_rows(5, 60)]
    frame = spark.createDataFrame(rows, "text string, lang string")
    assert found(collocations.collocations(frame, rules)) == plain(rows, rules)
    every = Counter(p for t, _ in rows for piece in re.split(r"[.,;:!?\x0A-\x0D]", t.translate(SMALL)) for w in [piece.split()] for p in w)
    assert len([p for p in grown if len(p) == 1]) < len([c for c in every.values() if c >= 2])


def test_awkward_rows(spark):
    rows = awkward_rows()
    for rules in (Rules(2, 5, 50), Rules(19_000, 5, 10)):
        want = plain([(r[1], r[2]) for r in rows], rules)
        assert found(collocations.collocations(spark.createDataFrame(rows, SCHEMA), rules)) == want
    clashing = spark.createDataFrame(clashing_rows(), CLASHING)
    assert found(collocations.collocations(clashing, Rules(2, 5, 50))) == plain([(r[1], r[2]) for r in rows], Rules(2, 5, 50))
    assert found(collocations.collocations(spark.createDataFrame([], SCHEMA))) == []
    assert found(collocations.collocations(spark.createDataFrame([(1, None, None, None, 0)], SCHEMA))) == []


def test_scores_are_exact_beyond_64_bits():
    counts = {(1, 2): 10**12 + 1, (1,): 10**12 + 1, (2,): 10**12 + 3}
    n = 10**15 + 7
    scored = worst_cut("en", (1, 2), counts, n)
    assert scored.score == 1000 * (10**12 + 1) * n // ((10**12 + 1) * (10**12 + 3))


def test_places_keep_all_that_tie_with_the_last():
    places = Places(2)
    places.add([Scored("en", (i,), a, 1, 1, 1, score) for i, (a, score) in enumerate([(1, 5), (1, 5), (1, 5), (2, 4), (9, 9)])])
    assert sorted(s.phrase for s in places.best["en"]) == [(0,), (1,), (2,), (4,)]
    assert places.floor("en") == 5 and places.floor("de") == 0


def test_tokens_part_pieces():
    words, counts, codes = collocations.tokens(collocations.pa.array(["A b. c", "", " \t", "b\nb"], collocations.pa.large_string()))
    assert words.to_pylist() == ["a", "b", "c"] and counts.tolist() == [1, 3, 1]
    assert codes.tolist() == [0, 1, -1, 2, -1, 1, -1, 1] and codes.dtype == np.int32


def test_query_as_sql(spark, sf_dir):
    got = queries.op13_collocations(spark, sf_dir)
    assert spark_rows(got) == duck_rows(connect(sf_dir), queries.ORACLE_SQL["op13_collocations"])
