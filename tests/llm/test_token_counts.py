from collections import Counter

import pytest
from fixtures import CLASHING, SCHEMA, awkward_rows, clashing_rows

from aeroflow.llm import queries, token_counts
from aeroflow.llm.common import table


@pytest.fixture(scope="module")
def encode():
    with open(token_counts.VOCABULARY, "rb") as lines:
        return token_counts.encoding(lines.read(), token_counts.PATTERN).encode_ordinary


def brute(lengths):
    """Rows of the query from the lengths of all documents."""
    out = []
    for n, docs in sorted(Counter(lengths).items()):
        longer = [x for x in lengths if x >= n]
        out.append((n, docs, len(longer), sum(longer), sum(min(x, n) for x in lengths), round(sum(x <= n for x in lengths) / len(lengths), 9)))
    return out


def plain(df):
    return sorted((*tuple(r)[:5], round(r["share_at_most"], 9)) for r in df.collect())


def test_query_against_brute_force(spark, small_dir, encode):
    lengths = [len(encode(r["text"])) for r in table(spark, small_dir, "documents").collect()]
    found = queries.op3_token_counts(spark, small_dir)
    assert found.columns == ["n_tokens", "n_docs", "docs_at_least", "tokens_at_least", "truncated_total", "share_at_most"]
    assert plain(found) == brute(lengths)


def test_awkward_rows(spark, encode):
    for schema, rows in ((SCHEMA, awkward_rows()), (CLASHING, clashing_rows())):
        lengths = [len(encode(r[1] or "")) for r in rows]
        counts = token_counts.histogram(spark.createDataFrame(rows, schema))
        assert plain(token_counts.with_running_sums(counts)) == brute(lengths)
        limits = [0, 1, 2, 7, 1000, 10**9]
        assert token_counts.truncated_totals(counts, limits) == {n: sum(min(x, n) for x in lengths) for n in limits}
        for share in (0.0, 0.25, 0.5, 0.99, 1.0):
            least = min(n for n in lengths if sum(x <= n for x in lengths) >= share * len(lengths))
            assert token_counts.quantile(counts, share) == least


def test_groups(spark, encode):
    rows = awkward_rows()
    found = token_counts.histogram(spark.createDataFrame(rows, SCHEMA), by=["lang", "source"]).collect()
    assert Counter({(r[0], r[1], r[2]): r[3] for r in found}) == Counter((r[2], r[3], len(encode(r[1] or ""))) for r in rows)


def test_many_blocks(spark, monkeypatch, encode):
    monkeypatch.setattr(token_counts, "LENGTHS_PER_BLOCK", 2)
    rows = awkward_rows()
    counts = token_counts.histogram(spark.createDataFrame(rows, SCHEMA))
    assert plain(token_counts.with_running_sums(counts)) == brute([len(encode(r[1] or "")) for r in rows])


def test_empty_table(spark):
    counts = token_counts.histogram(spark.createDataFrame([], SCHEMA))
    assert counts.collect() == []
    assert token_counts.with_running_sums(counts).collect() == []
    assert token_counts.truncated_totals(counts, [5]) == {5: 0}
    assert token_counts.quantile(counts, 0.5) is None


def both(encode):
    with open(token_counts.VOCABULARY, "rb") as lines:
        held = lines.read()
    return token_counts.encoding(held, token_counts.PATTERN), token_counts.encoding(held, token_counts.WHOLE)


def test_cutting_white_space_changes_no_count(monkeypatch, encode):
    import random
    import re

    monkeypatch.setattr(token_counts, "LONG_SPACE", re.compile(token_counts.LONG_SPACE.pattern.replace("10000", "2")))
    pick, encodings = random.Random(1), both(encode)
    for _ in range(400):
        parts = [pick.choice([" ", "  ", " " * 9, "\n\n", "\t ", "\xa0\xa0", "　 ", "a", "Zeit", "12", "!?", "'s", "é", "\x1c\x1d"]) for _ in range(12)]
        text = "".join(parts)
        assert token_counts.token_count(text, *encodings) == len(encode(text)), parts


@pytest.mark.parametrize("n", [1_000_000, 10_000_000])
def test_very_long_runs(spark, encode, n):
    # Each space of a run is a token of its own, but for the one that belongs to the word after it.
    texts = {" " * n: n, "x" + " " * n + "y": n + 1, "x" + " " * n: n + 1, "\n" + " " * n + "\t.": None}
    for text, want in texts.items():
        found = token_counts.token_count(text, *both(encode))
        assert want is None or found == want
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([" " * n, "a" * 1_000_000])], "doc_id bigint, text string")
    assert [r["n_tokens"] for r in token_counts.token_lengths(rows, ["doc_id"]).orderBy("doc_id").collect()] == [n, 250_000]
