"""Small tables with every awkward case, and plain-Python versions of the contracts."""

from __future__ import annotations

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Extra columns with names that the operators use themselves.
CLASHING = SCHEMA + ", fingerprint string, _text string, size int, key string, shard string, _id int, _row int, bucket int, root int, _fp int"


def words(text):
    return WORD.findall(text or "")


def awkward_rows():
    """Nulls in any column, empty, blank and long texts, ties, repeated rows, equal texts."""
    base = " ".join(f"w{i % 37}x{i % 11}" for i in range(120))
    near = base.replace("w5x5", "other", 1)
    rows = [
        (0, base, "en", "a", 10), (1, base, "en", "a", 10), (2, near, "en", "b", None),
        (3, None, "en", "a", 0), (4, "", None, "b", 0), (5, " \t\n ", "de", None, 3),
        (6, "one two", "fr", None, 7), (6, "one two", "fr", None, 7), (7, "One  TWO", "fr", "c", 8),
        (None, "no id here at all", "en", "c", 5), (None, None, None, None, None),
        (None, "no id here at all", "en", "c", 5), (8, "one\ttwo", "fr", "é", 7),
        (9, "long " * 20_000 + "end", "en", "c", 1), (10, "x" * 50_000, "en", "c", 1),
        (11, "ein zwei drei vier fünf sechs sieben ß é 🙂", "de", "Z", 1),
        (12, " non breaking ", "de", "Z", 1), (13, base + " tail of it", "en", "a", 1),
        (14, "\x0b\x0cvertical\x0btab", "en", "a", 1), (15, "one two", "xx", "d", 1),
    ]
    return rows


def clashing_rows():
    return [(*r, "f", "t", 1, "k", "s", 2, 3, 4, 5, 6) for r in awkward_rows()]


def components(nodes, linked):
    """Least member reached from each node; ``linked(a, b)`` says whether two nodes link."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    nodes = list(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                root[find(a)] = find(b)
    groups = defaultdict(list)
    for n in nodes:
        groups[find(n)].append(n)
    return {n: members for members in groups.values() for n in members}
