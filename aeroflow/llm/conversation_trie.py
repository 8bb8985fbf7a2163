"""Prefix trie of conversations: which beginnings are shared, by how many, and what that saves.

Turns are dictionary-encoded, conversations sorted by their turn ids and cut into ranges.
Each range builds a ternary search tree, inserting its distinct sequences from the median
outwards, and walks it without recursion. Only nodes on the path of a range's first and
last sequence can also be in a neighbouring range; these boundary nodes, a few for each
range, are merged in range order by a sweep that holds one path at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeroflow.llm.common import stored, text_of

RANGE_TURNS = 50_000  # turns of a range, about
PIECE_IDS = 400  # conversation ids in one row of text that is still to be hashed

_FIRST, _LAST = 0, 1  # the path of a range's first, and of its last sequence


def _turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    named = conversations.select(
        F.col(f"`{conv}`").cast("bigint").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
        text_of(f"`{role}`").alias("role"), text_of(f"`{text}`").alias("text"),
    )
    return named.where("conv_id is not null").withColumn("code", F.xxhash64("role", "text"))


def _numbered(turns: DataFrame) -> DataFrame:
    """``variant`` tells apart different turns of one 64-bit code; it is 0 for nearly all of them.

    All turns of a code are compared, text by text, so ids are exact whatever the texts. Codes with
    one text need no entry; the distinct texts of others are numbered and joined.
    """
    turn = F.struct("role", "text")
    codes = turns.groupBy("code").agg(F.min(turn).alias("least"), F.max(turn).alias("greatest"))
    clashing = stored(codes.where("least <> greatest").select("code"), "clashing-codes")
    dictionary = turns.join(clashing, "code", "left_semi").select("code", "role", "text").distinct()
    among = F.row_number().over(Window.partitionBy("code").orderBy("role", "text")) - 1
    variants = stored(dictionary.withColumn("variant", among).where("variant > 0"), "turn-variants")
    return turns.join(variants, ["code", "role", "text"], "left").withColumn("variant", F.coalesce("variant", F.lit(0)))


def _collected(turns: DataFrame, tie: Column) -> DataFrame:
    turn = F.struct("turn", tie.alias("tie"), "code", "variant", F.octet_length("text").alias("bytes"))
    listed = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("listed"))
    return listed.withColumn("turns", F.transform("listed", lambda t: F.struct(t["code"], t["variant"], t["bytes"])))


def sequences(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``(conv_id, turns)``: each conversation's turns in order, as ``(code, variant, bytes)``.

    Equal code and variant mean equal role and text; ``bytes`` is the text's UTF-8 length. Turns
    are ordered by number, NULL first; those of one number by role, then text, and repeated
    rows stay. NULL role or text is empty. Rows without ``conv`` belong to no conversation and
    are left out; ``conv`` is an integer. An empty table has no conversations.

    A conversation is one row of 16 bytes a turn, and no text.
    """
    turns = _turns(conversations, conv, turn, role, text)
    numbered = _numbered(turns)
    found = stored(_collected(numbered, F.lit(0)), "conversations")
    # Where turns of one number differ, their texts decide; all others need no text.
    of_one_number = F.array_distinct(F.transform("listed", lambda t: t["turn"]))
    differ = F.size(of_one_number) < F.size(F.array_distinct("listed"))
    tied = stored(found.where(differ).select("conv_id"), "tied-conversations")
    by_text = F.dense_rank().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text"))
    again = _collected(numbered.join(tied, "conv_id", "left_semi").withColumn("tie", by_text), F.col("tie"))
    return found.where(~differ).unionByName(again).select("conv_id", "turns")


def with_shared_heads(found: DataFrame, group: int = 5, modulus: int = 9) -> DataFrame:
    """Conversations that take their beginning from the first one of their group of ids.

    Conversation c gets the first h turns of conversation c - c % ``group`` (all if it has fewer,
    none if there is no such conversation) and then its own turns after its first h, with h =
    crc32(c as decimal) % ``modulus``. It may end up with no turn at all.
    """
    no_turns = F.array().cast(found.schema["turns"].dataType)
    heads = found.where(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, modulus - 1).alias("head")
    )
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % modulus
    named = found.withColumns({"base": F.col("conv_id") - F.col("conv_id") % group, "taken": taken.cast("int")})
    head = F.slice(F.coalesce("head", no_turns), F.lit(1), F.col("taken"))
    tail = F.slice("turns", F.col("taken") + 1, F.size("turns"))
    return named.join(heads, "base", "left").select("conv_id", F.concat(head, tail).alias("turns"))


@dataclass
class TernaryTree:
    """A trie whose siblings form binary search trees; node 0 is the root and has no turn.

    ``equal`` leads to a node's children, ``low`` and ``high`` to its siblings.
    """

    code: list[int] = field(default_factory=lambda: [-1])
    low: list[int] = field(default_factory=lambda: [-1])
    equal: list[int] = field(default_factory=lambda: [-1])
    high: list[int] = field(default_factory=lambda: [-1])
    members: list[int] = field(default_factory=lambda: [0])
    least: list[int | None] = field(default_factory=lambda: [None])

    def insert(self, codes: Sequence[int], members: int, least: int) -> list[int]:
        """Adds ``members`` equal sequences; returns their path."""
        path = [0]
        self._pass(0, members, least)
        for code in codes:
            links, at = self.equal, path[-1]
            while (found := links[at]) >= 0 and self.code[found] != code:
                links, at = (self.low if code < self.code[found] else self.high), found
            if found < 0:
                found = links[at] = len(self.code)
                for column, value in zip(
                    (self.code, self.low, self.equal, self.high, self.members, self.least),
                    (code, -1, -1, -1, 0, None), strict=True,
                ):
                    column.append(value)
            self._pass(found, members, least)
            path.append(found)
        return path

    def _pass(self, node: int, members: int, least: int) -> None:
        self.members[node] += members
        self.least[node] = least if self.least[node] is None else min(self.least[node], least)

    def walk(self) -> tuple[list[int], list[int], list[int]]:
        """Nodes, parents before their children, and each node's parent and depth."""
        order, parent, depth = [0], [-1] * len(self.code), [0] * len(self.code)
        stack = [(self.equal[0], 0)]
        while stack:
            node, above = stack.pop()
            if node < 0:
                continue
            parent[node], depth[node] = above, depth[above] + 1
            order.append(node)
            stack += [(self.low[node], above), (self.high[node], above), (self.equal[node], node)]
        return order, parent, depth


def medians_first(n: int) -> Iterator[int]:
    """0 to n - 1, the median before the medians of both halves."""
    spans = [(0, n)]
    for start, stop in spans:  # the list grows while it is read
        if start < stop:
            middle = (start + stop) // 2
            yield middle
            spans += [(start, middle), (middle + 1, stop)]


def ends_hash(ids: Sequence[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


_NO_ENDS = ends_hash(())

# What a range says of a node. ``side`` is NULL for a node that is in no other range; its counts are
# final. Counts of a boundary node leave out its boundary children, and what depends on them.
_RANGE_SCHEMA = """range int, side int, depth bigint, conv_id bigint, parent_side int, parent_conv_id bigint, n_convs bigint,
  n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string, code bigint, variant int, bytes bigint,
  piece int, ends string"""
_RANGE_COLUMNS = [c.split()[0] for c in _RANGE_SCHEMA.replace("\n", " ").split(",")]
_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
_RANGE_TYPES = [_ARROW[c.split()[1]] for c in _RANGE_SCHEMA.replace("\n", " ").split(",")]


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _local_codes(code: np.ndarray, variant: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each turn id among those of the range, and a place of each rank."""
    order = np.lexsort((variant, code))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(code[order]) != 0) | (np.diff(variant[order]) != 0)
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(new) - 1
    return ranks, order[new]


def range_nodes(number: int, ids: np.ndarray, lengths: np.ndarray, code: np.ndarray, variant: np.ndarray, size: np.ndarray) -> list[tuple]:
    """The nodes of one range of sorted conversations, as rows of ``_RANGE_SCHEMA``."""
    ranks, places = _local_codes(code, variant)
    stops = np.cumsum(lengths)
    cuts = [ranks[stop - n : stop] for stop, n in zip(stops, lengths, strict=True)]
    runs: list[list[int]] = []  # first and last + 1 conversation of each distinct sequence
    for i, cut in enumerate(cuts):
        if runs and np.array_equal(cut, cuts[runs[-1][0]]):
            runs[-1][1] = i + 1
        else:
            runs.append([i, i + 1])
    tree, ends, edges = TernaryTree(), {}, {}
    for r in medians_first(len(runs)):
        start, stop = runs[r]
        path = tree.insert(cuts[start].tolist(), stop - start, int(ids[start:stop].min()))
        ends[path[-1]] = ids[start:stop].tolist()
        if r in (0, len(runs) - 1):
            edges[r] = path
    side = dict.fromkeys(edges[len(runs) - 1], _LAST) | dict.fromkeys(edges[0], _FIRST)

    order, parent, depth = tree.walk()
    children, leaves, saved = ([0] * len(tree.code) for _ in range(3))
    for node in reversed(order):
        if node in side:
            continue
        leaves[node] = leaves[node] or 1
        saved[node] += (tree.members[node] - 1) * int(size[places[tree.code[node]]])
        above = parent[node]
        children[above] += 1
        leaves[above] += leaves[node]
        saved[above] += saved[node]

    rows = []
    for node in order:
        counts = (tree.members[node], children[node], leaves[node], saved[node])
        if node not in side:
            above = parent[node]
            rows.append((
                number, None, depth[node], tree.least[node], side.get(above), tree.least[above], *counts,
                ends_hash(ends[node]) if node in ends else _NO_ENDS, None, None, None, None, None,
            ))
            continue
        turn = (0, 0, 0) if node == 0 else tuple(int(c[places[tree.code[node]]]) for c in (code, variant, size))
        here = ends.get(node, [])
        for piece, at in enumerate(range(0, max(1, len(here)), PIECE_IDS)):
            text = ",".join(map(str, here[at : at + PIECE_IDS])) or None
            seen = counts if piece == 0 else (0, 0, 0, 0)
            rows.append((number, side[node], depth[node], tree.least[node], None, None, *seen, None, *turn, piece, text))
    return rows


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, lengths, turns = [], [], []
    for batch in batches:
        listed = batch.column("turns")
        ids.append(batch.column("conv_id").to_numpy())
        lengths.append(listed.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        flat = listed.flatten()
        turns.append([flat.field(name).to_numpy(zero_copy_only=False) for name in ("code", "variant", "bytes")])
    if not sum(map(len, ids)):
        return
    columns = [np.concatenate(c) for c in zip(*turns, strict=True)]
    rows = range_nodes(TaskContext.get().partitionId(), np.concatenate(ids), np.concatenate(lengths), *columns)
    for at in range(0, len(rows), 10_000):
        yield _batch(rows[at : at + 10_000], _RANGE_COLUMNS, _RANGE_TYPES)


@dataclass
class _Open:
    """A node on the current path of the sweep."""

    node: int
    above: int | None
    turn: tuple[int, int]
    bytes: int
    depth: int
    least: int
    members: int = 0
    children: int = 0
    leaves: int = 0
    saved: int = 0
    ends: object = None


# ``node`` of each boundary place (range, side, depth), and, where ``n_convs`` is set, the merged nodes.
_MERGED_SCHEMA = """node bigint, range int, side int, depth bigint, above bigint, conv_id bigint, n_convs bigint, n_children bigint,
  n_leaves bigint, saved_tokens bigint, ends_sha256 string"""
_MERGED_COLUMNS = [c.split()[0] for c in _MERGED_SCHEMA.replace("\n", " ").split(",")]
_MERGED_TYPES = [_ARROW[c.split()[1]] for c in _MERGED_SCHEMA.replace("\n", " ").split(",")]


def merged_boundary(rows: Iterator[dict]) -> Iterator[tuple]:
    """Boundary nodes of all ranges, from their rows in order of range, side, depth and piece.

    The rows of a path go down from the root. A node that is the same turn as the open one at its
    depth is that node; otherwise the open ones from its depth on are complete.
    """
    path: list[_Open] = []
    made = 0

    def close() -> tuple:
        done = path.pop()
        leaves = done.leaves if done.children else 1
        saved = done.saved + (done.members - 1) * done.bytes
        if path:
            path[-1].children += 1
            path[-1].leaves += leaves
            path[-1].saved += saved
        digest = done.ends.hexdigest() if done.ends else _NO_ENDS
        return done.node, None, None, done.depth, done.above, done.least, done.members, done.children, leaves, saved, digest

    for row in rows:
        depth, turn = row["depth"], (row["code"], row["variant"])
        if len(path) <= depth or path[depth].turn != turn:
            while len(path) > depth:
                yield close()
            above = path[-1].node if path else None
            path.append(_Open(made, above, turn, row["bytes"], depth, row["conv_id"]))
            made += 1
        here = path[depth]
        here.least = min(here.least, row["conv_id"])
        here.members += row["n_convs"]
        here.children += row["n_children"]
        here.leaves += row["n_leaves"]
        here.saved += row["saved_tokens"]
        if row["ends"] is not None:
            if here.ends is None:
                here.ends = hashlib.sha256()
            else:
                here.ends.update(b",")
            here.ends.update(row["ends"].encode())
        if row["piece"] == 0:
            yield here.node, row["range"], row["side"], depth, None, None, None, None, None, None, None
    while path:
        yield close()


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in merged_boundary(r for batch in batches for r in batch.to_pylist()):
        held.append(row)
        if len(held) == 10_000:
            yield _batch(held, _MERGED_COLUMNS, _MERGED_TYPES)
            held = []
    if held:
        yield _batch(held, _MERGED_COLUMNS, _MERGED_TYPES)


_RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def prefix_trie(found: DataFrame) -> DataFrame:
    """One row for each node of the trie of ``found (conv_id, turns)``, as ``sequences`` gives it.

    A node is a distinct sequence of the first ``depth`` turns of some conversation, down from the
    root without turns; conversations that begin with it, turnless ones at the root, are
    its members. ``conv_id`` is the least member and, with ``depth``, names the node;
    ``parent_conv_id`` is the parent's (root: NULL). ``n_convs`` counts members, ``n_children`` children,
    ``n_leaves`` childless nodes below, itself included. ``saved_tokens`` adds, over the subtree, (members
    - 1) x bytes of the last turn's text. ``ends_sha256`` hashes the ids of the members with no
    further turn, ascending and comma-joined. Without conversations there is no node.

    Ids are distinct. Ranges are cut by turns and id, so one sequence that a third of all conversations
    have is spread over many ranges. A range is held in a task: some 500 bytes a turn, and
    at least one whole conversation. One task sweeps the boundary: two paths for each range
    of 50,000 turns, and the ids of conversations that end on them.
    """
    found = stored(found.select("conv_id", "turns"), "rebuilt")
    turns = found.agg(F.sum(F.size("turns") + 1)).first()[0] or 0
    ranges = int(-(-turns // RANGE_TURNS)) or 1
    # Ids of a repeated sequence ascend, within a range and from one to the next.
    in_order = found.repartitionByRange(ranges, "turns", "conv_id").sortWithinPartitions("turns", "conv_id")
    nodes = stored(in_order.mapInArrow(_ranges, _RANGE_SCHEMA), "trie-ranges")
    boundary = nodes.where("side is not null").repartition(1).sortWithinPartitions("range", "side", "depth", "piece")
    merged = stored(boundary.mapInArrow(_sweep, _MERGED_SCHEMA), "trie-boundary")

    shared = merged.where("n_convs is not null")
    above = shared.select(F.col("node").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    places = merged.where("n_convs is null").select("range", F.col("side").alias("parent_side"), (F.col("depth") + 1).alias("depth"), "node")
    parents = places.join(shared.select("node", F.col("conv_id").alias("shared_parent")), "node").drop("node")
    inner = nodes.where("side is null").join(parents, ["range", "parent_side", "depth"], "left")
    inner = inner.withColumn("parent_conv_id", F.coalesce("shared_parent", "parent_conv_id"))
    return inner.select(*_RESULT).unionByName(shared.join(above, "above", "left").select(*_RESULT))
