"""Merging sorted runs of byte strings without comparing a known common prefix twice."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of two strings that agree in their first ``known`` bytes."""
    n = min(len(a), len(b))
    x, y = a[known:n], b[known:n]
    if x == y:
        return n
    differing = int.from_bytes(x) ^ int.from_bytes(y)
    return n - (differing.bit_length() + 7) // 8


def front_coded(rows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Common prefix of each string with the one before, and the bytes that follow it.

    ``rows`` has the sorted strings, padded with zeros; all are at most 255 bytes long.
    """
    lcp = neighbour_prefix(rows, lengths)
    place = np.arange(rows.shape[1])
    return lcp.astype(np.uint8), rows[(place >= lcp[:, None]) & (place < lengths[:, None])]


def neighbour_prefix(rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Common prefix of each row with the one before; 0 for the first."""
    out = np.zeros(len(rows), np.int64)
    if len(rows) > 1 and rows.shape[1]:
        differ = rows[1:] != rows[:-1]
        same = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
        out[1:] = np.minimum(same, np.minimum(lengths[1:], lengths[:-1]))
    return out


def decoded(lcp: np.ndarray, lengths: np.ndarray, tail: bytes) -> Iterator[tuple[int, bytes]]:
    """Strings of a front-coded run with their common prefixes, one at a time."""
    at, last = 0, b""
    for shared, length in zip(lcp.tolist(), lengths.tolist(), strict=True):
        end = at + length - shared
        last = last[:shared] + tail[at:end]
        at = end
        yield shared, last


def merged(runs: list[Iterator[tuple[int, bytes]]]) -> Iterator[tuple[int, int, bytes]]:
    """``(run, common prefix with the string before, string)`` of all runs in order.

    A loser tree whose nodes keep, with each loser, its common prefix with the last string that
    went out. Of two strings the one with the longer such prefix is the smaller; only if
    both are equal are further bytes compared, from there on. Equal strings come in the
    order of runs.
    """
    size = 1
    while size < len(runs):
        size *= 2
    heads: list[tuple[int, bytes]] = [next(r, (-1, b"")) for r in runs] + [(-1, b"")] * (size - len(runs))
    prefix = [0 if h[0] >= 0 else -1 for h in heads]  # nothing went out yet
    text = [h[1] for h in heads]

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's prefix becomes that with the winner."""
        if prefix[a] != prefix[b]:
            return (a, b) if prefix[a] > prefix[b] else (b, a)
        if prefix[a] < 0:
            return a, b
        x, y = text[a], text[b]
        shared = common_prefix(x, y, prefix[a])
        if shared == len(x) and (shared < len(y) or a < b):
            win, lose = a, b
        elif shared == len(y) or x[shared] > y[shared]:
            win, lose = b, a
        else:
            win, lose = a, b
        prefix[lose] = shared
        return win, lose

    losers = [0] * size
    level = list(range(size))
    first = size // 2
    while len(level) > 1:
        won = []
        for i in range(0, len(level), 2):
            win, lose = play(level[i], level[i + 1])
            losers[first + i // 2] = lose
            won.append(win)
        level, first = won, first // 2
    win = level[0]
    while prefix[win] >= 0:
        yield win, prefix[win], text[win]
        prefix[win], text[win] = next(runs[win], (-1, b""))
        node = (size + win) // 2
        while node:
            other = losers[node]
            if prefix[win] != prefix[other]:
                if prefix[other] > prefix[win]:
                    losers[node], win = win, other
            else:
                win, losers[node] = play(win, other)
            node //= 2
