"""Suffix arrays by induced sorting, and how far neighbouring suffixes agree, with whole-array operations.

Suffixes are classified as smaller (S) or larger (L) than the next one. The substrings between leftmost-smaller positions are named in
order, and the string of these names is sorted by the same idea applied again, names being joined in pairs until they differ. From the sorted
leftmost-smaller suffixes all L and then all S suffixes are induced, one pass over the buckets each.
"""

from __future__ import annotations

import numpy as np

SEPARATOR = 0


def types(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last is, as if the smallest symbol stood before it."""
    n = len(s)
    change = np.flatnonzero(s[1:] != s[:-1])
    rises = s[change] < s[change + 1]
    # Equal neighbours have the type of the last of their run.
    runs = np.diff(np.concatenate(([-1], change, [n - 1])))
    out = np.repeat(np.append(rises, False), runs)
    out[-1] = True
    return out


def leftmost_smaller(small: np.ndarray) -> np.ndarray:
    return np.flatnonzero(small[1:] & ~small[:-1]) + 1


def _refined(name: np.ndarray, key: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names (the place of the first of equals in order) after ``live``, those not alone with theirs, are told apart by
    ``key`` too; and who is still not alone."""
    order = np.lexsort((key, name[live])) if name.any() else np.argsort(key)
    live, key = live[order], key[order]
    old = name[live]
    fresh = np.ones(len(live), bool)
    fresh[1:] = old[1:] != old[:-1]
    split = fresh.copy()
    split[1:] |= key[1:] != key[:-1]
    at = np.arange(len(live))
    group, part = np.maximum.accumulate(np.where(fresh, at, 0)), np.maximum.accumulate(np.where(split, at, 0))
    name = name.copy()
    name[live] = old + part - group
    alone = split & np.append(split[1:], True)
    return name, live[~alone]


def sorted_leftmost(s: np.ndarray, small: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """The leftmost-smaller positions in the order of their suffixes, by at least ``depth`` symbols."""
    if not len(at):
        return at
    # Names of the substrings up to and with the next such position: seven symbols of nine bits at a time.
    size = np.diff(np.append(at, len(s) - 1)) + 1
    symbols = np.zeros(len(s) + 8, np.uint64)
    symbols[: len(s)] = s.astype(np.uint64) * np.uint64(2) + small.astype(np.uint64) + np.uint64(1)
    name, live = np.zeros(len(at), np.int64), np.arange(len(at))
    for done in range(0, int(size.max()), 7):
        packed = np.zeros(len(live), np.uint64)
        for i in range(7):
            symbol = np.where(size[live] > done + i, symbols[np.minimum(at[live] + done + i, len(s))], 0).astype(np.uint64)
            packed |= symbol << np.uint64(9 * (6 - i))
        name, live = _refined(name, packed, live)
    # The string of names, sorted by pairs of names, pairs of pairs, and so on; each name is at least two symbols long.
    reach = 1
    while len(live) and reach <= depth:
        follow = np.where(live + reach < len(name), name[np.minimum(live + reach, len(name) - 1)] + 1, 0)
        name, live = _refined(name, follow, live)
        reach *= 2
    return at[np.argsort(name, kind="stable")]


class _Buckets:
    """Positions by their symbol, each bucket in the order of arrival."""

    def __init__(self) -> None:
        self.parts: list[list[np.ndarray]] = [[] for _ in range(256)]

    def add(self, positions: np.ndarray, symbols: np.ndarray) -> None:
        if len(positions):
            order = np.argsort(symbols, kind="stable")
            positions, symbols = positions[order], symbols[order]
            cuts = np.flatnonzero(symbols[1:] != symbols[:-1]) + 1
            for part, c in zip(np.split(positions, cuts), symbols[np.concatenate(([0], cuts))], strict=True):
                self.parts[c].append(part)

    def take(self, c: int) -> np.ndarray:
        return np.concatenate(self.parts[c]) if self.parts[c] else np.zeros(0, np.int64)


def _induce(s: np.ndarray, wanted: np.ndarray, seeds: list[np.ndarray], upward: bool) -> list[np.ndarray]:
    """Bucket by bucket, the wanted positions in order of arrival: each follows from its successor's place."""
    queue, out = _Buckets(), [np.zeros(0, np.int64)] * 256
    if upward and len(s) > 1:
        # The last suffix comes before all others, so what it induces comes first.
        queue.add(np.array([len(s) - 2]), s[-2:-1])
    for c in range(256) if upward else range(255, -1, -1):
        held, wave = [], queue.take(c)
        while len(wave):
            held.append(wave)
            before = wave[wave > 0] - 1
            before = before[wanted[before]]
            symbols = s[before]
            same = symbols == c
            queue.add(before[~same], symbols[~same])
            wave = before[same]
        out[c] = np.concatenate(held) if held else out[c]
        before = seeds[c][seeds[c] > 0] - 1
        before = before[wanted[before]]
        queue.add(before, s[before])
    return out


def suffix_array(s: np.ndarray, depth: int) -> np.ndarray:
    """Positions of s (bytes, the last a SEPARATOR) in the order of their suffixes, by at least ``depth`` symbols."""
    small = types(s)
    left = sorted_leftmost(s, small, leftmost_smaller(small), depth)
    left = left[left < len(s) - 1]
    starts = s[left]
    by_symbol = [left[starts == c] for c in range(256)]
    large = _induce(s, ~small, by_symbol, upward=True)
    smaller = _induce(s, small, [part[::-1] for part in large], upward=False)
    # The last suffix is only a separator: nothing induces it, and it is the first.
    parts = [np.array([len(s) - 1])]
    for c in range(256):
        parts += [large[c], smaller[c][::-1]]
    return np.concatenate(parts)


def permuted_prefixes(s: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """For each position, in how many symbols its suffix agrees with the one before it in order, at most ``depth``.

    In text order a prefix is at most one shorter than its left neighbour's, so the places are independent enough to
    be extended all at once, eight symbols at a time; those that differ drop out.
    """
    n = len(s)
    before = np.full(n, n, np.int64)
    before[order[1:]] = order[:-1]
    padded = np.zeros(n + 16 + depth, np.uint8)
    padded[:n] = s
    words = np.zeros(n + 8 + depth, np.uint64)
    for i in range(8):
        words |= padded[i : i + len(words)].astype(np.uint64) << np.uint64(8 * i)
    agreed = np.zeros(n, np.int32)
    live = np.arange(n)
    for done in range(0, depth, 8):
        differ = words[live + done] ^ words[before[live] + done]
        equal = differ == 0
        stop = live[~equal]
        low = differ[~equal]
        low &= np.uint64(0) - low  # the lowest set bit tells the first symbol that differs
        agreed[stop] = done + (np.log2(low.astype(np.float64)).astype(np.int32) >> 3)
        live = live[equal]
        agreed[live] = done + 8
        if not len(live):
            break
    limit = np.minimum(n - before, n - np.arange(n))
    return np.minimum(np.minimum(agreed, depth), limit).astype(np.int32)
