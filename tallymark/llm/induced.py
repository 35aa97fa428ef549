"""Suffix arrays by induced sorting, and permuted common prefixes, in whole-array steps.

Suffixes are classified as smaller or larger than the next one. The substrings between
leftmost-smaller suffixes are sorted by one round of induction and named; the string of names is
sorted; a second round of induction sorts all suffixes. Induction goes through the buckets of first
characters in order, and through a bucket in waves: what a wave puts into its own bucket is the
next wave.

The string of names has an alphabet too large for buckets to pay, so its suffixes are ranked by
doubling, which takes as many rounds as the longest repeat has binary digits.
"""

from __future__ import annotations

import numpy as np


def _smaller(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the last is the smallest of all."""
    n = len(t)
    turn = np.flatnonzero(t[:-1] != t[1:])
    out = np.zeros(n, bool)
    out[-1] = True
    at = np.searchsorted(turn, np.arange(n - 1))
    out[:-1] = t[turn[at]] < t[turn[at] + 1]
    return out


def _push(out: np.ndarray, head: np.ndarray, step: int, chars: np.ndarray, what: np.ndarray) -> None:
    """Append to the buckets of ``chars``, in order, moving their heads by ``step``."""
    order = np.argsort(chars, kind="stable")
    chars, what = chars[order], what[order]
    first = np.flatnonzero(np.concatenate([[True], chars[1:] != chars[:-1]]))
    size = np.diff(np.append(first, len(chars)))
    rank = np.arange(len(chars)) - np.repeat(first, size)
    out[head[chars] + step * rank] = what
    head[chars[first]] += step * size


def induce(t: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, letters: int) -> np.ndarray:
    """All suffixes in order, from the leftmost-smaller ones in order."""
    n = len(t)
    size = np.bincount(t, minlength=letters)
    begin = np.cumsum(size) - size
    larger_n = np.bincount(t[~smaller], minlength=letters)
    out = np.zeros(n, np.int32)
    seed_t = t[seeds]
    by = np.argsort(seed_t, kind="stable")
    seeds, seed_n = seeds[by], np.bincount(seed_t, minlength=letters)
    seed_at = np.concatenate([[0], np.cumsum(seed_n)])
    used = np.flatnonzero(size)
    # larger suffixes, from the front
    head = begin.copy()
    for c in used:
        at = begin[c]
        while at < head[c]:
            wave = out[at : head[c]]
            at = head[c]
            before = wave[wave > 0] - 1
            before = before[~smaller[before]]
            if len(before):
                _push(out, head, 1, t[before], before)
        if seed_n[c]:
            wave = seeds[seed_at[c] : seed_at[c + 1]]
            before = wave[wave > 0] - 1
            if len(before):
                _push(out, head, 1, t[before], before)
    out[0] = n - 1  # the empty suffix, which nothing induces
    # smaller suffixes, from the back
    head = begin + size - 1
    for c in used[::-1]:
        at = begin[c] + size[c] - 1
        while at > head[c]:
            wave = out[head[c] + 1 : at + 1][::-1]
            at = head[c]
            before = wave[wave > 0] - 1
            before = before[smaller[before]]
            if len(before):
                _push(out, head, -1, t[before], before)
        wave = out[begin[c] : begin[c] + larger_n[c]][::-1]
        before = wave[wave > 0] - 1
        before = before[smaller[before]]
        if len(before):
            _push(out, head, -1, t[before], before)
    return out


def _ranked(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names."""
    rank, k = names.astype(np.int64), 1
    while True:
        n = len(rank)
        if int(rank.max()) + 1 == n:
            return np.argsort(rank, kind="stable")
        nxt = np.zeros(n, np.int64)
        nxt[: n - k] = rank[k:] + 1
        key = rank * (n + 1) + nxt
        order = np.argsort(key, kind="stable")
        s = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(s[1:] != s[:-1])])
        k *= 2


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes of a text of small non-negative numbers in order; the empty suffix comes first."""
    t = np.concatenate([text.astype(np.uint16) + 1, [0]]).astype(np.uint16)
    n, letters = len(t), int(t.max()) + 1
    if n == 1:
        return np.zeros(1, np.int32)
    smaller = _smaller(t)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    rough = induce(t, smaller, lms, letters)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    order = rough[is_lms[rough]]
    # substrings up to and with the next leftmost-smaller suffix
    end = np.empty(n, np.int64)
    end[lms] = np.append(lms[1:] + 1, n)
    length = end[order] - order
    same = np.zeros(len(order), bool)
    like = np.flatnonzero(length[1:] == length[:-1]) + 1
    if len(like):
        size = length[like]
        at = np.cumsum(size) - size
        inside = np.arange(int(size.sum())) - np.repeat(at, size)
        equal = t[np.repeat(order[like], size) + inside] == t[np.repeat(order[like - 1], size) + inside]
        same[like] = np.logical_and.reduceat(equal, at)
    name = np.empty(n, np.int64)
    name[order] = np.cumsum(~same) - 1
    seeds = lms[_ranked(name[lms])]
    return induce(t, smaller, seeds, letters)


def common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each suffix (by position) how many characters it shares with the one before it in order.

    Where the characters before the two agree, the number is one less than at the position
    before; only the others are compared, by words of eight characters.
    """
    n = len(text)
    before = np.full(n + 1, -1, np.int64)
    before[order[1:]] = order[:-1]
    before = before[:n]
    place = np.arange(n)
    has = before >= 0
    carried = np.zeros(n, bool)
    carried[1:] = has[1:] & (before[1:] > 0) & (text[:-1] == text[np.maximum(before[1:] - 1, 0)]) & (before[1:] < n)
    padded = np.zeros(n + 16, text.dtype)
    padded[:n] = text
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    out = np.zeros(n, np.int64)
    live = np.flatnonzero(has & ~carried)
    i, j = live.copy(), before[live]
    while len(live):
        eq = (words[np.minimum(i, n + 8)] == words[np.minimum(j, n + 8)])
        run = np.where(eq.all(axis=1), 8, np.argmin(eq, axis=1))
        run = np.minimum(run, np.minimum(n - i, n - j))
        out[live] += run
        go = (run == 8) & (np.maximum(i, j) + 8 < n)
        live, i, j = live[go], i[go] + 8, j[go] + 8
    root = np.maximum.accumulate(np.where(carried, 0, place))
    return np.maximum(out[root] - (place - root), 0)
