"""Runs of words: stretches that repeat with a period, found by block convolution.

A run is a stretch of consecutive words with smallest period q that no neighbouring word extends, and at
least ``LEAST_WORDS`` words and ``LEAST_COPIES`` periods long. For periods from L to 2 L - 1 (L a power of two)
words are cut in blocks of L. For each block the sum of squared differences to every place of the following window
is computed by one convolution, a number-theoretic transform in exact integers; places where it is zero
are occurrences of the block, and their distances are possible periods. A run of that period
holds a whole block and its next occurrence, so none is missed. Each distance is then extended
to both sides as far as words that far apart are equal, and what is long enough is a run.

Words stand in the sums as residues drawn from a 64-bit hash, so that a zero can be an accident modulo the prime, but
never be missed; the extension compares the stretches again, by two independent prefix hashes. Blocks inside a
run that is already known need no further look: other distances there are multiples of its period.

Texts are handled in tasks, in chunks, without a shuffle; memory follows the longest text.

Defined cases: null, empty and blank texts have no words, no runs and an empty collapsed text; words are compared by
bytes; texts are judged whole, repeated rows one by one, null ids like others; an empty table gives an
empty table; other columns are kept, those named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallymark.llm import flat, passing

LEAST_WORDS, LEAST_COPIES = 6, 4
# The prime 3 * 2^30 + 1 and a primitive root of it.
PRIME, ROOT = 3 * 2**30 + 1, 5
#: Points transformed at once, a size that stays in a core's cache.
POINTS = 1 << 16

_P = np.uint64(PRIME)
_tables: dict[tuple[int, bool], np.ndarray] = {}


def _reduced(x: np.ndarray) -> np.ndarray:
    return x - (x // _P) * _P


def _sum(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x + y of residues; the smaller of the two is right, as a difference below zero wraps around."""
    s = x + y
    return np.minimum(s, s - _P)


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo the prime."""
    out, have = np.ones(n, np.uint64), 1
    while have < n:
        m = min(have, n - have)
        out[have : have + m] = _reduced(out[:m] * np.uint64(pow(base, have, PRIME)))
        have += m
    return out


def _twiddles(half: int, back: bool) -> np.ndarray:
    if (half, back) not in _tables:
        root = pow(ROOT, (PRIME - 1) // (2 * half), PRIME)
        _tables[half, back] = _powers(pow(root, -1, PRIME) if back else root, half)[:, None]
    return _tables[half, back]


def _transform(a: np.ndarray) -> None:
    """Transform the columns of ``a`` in place; the result is in bit-reversed order."""
    half = len(a) // 2
    while half:
        pair = a.reshape(-1, 2, half, a.shape[1])
        u, v = pair[:, 0], pair[:, 1]
        low = _sum(u, v)
        pair[:, 1] = _reduced(_sum(u, _P - v) * _twiddles(half, False))
        pair[:, 0] = low
        half //= 2


def _transform_back(a: np.ndarray) -> np.ndarray:
    """The inverse, from bit-reversed order."""
    half = 1
    while half < len(a):
        pair = a.reshape(-1, 2, half, a.shape[1])
        u, v = pair[:, 0], _reduced(pair[:, 1] * _twiddles(half, True))
        low = _sum(u, v)
        pair[:, 1] = _sum(u, _P - v)
        pair[:, 0] = low
        half *= 2
    return _reduced(a * np.uint64(pow(len(a), -1, PRIME)))


def _matches(codes: np.ndarray, squares: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, distance) where the block at ``starts`` may stand again ``distance`` words on, size <= distance < 2 size.

    ``squares``: sums of the squared codes before each place.
    """
    blocks, far, last = [], [], len(codes) - 1
    step = max(1, POINTS // (2 * size))
    for at in range(0, len(starts), step):
        here = starts[at : at + step]
        place = np.arange(size)[:, None] + here
        x = np.zeros((2 * size, len(here)), np.uint64)
        x[(-np.arange(size)) % (2 * size)] = codes[place]
        y = codes[np.minimum(np.arange(size, 3 * size)[:, None] + here, last)]
        _transform(x)
        _transform(y)
        products = _transform_back(_reduced(x * y))[:size]
        begin = np.minimum(place + size, last + 1)
        squared = squares[np.minimum(begin + size, last + 1)] - squares[begin]
        own = squares[here + size] - squares[here]
        t, b = np.nonzero(_reduced(squared + own) == _reduced(products + products))
        blocks.append(b + at)
        far.append(t + size)
    return np.concatenate(blocks), np.concatenate(far)


class Stretches:
    """Lengths of equal stretches of words, by sums of codes times powers of two bases."""

    def __init__(self, codes: np.ndarray):
        self.sums, self.powers = [], []
        for base in (0x5851F42D % PRIME, 0x14057B7E % PRIME):
            up = _powers(base, len(codes) + 1)
            sums = np.zeros(len(codes) + 1, np.uint64)
            np.cumsum(_reduced(codes * up[:-1]), dtype=np.uint64, out=sums[1:])
            self.sums.append(sums)
            self.powers.append(up)

    def equal(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the n words from a equal those from b (b >= a)."""
        same = np.ones(len(a), bool)
        for sums, up in zip(self.sums, self.powers):
            same &= _reduced(_reduced(sums[a + n] - sums[a]) * up[b - a]) == _reduced(sums[b + n] - sums[b])
        return same

    def longest(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool = False) -> np.ndarray:
        """The largest n up to ``most`` for which the n words from (or, if ``back``, before) a and b are equal."""
        low, high = np.zeros(len(a), np.int64), most.astype(np.int64)
        while (low < high).any():
            middle = (low + high + 1) // 2
            shift = middle if back else 0
            same = self.equal(a - shift, b - shift, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low


def find_runs(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs, by start and period; ``words``: a hash for each word; ``at``: where texts begin.

    Starts and ends count from the first word of all texts.
    """
    size = np.diff(at)
    codes = _reduced(flat.mixed(words))
    squares = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_reduced(codes * codes), dtype=np.uint64, out=squares[1:])
    stretches = Stretches(codes) if len(codes) else None
    runs = np.zeros((0, 3), np.int64)
    scale = 1
    while len(some := np.flatnonzero(size >= max(LEAST_WORDS, LEAST_COPIES * scale))):
        n_blocks = size[some] // scale - 1
        text = np.repeat(some, n_blocks)
        begin, end = at[text], at[text + 1]
        starts = begin + scale * (np.arange(len(text)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks))
        # how far the known runs reach that hold a block's first word
        reach = np.zeros(len(codes), np.int64)
        np.maximum.at(reach, runs[:, 0], runs[:, 1])
        reach = np.maximum.accumulate(reach)[starts]
        open_ = np.flatnonzero(reach < np.minimum(starts + 3 * scale - 1, end))
        if len(open_):
            starts, begin, end = starts[open_], begin[open_], end[open_]
            block, far = _matches(codes, squares, starts, scale)
            inside = (starts[block] + far + scale <= end[block]) & (LEAST_COPIES * far <= end[block] - begin[block])
            block, far = block[inside], far[inside]
            a, begin, end = starts[block], begin[block], end[block]
            right = stretches.longest(a, a + far, end - a - far)
            left = stretches.longest(a, a + far, a - begin, back=True)
            enough = (right >= scale) & (left + far + right >= np.maximum(LEAST_WORDS, LEAST_COPIES * far))
            new = np.stack([a - left, a + far + right, far], axis=1)[enough]
            runs = _smallest_periods(np.concatenate([runs, new]))
        scale *= 2
    order = np.lexsort([runs[:, 2], runs[:, 0]])
    return tuple(runs[order].T)


def _smallest_periods(runs: np.ndarray) -> np.ndarray:
    """One run per stretch: the one with the smallest period, of which the others are multiples."""
    runs = runs[np.lexsort([runs[:, 2], runs[:, 1], runs[:, 0]])]
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    return runs[first]


def repeated_words(runs: tuple[np.ndarray, np.ndarray, np.ndarray], n: int) -> np.ndarray:
    """Which of n words lie in a run after its first period."""
    start, end, period = runs
    delta = np.bincount(start + period, minlength=n + 1) - np.bincount(end, minlength=n + 1)
    return np.cumsum(delta[:n]) > 0


def _joined(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, each: np.ndarray) -> pa.Array:
    """Words joined by one blank, ``each`` of them a text."""
    length = ends - begins + 1
    to = np.concatenate([[0], np.cumsum(length)])
    place = np.arange(to[-1]) + np.repeat(begins - to[:-1], length)
    out = np.append(data, np.uint8(0x20))[np.minimum(place, len(data))]
    out[to[1:] - 1] = 0x20
    # no blank after a text's last word
    word_at = np.concatenate([[0], np.cumsum(each)])
    gone = to[word_at[1:][each > 0]] - 1
    bounds = to[word_at] - np.concatenate([[0], np.cumsum(each > 0)])
    return pa.Array.from_buffers(
        pa.large_string(), len(each), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.delete(out, gone))]
    ).cast(pa.string())


def _runs_of(data: np.ndarray, bounds: np.ndarray) -> list[pa.Array]:
    begins, ends, n_words = flat.words(data, bounds)
    at = np.concatenate([[0], np.cumsum(n_words)])
    runs = find_runs(flat.hashes(data, begins, ends), at)
    start, end, period = runs
    kept = ~repeated_words(runs, len(begins))
    run_at = np.searchsorted(start, at)
    rows = pa.StructArray.from_arrays(
        [pa.array(start - np.repeat(at[:-1], np.diff(run_at))), pa.array(end - start), pa.array(period)], ["start", "length", "period"]
    )
    each = flat.per_text(kept, at)
    return [
        pa.array(n_words.astype(np.int64)), pa.ListArray.from_arrays(run_at.astype(np.int32), rows),
        _joined(data, begins[kept], ends[kept], each),
    ]


def detect_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with ``n_words``, ``runs`` (by start, then period) and ``collapsed``.

    A run has ``start`` (number of its first word), ``length`` and ``period``. The collapsed text has one period of each
    run and the words outside of runs, joined by blanks.
    """
    new = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return passing.add_columns(docs, text, new, _runs_of)
