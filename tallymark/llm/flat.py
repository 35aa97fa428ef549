"""Texts of an Arrow column as one flat byte array, with words, lines and hashes by numpy.

A null text is an empty one. Work goes in small chunks, so that a task's memory
depends on the longest text, not on the number of texts.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 19

# Blank characters are space and tab to carriage return.
BLANK = np.zeros(256, bool)
BLANK[[0x20, 9, 10, 11, 12, 13]] = True
#: Lower case of A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes that begin a code point.
LEADS = (np.arange(256) & 0xC0) != 0x80

_draw = np.random.default_rng(20240611)
BYTE_CODE = _draw.integers(1, 2**64, 256, np.uint64)
STEP = np.uint64(0x9E3779B97F4A7C15 | 1)
STEP_BACK = np.uint64(pow(int(STEP), -1, 2**64))


def give_back() -> None:
    """Return memory that is free to the system: a worker lives on after its task, next to others."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries keep what is freed, and have this
    if trim is not None:
        trim(0)


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins (one entry more than texts)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def spans(bounds: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``limit`` bytes together, or of one longer text."""
    at, n = 0, len(bounds) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, "right")) - 1)
        yield at, min(to, n)
        at = min(to, n)


def chunks(column: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, last text + 1, bytes, bounds) of each chunk."""
    data, bounds = flat(column)
    for a, b in spans(bounds, limit):
        yield a, b, data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word, and how many words each text has."""
    solid = ~BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    before = np.empty(len(data), bool)
    after = np.empty(len(data), bool)
    if len(data):
        before[0], before[1:] = False, solid[:-1]
        after[-1], after[:-1] = False, solid[1:]
    begins = np.flatnonzero(solid & (~before | edge[:-1]))
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return begins, ends, np.diff(np.searchsorted(begins, bounds))


def lines(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every line (split at line feeds), and how many each text has (1 if empty)."""
    feeds = np.flatnonzero(data == 10)
    each = np.diff(np.searchsorted(feeds, bounds)) + 1
    begins = np.sort(np.concatenate([bounds[:-1], feeds + 1]), kind="stable")
    ends = np.sort(np.concatenate([feeds, bounds[1:]]), kind="stable")
    return begins, ends, each


_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the step and of its inverse, modulo 2^64."""
    have = _powers.get("up")
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        for name, base in (("up", STEP), ("down", STEP_BACK)):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            _powers[name] = np.cumprod(out, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range, equal for equal bytes wherever they stand."""
    up, down = _power(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODE[data] * up[:-1], dtype=np.uint64, out=sums[1:])
    return mixed((sums[ends] - sums[begins]) * down[begins] + (ends - begins).astype(np.uint64))


def per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` over each text's range."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, dtype=np.int64, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def repeats(keys: np.ndarray, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Positions (of ``keys``, or taken from ``at``) whose key occurs more than once; and of these
    the ones that are not the first occurrence.
    """
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    later = np.zeros(len(keys), bool)
    later[order[1:][same]] = True
    any_ = later.copy()
    any_[order[:-1][same]] = True
    at = np.arange(len(keys)) if at is None else at
    return at[any_], at[later]


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n items lie in a window [start, start + length)."""
    delta = np.bincount(starts, minlength=n + 1) - np.bincount(starts + length, minlength=n + 1)
    return np.cumsum(delta[:n]) > 0


_CODEC = pa.Codec("zstd", compression_level=1)


def squeezed(values: np.ndarray) -> bytes:
    """An array's bytes, first bytes of all values first, compressed: ids and counts shrink to what they hold."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize).T.tobytes()
    return len(raw).to_bytes(8, "little") + _CODEC.compress(raw, asbytes=True)


def opened(data: bytes | pa.Buffer, kind: type) -> np.ndarray:
    """The array of ``squeezed`` bytes."""
    data = memoryview(data)
    raw = _CODEC.decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True) if len(data) > 8 else b""
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).ravel()
