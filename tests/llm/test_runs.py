"""Periodic runs against a search of every period, and the query against plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from tallymark.llm import bindings, flat, periodic_runs
from tests.llm.cases import SCHEMA, WORDS, documents

FOLDER = "/root/testdata/sf0.001"


def plain_runs(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period): every maximal stretch for every period, smallest periods only."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - s >= max(6, 4 * q):
                found.setdefault((s, i + q - s), q)
    return sorted((s, m, q) for (s, m), q in found.items())


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def detected(texts: list[list[int]]) -> list[list[tuple[int, int, int]]]:
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    words = flat.mixed(np.array([w for t in texts for w in t], np.uint64) + np.uint64(1))
    start, end, period = periodic_runs.find_runs(words, at)
    out = [[] for _ in texts]
    for s, e, q in zip(start.tolist(), end.tolist(), period.tolist()):
        t = int(np.searchsorted(at, s, "right")) - 1
        out[t].append((s - int(at[t]), e - s, q))
    return out


def fibonacci(n: int) -> list[int]:
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def cases() -> list[list[int]]:
    draw = random.Random(5)
    out = [[], [1], [1] * 5, [1] * 6, [1] * 1000, [1, 2] * 3, [1, 2] * 4, [1, 2] * 300 + [1], fibonacci(700)]
    out.append([bin(i).count("1") % 2 for i in range(600)])
    for _ in range(150):
        out.append([draw.randrange(draw.choice([1, 2, 2, 3, 9])) for _ in range(draw.randrange(120))])
    for _ in range(60):  # periodic stretches next to and over each other, also of periods that are powers of two or next to them
        t: list[int] = []
        for _ in range(draw.randrange(1, 5)):
            unit = [draw.randrange(4) for _ in range(draw.choice([1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 31, 33]))]
            m = draw.randrange(len(unit) * 6 + 1)
            t += (unit * 7)[:m] + [draw.randrange(4) for _ in range(draw.randrange(4))]
        out.append(t)
    out.append([i % 97 for i in range(97 * 4)])
    out.append([i % 97 for i in range(97 * 4 - 1)])
    return out


def test_every_run_is_found():
    texts = cases()
    assert detected(texts) == [plain_runs(t) for t in texts]
    for t in texts[:40]:
        assert detected([t]) == [plain_runs(t)]


def test_small_sets_of_points(monkeypatch):
    """However many blocks are transformed at once, the result is the same."""
    texts = cases()
    want = detected(texts)
    monkeypatch.setattr(periodic_runs, "POINTS", 8)
    assert detected(texts[:60]) == want[:60]


def test_transform_is_exact():
    """Products of the transforms are the cyclic convolution in integers."""
    draw = np.random.default_rng(1)
    for n in (2, 4, 32):
        x, y = (draw.integers(0, periodic_runs.PRIME, (n, 3), np.uint64) for _ in range(2))
        want = [[sum(int(x[i, c]) * int(y[(k - i) % n, c]) for i in range(n)) % periodic_runs.PRIME for c in range(3)] for k in range(n)]
        periodic_runs._transform(x)
        periodic_runs._transform(y)
        got = periodic_runs._transform_back(periodic_runs._reduced(x * y))
        assert got.tolist() == want


def test_long_text():
    """A period of 5,000 words in a text of 40,000, beside a run of one word."""
    draw = random.Random(2)
    unit = [draw.randrange(10**6) for _ in range(5000)]
    text = [draw.randrange(10**6) for _ in range(3000)] + (unit * 5)[:22000] + [7] * 15000
    (runs,) = detected([text])
    assert (25000, 15000, 1) in runs and any(q == 5000 and 22000 <= m <= 22001 for _, m, q in runs) and len(runs) == 2


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, r[0]) for r in documents()] + [(90, "a b " * 40 + "c", None, 0.1, "k", 1)]
    return spark.createDataFrame(rows, SCHEMA + ", runs long").repartition(3)


def test_detect_runs(docs, spark):
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs.detect_runs(docs).collect()), key=repr)
    want = []
    for i, t, *_ in [*documents(), (90, "a b " * 40 + "c")]:
        words = WORDS.findall(t or "")
        runs = plain_runs(words) if len(words) < 1000 else plain_runs(words[:3000])
        if len(words) >= 1000:
            assert runs == []
        want.append((i, len(words), runs, collapsed(words, runs)))
    assert got == sorted(want, key=repr)
    assert periodic_runs.detect_runs(docs).columns == ["doc_id", "text", "source", "score", "kept", "n_words", "runs", "collapsed"][:0] + [
        c for c in docs.columns if c != "runs"] + ["n_words", "runs", "collapsed"]
    assert periodic_runs.detect_runs(spark.createDataFrame([], SCHEMA)).count() == 0


def expected(doc_id, text) -> tuple:
    words = WORDS.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    digest = [hashlib.sha256(t.encode()).hexdigest() for t in (listed, collapsed(words, runs))]
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *digest)


def test_query(spark, tmp_path):
    """Documents of the smallest table (texts of up to 1,500 words) and the special cases."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    rows = [r for r in rows if len(WORDS.findall(r[1] or "")) <= 1500]
    rows += [(1000 + (i or 0), t) for i, t, *_ in documents() if len(t or "") < 9000] + [(None, "w " * 30)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    out = bindings.QUERIES["op13_periodic_runs"](spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = sorted(map(tuple, out.collect()), key=repr)
    assert got == sorted((expected(*r) for r in rows), key=repr)
    assert sum(r[1] > 0 for r in got) > len(rows) // 15
