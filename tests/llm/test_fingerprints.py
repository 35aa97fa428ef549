"""Order MinHash against a plain version with the same hash function."""

from __future__ import annotations

import hashlib
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from tallymark.llm import bindings, order_minhash
from tests.llm.cases import SCHEMA, WORDS, documents, prose

FOLDER = "/root/testdata/sf0.001"


def signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def chained(*values) -> int:
    """Spark's hash of several values: each seeds the next."""
    h = 42
    for v in values:
        raw = v.encode() if isinstance(v, str) else (v & (1 << 64) - 1).to_bytes(8, "little") if v >= 1 << 31 or isinstance(v, Long) else (v & (1 << 32) - 1).to_bytes(4, "little")
        h = xxhash.xxh64(raw, seed=h).intdigest()
    return h


class Long(int):
    """An integer hashed as eight bytes."""


def plain(text: str | None) -> str:
    words, seen, kmers = WORDS.findall(text or ""), {}, []
    for i in range(len(words)):
        kmer = chained(*words[i : i + order_minhash.K]) & order_minhash.HASH_MASK
        seen[kmer] = seen.get(kmer, -1) + 1
        kmers.append((kmer, i, signed(chained(Long(kmer), seen[kmer]))))
    kmers.sort()
    out = []
    for seed in range(order_minhash.SEEDS):
        order = sorted((chained(Long(h), seed) & order_minhash.HASH_MASK, at) for at, (_, _, h) in enumerate(kmers))
        for s in range(order_minhash.STARTS):
            begin = (2 * s + 1) * 2**32 / (2 * order_minhash.STARTS)
            around = [at for h, at in order if h >= begin] + [at for h, at in order if h < begin]
            two = sorted((kmers[at][1], kmers[at][0]) for at in (around * 2)[:2])
            out.append(chained(*[Long(k) for _, k in two]) & order_minhash.HASH_MASK if two else 0)
    return "-".join(f"{c:x}" for c in out)


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), SCHEMA).repartition(3)


def test_signatures(docs, spark):
    got = {(r.doc_id, r.fingerprint) for r in order_minhash.signatures(docs).collect()}
    assert got == {(i, plain(t)) for i, t, *_ in documents()}
    assert order_minhash.signatures(spark.createDataFrame([], SCHEMA)).count() == 0


def test_numbers_of_occurrence(spark):
    """Many equal k-mers, so that numbers are searched for, and texts that differ only in how many there are."""
    texts = ["a b " * n for n in (1, 2, 3, 4, 5, 6, 7, 8, 40, 41)] + ["x " * n for n in (1, 2, 5, 300)]
    got = {r.doc_id: r.fingerprint for r in order_minhash.signatures(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)}
    assert len(set(got.values())) == len(texts)


def share(a: str, b: str) -> float:
    pairs = list(zip(a.split("-"), b.split("-")))
    return sum(x == y for x, y in pairs) / len(pairs)


def expected(rows: list[tuple]) -> list[tuple]:
    """Of rows (id, text) with different ids."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        e = edited(t, after)
        a, b = plain(t), plain(e)
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), a, b, share(a, b), share(a, plain(after))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("rows_a_chunk", [3, 2048])
def test_edits(spark, monkeypatch, rows_a_chunk):
    monkeypatch.setattr(order_minhash, "CHUNK_ROWS", rows_a_chunk)
    rows = [(i, t) for i, t in {i: t for i, t, *_ in documents()}.items()]
    frame = spark.createDataFrame([(t, "x", i) for i, t in rows], "text string, fingerprint string, doc_id long").repartition(4)
    got = sorted(map(tuple, order_minhash.fingerprint_edits(frame).collect()), key=repr)
    assert got == expected(rows)


@pytest.mark.parametrize("rows_a_chunk", [2, 2048])
def test_equal_and_null_ids(spark, monkeypatch, rows_a_chunk):
    """Every row is kept, and the texts form one circle however ids repeat."""
    monkeypatch.setattr(order_minhash, "CHUNK_ROWS", rows_a_chunk)
    draw = random.Random(3)
    rows = [(draw.choice([None, 1, 2, 3]), draw.choice(["same text here", prose(9, i)])) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = order_minhash.with_next(frame).select("doc_id", "text", "next_text").collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == sorted((i or 0, t) for i, t in rows)
    assert sorted(r.text for r in got) == sorted(r.next_text for r in got)


def test_thousands_of_chunks(spark, monkeypatch):
    """At 2,048 rows a chunk two million rows make a thousand chunks."""
    monkeypatch.setattr(order_minhash, "CHUNK_ROWS", 1)
    rows = [(3 * i - 900, f"text {i}") for i in range(1500)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    down = rows[::-1]
    got = order_minhash.with_next(frame).select("doc_id", "text", "next_text").collect()
    assert sorted(map(tuple, got)) == sorted((*a, b[1]) for a, b in zip(down, down[1:] + down[:1]))
    chunks = order_minhash._chunked(frame.withColumn("tie", F.xxhash64("text"))).groupBy("chunk").count().collect()
    assert len(chunks) > 1000 and max(r["count"] for r in chunks) <= 3


def test_few_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert order_minhash.fingerprint_edits(none).count() == 0
    one = order_minhash.fingerprint_edits(spark.createDataFrame([(5, "a b c d")], "doc_id long, text string")).collect()
    assert [(r.doc_id, r.n_chars, r.near_next) for r in one] == [(5, 7, 1.0)]
    assert one[0].edited_sha256 == hashlib.sha256(b"a b a b").hexdigest()


def test_order_matters(spark):
    """A text and its shuffled words share k-mers of one word only by chance of order; a small edit stays near."""
    text = prose(400, 8)
    words = text.split(" ")
    small = " ".join(words[:200] + ["changed"] + words[201:])
    swapped = " ".join(words[200:] + words[:200])
    a, b, c = (r.fingerprint for r in order_minhash.signatures(
        spark.createDataFrame(list(enumerate([text, small, swapped])), "doc_id long, text string")).orderBy("doc_id").collect())
    assert share(a, b) > 0.9 and 0.2 < share(a, c) < 0.8


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    got = sorted(map(tuple, bindings.QUERIES["op11_order_minhash"](spark, FOLDER).collect()), key=repr)
    assert got == expected(rows)


def test_no_python_in_the_plan(spark):
    plan = bindings.QUERIES["op11_order_minhash"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
