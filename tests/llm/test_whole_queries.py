"""Columns of the registered queries, and every stage of the pipeline, against plain Python on the smallest tables."""

from __future__ import annotations

import collections
import hashlib
import math
import zlib

import pytest

from tallymark.llm import bindings, classifier, line_dedup, sentencepiece
from tests.llm.cases import LOWER, WORDS
from tests.llm.test_corpus import as_kind, wanted

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def rest(i: int, n: int) -> int:
    return zlib.crc32(str(i).encode()) % n


def words(text: str | None) -> list[str]:
    return WORDS.findall((text or "").translate(LOWER))


def test_op1_columns(spark, texts):
    got = {r.doc_id: r for r in bindings.op1_lm_scoring(spark, FOLDER).collect()}
    counts = collections.Counter()
    for i, r in texts.items():
        if rest(i, 7) != 2:
            counts.update([*words(r.text), None])
    n, v = sum(counts.values()), len(counts)
    assert set(got) == set(texts)
    for i, r in texts.items():
        tokens = [*words(r.text), None]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)
        g = got[i]
        assert (g.held_out, g.n_tokens, g.n_known, g.train_tokens) == (rest(i, 7) == 2, len(tokens), sum(counts[w] > 0 for w in tokens), n)
        assert g.score < 0 and g.base_score == pytest.approx(base)


def test_op4_columns(spark, texts):
    got = {r.doc_id: r for r in bindings.op4_quality_classifier(spark, FOLDER).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    assert set(got) == set(texts)
    for i, g in got.items():
        assert g.held_out == (rest(i, 3) == 1) and 0 <= g.score <= 1 and g.predicted == int(g.score >= 0.5)
    held = [i for i in labels if got[i].held_out and labels[i] is not None]
    assert sum(got[i].predicted == labels[i] for i in held) >= 0.9 * len(held)


def test_op5_columns(spark, texts):
    raw = {i: (r.text or "").encode() for i, r in texts.items()}
    seen = collections.Counter(b[k : k + 200] for b in raw.values() for k in range(len(b) - 199))
    want = set()
    for i, b in raw.items():
        gone = bytearray(len(b))
        for k in range(len(b) - 199):
            if seen[b[k : k + 200]] > 1:
                gone[k : k + 200] = b"\1" * 200
        spans = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(b)))
        want.add((i, len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    assert {tuple(r) for r in bindings.op5_substring_dedup(spark, FOLDER).collect()} == want


def test_op8_columns(spark, texts):
    got = {r.doc_id: r for r in bindings.op8_mixing(spark, FOLDER).collect()}
    size = {i: len(words(r.text)) for i, r in texts.items()}
    by = collections.defaultdict(list)
    for i, r in texts.items():
        by[r.source].append(i)
    names = sorted(by, key=lambda s: (s is None, s or ""))
    sizes = [sum(size[i] for i in by[s]) for s in names]
    want = dict(zip(names, wanted(sizes, [(3, 1, 2)[k % 3] for k in range(len(names))], 1.5, 2.0)))
    for s, whole in zip(names, sizes):
        for i in by[s]:
            g = got[i]
            assert (g.size, g.source_size) == (size[i], whole) and g.target == pytest.approx(want[s])
            assert g.taken in (0, g.size, 2 * g.size)
        assert abs(sum(got[i].taken for i in by[s]) - want[s]) <= max(size[i] for i in by[s])
    again = {r.doc_id: r.taken for r in bindings.op8_mixing(spark, FOLDER).collect()}
    assert again == {i: g.taken for i, g in got.items()}


def shingles(text: str) -> frozenset:
    w = words(text)
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    docs, seen = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        seen[name] = ([r.asDict() for r in before.collect()], [r.asDict() for r in docs.collect()])
    key = lambda rows: collections.Counter(tuple(sorted(r.items())) for r in rows)

    before, after = seen["quality_classifier"]
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").where("crc32(cast(doc_id as string)) % 3 <> 1")
    frame = spark.createDataFrame([(r["doc_id"], r["text"]) for r in before], "doc_id long, text string")
    accepted = {r.doc_id for r in classifier.score(frame, classifier.train(frame, labels)).where("predicted = 1").collect()}
    assert key(after) == key([r for r in before if r["doc_id"] in accepted])

    before, after = seen["line_dedup"]
    pages, holds = collections.Counter(r["source"] for r in before), collections.Counter()
    for r in before:
        holds.update({(r["source"], x) for x in (r["text"] or "").split("\n") if x.strip(" ")})
    bad = {k for k, n in holds.items() if n >= line_dedup.MIN_PAGES and n > line_dedup.MAX_RATIO * pages[k[0]]}
    want = []
    for r in before:
        text = None if r["text"] is None else "\n".join(x for x in r["text"].split("\n") if (r["source"], x) not in bad)
        want.append({**r, "text": text, "n_chars": None if text is None else len(text)})
    assert bad and key(after) == key(want)

    before, after = seen["jaccard_join"]
    sets, top = {r["doc_id"]: shingles(r["text"]) for r in before}, {r["doc_id"]: r["doc_id"] for r in before}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                top[b] = a
    assert key(after) == key([r for r in before if root(r["doc_id"]) == r["doc_id"]]) and len(after) < len(before)

    before, after = seen["mixing"]
    size = {r["doc_id"]: len(words(r["text"])) for r in before}
    by = collections.defaultdict(list)
    for r in before:
        by[r["source"]].append(r["doc_id"])
    names = sorted(by, key=lambda s: (s is None, s or ""))
    targets = wanted([sum(size[i] for i in by[s]) for s in names], [(3, 1, 2)[k % 3] for k in range(len(names))], 1.5, 2.0)
    taken = collections.Counter(r["doc_id"] for r in after)
    assert set(key(after)) <= set(key(before)) and max(taken.values()) <= 2
    for s, target in zip(names, targets):
        assert abs(sum(size[i] * taken[i] for i in by[s]) - target) <= max(size[i] for i in by[s])

    before, after = seen["sentencepiece"]
    _, lib = as_kind(sentencepiece.BPE)
    got = collections.Counter((r["doc_id"], tuple(r["ids"])) for r in after)
    assert got == collections.Counter((r["doc_id"], tuple(lib.encode(r["text"] or ""))) for r in before)
    assert all(r["round_trip"] for r in after)
