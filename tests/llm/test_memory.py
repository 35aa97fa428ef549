"""What tasks hold: texts sent once, rows taken in small batches, free memory given back."""

import collections
import re

import numpy as np
import pyarrow as pa

import corpus_pipeline
from tallymark.llm import classifier, flat, jaccard_join, passing
from tests.llm.cases import SCHEMA, documents, prose


def sizes(data, bounds):
    return [pa.array(np.diff(bounds))]


def test_text_goes_to_the_workers_once(spark):
    docs = spark.createDataFrame(documents(), SCHEMA)
    scored = classifier.score(docs, classifier.Model(0.0))
    assert "_text" not in scored._jdf.queryExecution().analyzed().toString()
    rows = collections.Counter((i, t, len((t or "").encode())) for i, t, *_ in documents())
    got = passing.add_columns(docs, "text", "n long", sizes).select("doc_id", "text", "n").collect()
    assert collections.Counter(map(tuple, got)) == rows
    # a text that is replaced, one of another type, and a field of a column
    got = passing.add_columns(docs, "text", "text long", sizes).select("doc_id", "text").collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter({(i, n): c for (i, _, n), c in rows.items()})
    assert [r.n for r in passing.add_columns(spark.range(9, 11), "id", "n long", sizes).orderBy("id").collect()] == [1, 2]
    nested = spark.sql("select named_struct('b', 'four') as a, 'seven77' as `a.b`")
    assert [r.n for r in passing.add_columns(nested, "a.b", "n long", sizes).collect()] == [4]


def batches(rows):
    texts = [prose(12, k % 7) if k % 3 else prose(40, 1) + f" {k}" for k in range(240)]
    table = pa.table({"doc_id": pa.array(range(240), pa.int64()), "text": texts})
    return iter(table.to_batches(rows))


def test_small_batches_are_looked_at_together():
    def survey(rows):
        found = [r for b in jaccard_join._survey(batches(rows)) for r in b.to_pylist()]
        return collections.Counter(tuple(r.values()) for r in found)

    def postings(rows):
        return [b.to_pylist() for b in jaccard_join._posting_task(4, np.zeros(0, np.uint64), np.zeros(0, np.int64))(batches(rows))]

    assert survey(7) == survey(240) and any(r[4] for r in survey(240))
    assert postings(7) == postings(240)


def test_documents_looked_at_together_are_bounded(monkeypatch):
    monkeypatch.setattr(jaccard_join, "TOGETHER", 60)
    parts = list(jaccard_join._posting_task(4, np.zeros(0, np.uint64), np.zeros(0, np.int64))(batches(20)))
    assert len(parts) == 4


def test_pipeline_takes_small_batches_unless_told(spark):
    key = corpus_pipeline.ROWS_SETTING
    before = spark.conf.get(key, None)
    docs = spark.createDataFrame([(1, "a b", "en", "s", 3)], "doc_id long, text string, lang string, source string, n_chars long")
    try:
        spark.conf.unset(key)
        corpus_pipeline.encode(spark, docs, "")
        assert spark.conf.get(key) == str(corpus_pipeline.ROWS)
        spark.conf.set(key, "77")
        corpus_pipeline.encode(spark, docs, "")
        assert spark.conf.get(key) == "77"
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_free_memory_is_given_back():
    def resident():
        with open("/proc/self/smaps_rollup") as f:
            return int(re.search(r"\nAnonymous:\s+(\d+)", f.read())[1]) / 1024

    pool = pa.default_memory_pool()
    held = [pa.allocate_buffer(1 << 20, memory_pool=pool) for _ in range(200)]
    for b in held:
        np.frombuffer(b, np.uint8)[::4096] = 1
    full = resident()
    del held, b
    flat.give_back()
    assert resident() < full - 150
