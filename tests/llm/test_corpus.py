"""Archive, mix, pieces, the registered queries and the pipeline."""

import base64
import collections
import gzip
import hashlib
import pathlib
import random
import re

import numpy as np
import pytest
import sentencepiece as library
from sentencepiece import sentencepiece_model_pb2 as model_proto

from tallymark.llm import bindings, jaccard_join, mixing, sentencepiece, warc
from tests.compare import connect, differences
from tests.llm.cases import SCHEMA, WORDS, documents, prose

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), SCHEMA)


def pages():
    html = "<p>" + prose(30, 1) + "</p>\r\n\r\nWARC/1.1\r\n é"
    return [
        (5, "http://a/5", html), (2, "http://a/2", html), (9, None, html), (3, "http://b\r\nX: y", None), (4, "u", ""),
        (7, "u7", "other"), (7, "u7", "other"), (8, "u8", "other"), (None, "n", html), (None, "m", "alone"), (11, "z", "z" * 300_000),
    ]


@pytest.mark.parametrize("least", [0, 10])
def test_archive(spark, tmp_path, least):
    rows = pages()
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "a"), min_bytes=least)
    got = warc.describe(warc.read_archive(spark, str(tmp_path / "a"))).collect()
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = collections.Counter()
    for i, _, h in rows:
        body = (h or "").encode()
        other = first.get(h or "")
        other = None if other == i or len(body) < least else other
        want[i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if other is not None else "response", other] += 1
    assert collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    stored = spark.read.parquet(str(tmp_path / "a" / "payloads"))
    assert stored.count() == stored.select("digest").distinct().count() == len({h or "" for _, _, h in rows})


def test_archive_as_files(spark, tmp_path):
    """The exported files are WARC records that a plain reader can walk through."""
    warc.write_archive(spark.createDataFrame(pages(), "page_id long, url string, html string"), str(tmp_path / "a"))
    read = warc.read_archive(spark, str(tmp_path / "a"))
    warc.export_warc(read, str(tmp_path / "w"))
    found = []
    for f in pathlib.Path(tmp_path / "w").glob("part-*"):
        data = gzip.decompress(f.read_bytes())
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.1\r\n")
            n = int(re.search(rb"\r\nContent-Length: (\d+)", head)[1])
            found.append(head + b"\r\n\r\n" + rest[:n] + b"\r\n\r\n")
            assert rest[n : n + 4] == b"\r\n\r\n"
            data = rest[n + 4 :]
    assert sorted(found) == sorted(bytes(r.record) for r in read.collect())


def test_archive_notices_damage(spark, tmp_path):
    warc.write_archive(spark.createDataFrame(pages(), "page_id long, url string, html string"), str(tmp_path / "a"))
    stored = spark.read.parquet(str(tmp_path / "a" / "payloads"))
    (tmp_path / "b").mkdir()
    spark.read.parquet(str(tmp_path / "a" / "headers")).write.parquet(str(tmp_path / "b" / "headers"))
    stored.selectExpr("digest", "cast('x' as binary) payload").write.parquet(str(tmp_path / "b" / "payloads"))
    with pytest.raises(Exception, match="not what its digest says"):
        warc.read_archive(spark, str(tmp_path / "b")).collect()


def test_empty_archive(spark, tmp_path):
    warc.write_archive(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "a"))
    assert warc.describe(warc.read_archive(spark, str(tmp_path / "a"))).count() == 0


def wanted(sizes, weights, share, most):
    """Targets by a plain loop: cut off what is above, share the rest out again."""
    left, open_, out = share * sum(sizes), [i for i, s in enumerate(sizes) if s > 0], [0.0] * len(sizes)
    while open_:
        unit = left / sum(weights[i] for i in open_)
        over = [i for i in open_ if weights[i] * unit > most * sizes[i]]
        for i in over or open_:
            out[i] = most * sizes[i] if over else weights[i] * unit
        left -= sum(out[i] for i in over)
        open_ = [i for i in open_ if i not in set(over)] if over else []
    return out


def targets(spark, sizes, weights, share, most):
    rows = spark.createDataFrame([(f"s{i:06d}", s) for i, s in enumerate(sizes)], "source string, size long")
    got = {r.site.source: r.target for r in mixing.source_targets(rows, weights, share, most).collect()}
    return [got[f"s{i:06d}"] for i in range(len(sizes))]


def test_targets(spark):
    got = targets(spark, [100, 100, 1000, 0], [3, 1, 2, 3], 1.5, 2)
    assert got[:2] == [200.0, 200.0] and got[2] == pytest.approx(1400) and got[3] == 0
    assert sum(targets(spark, [10, 20, 30], [3, 1, 2], 1.5, 2)) == pytest.approx(90)
    assert targets(spark, [], [3], 1.5, 2) == []
    draw = np.random.default_rng(2)
    for most in (1.6, 2.0, 9.0):
        sizes = [int(s) for s in draw.integers(0, 3000, 90) ** 2 // 1000]
        assert targets(spark, sizes, [3, 1, 2], 1.5, most) == pytest.approx(wanted(sizes, [3, 1, 2] * 30, 1.5, most))


def test_many_sources(spark):
    """More sources than a driver should hold; null comes last."""
    n = 250_000
    rows = spark.range(n).selectExpr("lpad(id, 7, '0') AS source", "id % 50 AS size").unionByName(
        spark.range(1).selectExpr("CAST(NULL AS string) AS source", "id + 7 AS size"))
    found = mixing.source_targets(rows, [3.0, 1.0, 2.0], 1.5, 2.0).selectExpr("count(*)", "sum(target)", "sum(int(target > 2 * source_size))").first()
    total = n // 50 * sum(range(50)) + 7
    assert found[0] == n + 1 and found[1] == pytest.approx(1.5 * total) and found[2] == 0


def test_mix_keeps_columns_of_any_name(spark):
    rows = [(i, f"{prose(9, i)}", f"s{i % 2}", "k", "r", "t", "d", [i]) for i in range(30)]
    names = "doc_id long, text string, source string, _key string, row string, turn string, `a.b` string, copies array<int>"
    frame = spark.createDataFrame(rows, names)
    got = mixing.mix(frame)
    assert got.columns == frame.columns and got.count() > 30
    assert {tuple(r) for r in map(lambda r: (*r[:7], tuple(r[7])), got.collect())} <= {(*r[:7], tuple(r[7])) for r in rows}


def test_equal_rows_get_draws_of_their_own(spark, monkeypatch):
    """One text a thousand times, ids missing: chunks stay small and copies differ."""
    monkeypatch.setattr(mixing, "CHUNK", 16)
    frame = spark.createDataFrame([(None, "a b c", "s")] * 1000 + [(i, prose(30, i), "t") for i in range(100)], "doc_id long, text string, source string")
    got = mixing.mix_copies(frame, most=1.4, weights=(1.0, 1.0), share=1.2)
    assert got.count() == 1100 and {r.copies for r in got.where("source = 's'").collect()} == {1, 2}
    assert got.where("source = 's'").selectExpr("sum(size * copies)", "max(target)").first()[0] == pytest.approx(
        got.where("source = 's'").selectExpr("max(target)").first()[0], abs=3)


def test_rounding_keeps_words_and_expectation():
    draw = np.random.default_rng(0)
    frac, size = draw.random(50), draw.integers(1, 300, 50).astype(float)
    total, words = np.zeros(50), (frac * size).sum()
    for k in range(4000):
        out = mixing.round_chunk(frac, size, np.random.default_rng(k).random(50), False)
        inner = (out > 0) & (out < 1)
        assert inner.sum() <= 1 and (out * size).sum() == pytest.approx(words)
        total += mixing.round_chunk(frac, size, np.random.default_rng(k).random(50), True)
    assert np.abs(total / 4000 - frac).max() < 0.04


def test_mix(docs, spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 4)
    monkeypatch.setattr(mixing, "FAN_IN", 2)
    rows = documents() + [(1000 + i, prose(5 + i % 40, i), f"s{i % 3}", 0.1, "") for i in range(120)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mix_copies(frame).collect()
    assert len(got) == len(rows) and sorted(map(str, got)) == sorted(map(str, mixing.mix_copies(frame).collect()))
    by = collections.defaultdict(list)
    for r in got:
        assert r.copies in (0, 1, 2)
        by[r.source].append(r)
    for of in by.values():
        assert sum(r.size for r in of) == of[0].source_size
        assert abs(sum(r.size * r.copies for r in of) - of[0].target) <= max(r.size for r in of)
    assert sum(of[0].target for of in by.values()) == pytest.approx(1.5 * sum(r.size for r in got))
    mixed = mixing.mix(frame)
    assert mixed.columns == frame.columns
    want = collections.Counter()
    for r in got:
        want[r.doc_id, r.source] += r.copies
    assert collections.Counter((r.doc_id, r.source) for r in mixed.collect()) == +want
    assert mixing.mix(frame.where("false")).count() == 0


def as_kind(kind: int):
    with open(sentencepiece.MODEL, "rb") as f:
        proto = model_proto.ModelProto.FromString(f.read())
    proto.trainer_spec.model_type = kind
    return sentencepiece.Encoder(sentencepiece.Vocabulary.parse(proto)), library.SentencePieceProcessor(model_proto=proto.SerializeToString())


def odd_texts():
    draw = np.random.default_rng(4)
    letters = list("abcdeinthr  \n.,é日1▁\x00<>")
    return ["", " ", "   ", "a", "hello  world", " lead", "trail  ", "<s> <0x0A>", "aaaa" * 60, "日本語 \U0001f600"] + [
        "".join(draw.choice(letters, int(draw.integers(1, 50)))) for _ in range(600)
    ]


def test_pieces_are_those_of_the_library():
    encoder, lib = as_kind(sentencepiece.BPE)
    texts = odd_texts() + [x or "" for _, x, *_ in documents()]
    ids, at = encoder.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [lib.encode(t) for t in texts]
    data, bounds = encoder.decode(ids, at)
    raw = data.tobytes()
    assert [raw[a:b].decode() for a, b in zip(bounds[:-1], bounds[1:])] == [t.replace("▁", " ") for t in texts]


def test_best_sums():
    """In a unigram model no segmentation of a word has a larger sum than the one found."""
    encoder, _ = as_kind(sentencepiece.UNIGRAM)
    words = sorted({w for w in prose(400, 3).split()})
    ids, at = encoder.encode(words)
    for w, a, b in zip(words, at[:-1], at[1:]):
        marked, best = " " + w, [0.0]
        for end in range(1, len(marked) + 1):
            best.append(max(best[i] + encoder.score[encoder.id_of[marked[i:end]]] for i in range(end) if marked[i:end] in encoder.id_of))
        assert sum(encoder.score[i] for i in ids[a:b]) == best[-1]
        assert "".join(encoder.piece[i] for i in ids[a:b]) == marked


def test_encode_rows(docs, spark):
    got = sentencepiece.encode(docs).collect()
    _, lib = as_kind(sentencepiece.BPE)
    want = collections.Counter((i, tuple(lib.encode(x or ""))) for i, x, *_ in documents())
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in got) == want
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in got)
    back = sentencepiece.decode(sentencepiece.encode(docs)).collect()
    assert all(r.decoded == (r.text or "") for r in back)
    assert sentencepiece.encode(spark.createDataFrame([], SCHEMA)).count() == 0


def test_lost_payloads_fail_the_query(spark, tmp_path):
    """The query's own columns need each record's payload, also that of a revisit."""
    rows = [(1, "u", "first"), (2, "u", "second"), (3, "u", "second")]
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "a"))
    stored = spark.read.parquet(str(tmp_path / "a/payloads"))
    for k, page in (("b", 1), ("c", 3)):
        lost = {1: "first", 3: "second"}[page]
        stored.where(f"cast(payload as string) <> '{lost}'").write.parquet(str(tmp_path / k / "payloads"))
        spark.read.parquet(str(tmp_path / "a/headers")).where(f"page_id = {page}").write.parquet(str(tmp_path / k / "headers"))
        with pytest.raises(Exception, match="no payload stored"):
            warc.describe(warc.read_archive(spark, str(tmp_path / k))).drop("record_bytes").collect()


@pytest.mark.parametrize("name", sorted(bindings.ORACLES))
def test_queries_with_sql(spark, name):
    assert differences(bindings.QUERIES[name](spark, FOLDER), connect(FOLDER), bindings.ORACLES[name]) == []


def test_queries_return_every_row(spark):
    n = {t: spark.read.parquet(f"{FOLDER}/{t}.parquet").count() for t in ("documents", "embeddings")}
    for name, query in bindings.QUERIES.items():
        if name not in bindings.ORACLES and int(name[2:].split("_")[0]) <= 10:
            assert query(spark, FOLDER).count() == n["embeddings" if "embedding" in name else "documents"], name


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        kept[name] = (before, docs)
        if name != "sentencepiece":
            assert docs.columns == columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    stayed = {r.doc_id for r in kept["quality_classifier"][1].collect()}
    gone = {r.doc_id for r in kept["quality_classifier"][0].collect()} - stayed
    assert sum(labels.get(i) == 1 for i in stayed) > 0.9 * sum(q == 1 for q in labels.values())
    assert sum(labels.get(i) == 0 for i in gone) > 0.8 * sum(q == 0 for q in labels.values())
    before, after = kept["jaccard_join"]
    top = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(before).collect()}
    assert sorted(r.doc_id for r in after.collect()) == sorted(i for i, c in top.items() if i == c)
    before, after = kept["mixing"]
    size = {r.doc_id: len(WORDS.findall(r.text)) for r in before.collect()}
    assert abs(sum(size[r.doc_id] for r in after.collect()) - 1.5 * sum(size.values())) < 0.1 * sum(size.values())
    assert docs.count() == after.count() and docs.where("not round_trip").count() == 0
    ran = corpus_pipeline.run(spark, FOLDER)
    assert ran.count() == docs.count() and ran.columns == docs.columns


def test_words_that_come_again_are_not_learned_again(monkeypatch):
    monkeypatch.setattr(sentencepiece, "REMEMBERED", 40)
    encoder, lib = as_kind(sentencepiece.BPE)
    learned, forward = [], encoder._forward
    monkeypatch.setattr(encoder, "_forward", lambda words: learned.extend(words) or forward(words))
    usual = "the same words stand in every text"
    texts = [usual + "".join(f" {chr(97 + k)}{chr(97 + j)}zq" for j in range(26)) for k in range(8)]
    for text in texts:
        ids, _ = encoder.encode([text])
        assert ids.tolist() == lib.encode(text)
    assert all(learned.count(" " + word) == 1 for word in usual.split())
    assert len(encoder.known) + len(encoder.older) < 100


def test_pairs_of_pieces_as_merged_outright():
    encoder, _ = as_kind(sentencepiece.BPE)
    pieces = sorted(encoder.id_of.values())
    rng = random.Random(5)
    # neighbours in a text and pairs drawn from all pieces
    pairs = [(rng.choice(pieces), rng.choice(pieces)) for _ in range(3000)] + [(sentencepiece.NONE, i) for i in rng.sample(pieces, 500)]
    halves = [(encoder.id_of.get(p[:k]), encoder.id_of.get(p[k:])) for p in rng.sample(encoder.piece, 1500) for k in range(1, len(p))]
    seen = set()
    for a, b in pairs + [(a, b) for a, b in halves if a is not None and b is not None]:
        x, y = "" if a == sentencepiece.NONE else encoder.piece[a], encoder.piece[b]
        if "  " in x + y or " " in y:
            continue
        wanted = encoder.merged(list(x + y)) == ([x, y] if x else [y])
        assert encoder._apart(a, b) == wanted, (x, y)
        seen.add(wanted)
    assert seen == {True, False}


def shuffled(df, column: str) -> int:
    """Rows with a column that a run of ``df`` writes to shuffles, without those of exchanges used again."""
    df.collect()
    todo, rows = [df._jdf.queryExecution().executedPlan().executedPlan()], 0
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif name != "ReusedExchangeExec":
            if name == "ShuffleExchangeExec" and f"{column}#" in node.output().mkString(","):
                rows += node.metrics().apply("shuffleRecordsWritten").value()
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return rows


def test_texts_are_dealt_out_once(spark):
    rows = [(i, f"word{i} " * (i % 7 + 1), f"s{i % 3}", 0.5, "en") for i in range(300)]
    docs = spark.createDataFrame([*rows, rows[5], (6, "other6 " * 7, "s0", 0.5, "en")], SCHEMA)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # the four rows of equal keys go again, to be numbered and found by number
        assert 302 <= shuffled(mixing.mix(docs, share=0.5), "row") <= 302 + 8
        assert 302 <= shuffled(jaccard_join.one_per_group(docs), "text") <= 302 + 8
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
