"""Rules, classifier and scores: each text by itself, against plain Python."""

import collections
import math

import numpy as np
import pytest

from tallymark.llm import classifier, flat, lm_scoring, quality_rules
from tests.llm.cases import LOWER, SCHEMA, WORDS, documents, prose


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), SCHEMA)


def counts_of(x: str) -> tuple:
    w = WORDS.findall(x)
    seen = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    inside = {j for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines, known = 0, set()
    for line in x.split("\n"):
        if WORDS.search(line):
            lines += line in known
            known.add(line)
    return len(w), sum(map(len, w)), sum(x.count(c) for c in "#*$%&|<>"), lines, len(inside)


def test_rule_counts(docs):
    got = quality_rules.judge(docs).collect()
    rows = documents()
    assert len(got) == len(rows)
    want = sorted((str(i), *counts_of(x or "")) for i, x, *_ in rows)
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
    kept = {r.doc_id for r in got if r.kept}
    assert {1, 2, 3, 4, 5, 11} <= kept and not kept & {6, 7, 8, 9, 12, 16}


def test_characters_in_repeated_windows():
    """Later occurrences of five to ten words, and repeated lines, against a plain count."""
    text = " ".join(prose(40, 7).split() * 2) + "\nsame line here\nsame line here\n"
    m = quality_rules.measure(*flat.flat(__import__("pyarrow").array([text])))
    w = WORDS.findall(text)
    for k, got in zip(quality_rules.NGRAM_LIMITS, m["repeat_chars"][0]):
        known, inside = set(), set()
        for i in range(len(w) - k + 1):
            g = tuple(w[i : i + k])
            if g in known:
                inside.update(range(i, i + k))
            known.add(g)
        assert got == sum(len(w[i]) for i in inside)
    assert m["line_chars"][0] == len("samelinehere")


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert quality_rules.judge(none).count() == 0
    assert lm_scoring.score(none, lm_scoring.train(none)).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert classifier.score(none, classifier.train(none, labels)).count() == 0


def test_hashes_know_equal_bytes():
    data = np.frombuffer(b"abcabc  abd", np.uint8)
    h = flat.hashes(data, np.array([0, 3, 8, 0]), np.array([3, 6, 11, 6]))
    assert h[0] == h[1] and len({*h.tolist()}) == 3


def test_words_and_lines_at_text_bounds():
    data, bounds = flat.flat(__import__("pyarrow").array(["ab", "cd e", None, "", "\nf"]))
    begins, ends, each = flat.words(data, bounds)
    assert [data[a:b].tobytes() for a, b in zip(begins, ends)] == [b"ab", b"cd", b"e", b"f"]
    assert each.tolist() == [1, 2, 0, 0, 1]
    begins, ends, each = flat.lines(data, bounds)
    assert each.tolist() == [1, 1, 1, 1, 2]
    assert [data[a:b].tobytes() for a, b in zip(begins, ends)] == [b"ab", b"cd e", b"", b"", b"", b"f"]


def ppm(texts: list[bytes], wanted: bytes, order: int = lm_scoring.ORDER) -> float:
    """The score by dictionaries: contexts of each length with the bytes seen in them."""
    counts: dict[int, dict[bytes, collections.Counter]] = {k: collections.defaultdict(collections.Counter) for k in range(order + 1)}
    for t in texts:
        padded = b"\0" * order + t + b"\0"
        for i in range(order, len(padded)):
            counts[order][padded[i - order : i]][padded[i]] += 1
    for k in range(order, 0, -1):  # a shorter context learns a byte once from each longer one
        for context, seen in counts[k].items():
            for b in seen:
                counts[k - 1][context[1:]][b] += 1
    total = 0.0
    padded = b"\0" * order + wanted + b"\0"
    for i in range(order, len(padded)):
        out: set[int] = set()
        for k in range(order, -1, -1):
            seen = counts[k].get(padded[i - k : i], {})
            left = {b: n for b, n in seen.items() if b not in out}
            whole = sum(left.values())
            if padded[i] in left:
                total += math.log10((left[padded[i]] - 0.5) / whole)
                break
            if left:
                total += math.log10(0.5 * len(left) / whole)
            out |= set(seen)
        else:
            total -= math.log10(256 - len(out))
    return total


def test_scores(docs):
    """Scores and base line against dictionaries; training on some of the rows."""
    train = docs.where("doc_id < 10")
    got = lm_scoring.score(docs, lm_scoring.train(train)).collect()
    rows = [(i, (x or "").translate(LOWER)) for i, x, *_ in documents()]
    known = [x for i, x in rows if i is not None and i < 10]
    c = collections.Counter(w for x in known for w in [*WORDS.findall(x), None])
    n, v = sum(c.values()), len(c)
    by_id = collections.defaultdict(list)
    for r in got:
        by_id[r.doc_id].append(r)
    assert len(got) == len(rows)
    for i, x in rows:
        words = [*WORDS.findall(x), None]
        for r in by_id[i]:
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(c[w] > 0 for w in words), n)
            assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words))
            if len(x) < 1500:
                assert r.score == pytest.approx(ppm([k.encode() for k in known], x.encode()))


def test_scores_without_training(docs):
    model = lm_scoring.train(docs.where("false"))
    r = lm_scoring.score(docs.where("doc_id = 9"), model).first()
    assert (r.train_tokens, r.n_known) == (0, 0) and r.score == pytest.approx(-8 * math.log10(256))


def test_probabilities_add_up():
    """Over all next bytes of a context, seen or not, the probabilities are one."""
    data, bounds = flat.flat(__import__("pyarrow").array(["the cat sat on the mat", "a hat"]))
    top = lm_scoring.tally(lm_scoring.grams(data, bounds)[0])
    trie = lm_scoring.levels(top, lm_scoring.ORDER, 0)
    for context in (b"\0\0\0\0\0", b"n the", b"zzzzz", b"xx a "):
        keys = np.array([int.from_bytes(context + bytes([b]), "big") for b in range(256)], np.uint64)
        assert (10 ** lm_scoring.code(keys, trie)).sum() == pytest.approx(1)


def test_classifier_learns_held_out_rows(spark):
    good = [(i, prose(40 + i % 50, i), 1) for i in range(200)]
    bad = [(1000 + i, " ".join(w + "$$$" for w in prose(40 + i % 50, i).split()), 0) for i in range(100)]
    rows = spark.createDataFrame(good + bad, "doc_id long, text string, quality int")
    model = classifier.train(rows.select("doc_id", "text"), rows.where("doc_id % 3 <> 1").select("doc_id", "quality"))
    held = classifier.score(rows.where("doc_id % 3 = 1"), model).collect()
    assert np.mean([r.predicted == r.quality for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in held)


def test_classifier_on_odd_rows(docs, spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (9, None), (None, 0), (12, 0)], "doc_id long, quality int")
    out = classifier.score(docs, classifier.train(docs, labels))
    assert sorted(out.columns) == sorted([*docs.columns, "predicted"]) and out.count() == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out.collect())
    one_kind = classifier.score(docs, classifier.train(docs, labels.where("quality = 1")))
    assert {round(r.score, 9) for r in one_kind.collect()} == {round(2 / 3, 9)}


def test_additive_tables():
    """The score is the sum of table entries, and a joint effect is found by the pairs."""
    draw = np.random.default_rng(0)
    x = draw.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = classifier.fit(x, y)
    assert (0, 1) in model.pairs and ((model.score(x) >= 0.5) == y).mean() > 0.9
    by_hand = model.base + sum(t[np.searchsorted(c, x[7, j], "right")] for j, (c, t) in enumerate(zip(model.cuts, model.tables)))
    by_hand += sum(t[tuple(np.searchsorted(model.coarse[k], x[7, k], "right") for k in p)] for p, t in zip(model.pairs, model.pair_tables))
    assert model.logit(x[7:8])[0] == pytest.approx(by_hand)
