"""Duplicate removal against brute force."""

import collections
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tallymark.llm import embedding_dedup, flat, induced, jaccard_join, line_dedup, substring_dedup
from tallymark.llm.components import components
from tests.llm.cases import LOWER, SCHEMA, WORDS, documents, prose


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), SCHEMA)


def reach(nodes, links) -> dict:
    top = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(top[a], top[b])
            if (top[a], top[b]) != (m, m):
                top[a] = top[b] = m
                changed = True
    return top


def test_components(spark):
    draw = random.Random(3)
    links = [(i, i + 1) for i in range(40)] + [(draw.randint(100, 220), draw.randint(100, 220)) for _ in range(70)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = reach({x for p in links for x in p}, links)
    assert got == {n: c for n, c in want.items() if any(n in p and p[0] != p[1] for p in links)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(x: str | None) -> frozenset:
    w = WORDS.findall((x or "").translate(LOWER))
    return frozenset([tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else [])


def check_jaccard(rows, got):
    sets = collections.defaultdict(list)
    for i, x in rows:
        if i is not None:
            sets[i].append(shingles(x))
    ids = sorted(sets)
    links = [
        (a, b) for a in ids for b in ids if a < b
        if any(s and t and 100 * len(s & t) >= 80 * len(s | t) for s in sets[a] for t in sets[b])
    ]
    want = reach(ids, links)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert r.component_id == want[r.doc_id]
            assert r.n_shingles in {len(s) for s in sets[r.doc_id]}
        else:
            assert r.component_id is None
    return links


def test_jaccard(docs):
    links = check_jaccard([r[:2] for r in documents()], jaccard_join.jaccard_components(docs).collect())
    assert (1, 2) in links and (1, 3) in links and (9, 10) in links and (6, 7) not in links


def test_jaccard_at_the_threshold(spark):
    """Sets that share exactly 80 % of their union, one shingle less, and chains of links."""
    def text(first, n, end):
        return " ".join(f"w{i}" for i in range(first, first + n)) + "".join(f" {end}{i}" for i in range(4))

    rows = [(1, text(0, 84, "a")), (2, " ".join(f"w{i}" for i in range(84))), (3, text(0, 40, "a")), (4, text(0, 40, "b"))]
    rows += [(10 + i, " ".join(f"v{j}" for j in range(4 * i, 4 * i + 60))) for i in range(8)]
    links = check_jaccard(rows, jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert (10, 11) in links and (10, 17) not in links


def test_jaccard_of_many_near_copies(spark, monkeypatch):
    """Frequent shingles, longer prefixes, tiles of large clusters."""
    monkeypatch.setattr(jaccard_join, "LEAST_FREQUENT", 4)
    monkeypatch.setattr(jaccard_join, "TILE", 8)
    draw, base, rows = random.Random(5), prose(150, 50).split(), []
    for i in range(60):
        w = list(base)
        for _ in range(draw.randint(0, 6)):
            w[draw.randrange(len(w))] = f"x{draw.randrange(40)}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, " ".join([*base[:60], *prose(60, 60 + i).split()])) for i in range(20)]
    check_jaccard(rows, jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect())


def test_jaccard_with_postings_in_tiles(spark, monkeypatch):
    """Near copies that are not all linked with their hub."""
    monkeypatch.setattr(jaccard_join, "LEAST_FREQUENT", 4)
    monkeypatch.setattr(jaccard_join, "POSTINGS", 4, raising=False)
    used, tiled = [], jaccard_join._tiled
    monkeypatch.setattr(jaccard_join, "_tiled", lambda *a: used.append(1) or tiled(*a))
    draw, base, rows = random.Random(6), prose(150, 51).split(), []
    for i in range(70):
        w = list(base)
        for _ in range(draw.randint(0, 9)):
            w[draw.randrange(len(w))] = f"y{draw.randrange(40)}"
        rows.append((i, " ".join(w)))
    check_jaccard(rows, jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert used


def test_pairs_across_components_in_tiles(spark, monkeypatch):
    """Tiles of frequent shingles bring the same pairs, once for each shared shingle."""
    monkeypatch.setattr(jaccard_join, "POSTINGS", 4, raising=False)
    draw = random.Random(8)
    part = {d: 1 if d % 3 else draw.choice([d, 2]) for d in range(60)}
    rows = [(t, d, 50, 3, 1, part[d]) for t in range(3) for d in range(60) if (d + t) % 7]
    frame = spark.createDataFrame(rows, "token long, doc long, n int, place int, l int, part long")
    counts = collections.Counter((t, p) for t, *_, p in rows)
    sides = [(t, 1, counts[t, 1], sum(n for (u, p), n in counts.items() if u == t and p != 1)) for t in range(3)]
    tiled = jaccard_join._tiled(frame, spark.createDataFrame(sides, "token long, largest long, c0 long, c1 long"))
    groups = collections.Counter((r.g, r.token) for r in tiled.collect())
    assert max(groups.values()) < 30 and len(groups) > 3
    found = tiled.groupBy("g").applyInArrow(jaccard_join._across(5), "bucket long, " + ", ".join(f"{c} binary" for c, _ in jaccard_join._PAIR))
    got = collections.Counter()
    for r in found.collect():
        a, b, m = (flat.opened(bytes(r[c]), dict(jaccard_join._PAIR)[c]) for c in ("a", "b", "m"))
        for i, j, k in zip(a.tolist(), b.tolist(), m.tolist()):
            got[i, j] += k
    want = collections.Counter((x[1], y[1]) for x in rows for y in rows if x[0] == y[0] and x[1] > y[1] and x[5] != y[5])
    assert got == want


def test_pairs_across_components_are_sent_on(monkeypatch):
    monkeypatch.setattr(jaccard_join, "HELD_PAIRS", 50)
    n = 40
    columns = {c: np.full(n, v) for c, v in (("token", 1), ("n", 9), ("place", 0), ("l", 1), ("half", 2))}
    batch = pa.RecordBatch.from_pydict({**columns, "doc": np.arange(n), "part": np.arange(n)})
    batches = list(jaccard_join._across(3)((), iter([batch])))
    sizes = [sum(len(flat.opened(x.as_py(), np.int64)) for x in b.column("a")) for b in batches]
    assert sum(sizes) == n * (n - 1) // 2 and max(sizes) <= 50 + n


def test_prefixes_hold_enough_shared_shingles():
    """Two similar sets share at least the smaller l in their prefixes, whatever is frequent."""
    draw = np.random.default_rng(1)
    for _ in range(200):
        n = int(draw.integers(1, 60))
        common = np.unique(draw.integers(0, 2**62, n).astype(np.uint64))
        x = np.union1d(common, draw.integers(0, 2**62, int(draw.integers(0, 8))).astype(np.uint64))
        y = np.union1d(common, draw.integers(0, 2**62, int(draw.integers(0, 8))).astype(np.uint64))
        both = len(np.intersect1d(x, y))
        if 100 * both < 80 * (len(x) + len(y) - both):
            continue
        hot = np.sort(draw.choice(common, min(len(common), int(draw.integers(0, 40))), replace=False))
        df = draw.integers(32, 10_000, len(hot))
        text, token, _, _, shared = jaccard_join.prefixes(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]), hot, df)
        assert len(np.intersect1d(token[text == 0], token[text == 1])) >= shared.min()


def test_one_document_per_group(docs, spark):
    out = jaccard_join.one_per_group(docs)
    assert out.columns == docs.columns
    ids = collections.Counter(r.doc_id for r in out.collect())
    assert ids[1] == 1 and 2 not in ids and 3 not in ids and ids[9] == 1 and 10 not in ids and ids[14] == 1
    assert ids[None] == 1 and ids[6] == 1 and ids[7] == 1
    assert jaccard_join.one_per_group(spark.createDataFrame([], SCHEMA)).count() == 0


def test_only_ids_that_lose_rows_are_listed(spark, monkeypatch):
    tables, settle = {}, jaccard_join.settle
    monkeypatch.setattr(jaccard_join, "settle", lambda df, name: tables.update({name: settle(df, name)}) or tables[name])
    rows = [(i, prose(30, 900 + i)) for i in range(60)] + [(60 + i, prose(30, 900 + i)) for i in range(5)]
    rows += [(7, prose(30, 907)), (None, prose(30, 901)), (None, None)]
    out = [r.doc_id for r in jaccard_join.one_per_group(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert collections.Counter(out) == collections.Counter([*range(60), None, None])
    # five copies and one repeated id
    assert tables["some"].count() == 6


def test_components_broadcast_or_dealt_out(docs, monkeypatch):
    rows = lambda: collections.Counter(map(tuple, jaccard_join.jaccard_components(docs).collect()))
    few = rows()
    monkeypatch.setattr(jaccard_join, "FEW", 0)
    assert rows() == few


def removed(texts: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    seen = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        runs: list[list[int]] = []
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                if runs and i <= runs[-1][1]:
                    runs[-1][1] = i + length
                else:
                    runs.append([i, i + length])
        out.append([tuple(r) for r in runs])
    return out


def check_repeats(rows, out):
    texts = [(x or "").encode() for _, x in rows]
    want = collections.Counter()
    for (i, _), t, runs in zip(rows, texts, removed(texts, 200)):
        kept, at = b"", 0
        for a, b in runs:
            kept, at = kept + t[at:a], b
        want[i, len(t), tuple(runs), hashlib.sha256(kept + t[at:]).hexdigest()] += 1
    got = collections.Counter(
        (r.doc_id, r.n_bytes, tuple((s.start, s.end) for s in r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in out.collect()
    )
    assert got == want


def test_repeated_substrings(docs):
    out = substring_dedup.remove_repeats(docs)
    assert sorted(out.columns) == sorted([*docs.columns, "spans", "n_bytes"])
    check_repeats([r[:2] for r in documents()], out)


def test_segments_and_texts_are_sent_on_in_small_batches(docs, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SENT_BYTES", 1000, raising=False)
    text = prose(2000, 8)
    wanted = [{"h": k, "first": 5 * k, "windows": 21, "m": 1} for k in range(100)]
    batch = pa.RecordBatch.from_pydict({"text": [text, None], "doc": [1, 2], "row_key": [3, 4], "wanted": [wanted, []]})
    sent = list(substring_dedup._cut_texts(iter([batch])))
    assert max(sum(map(len, b.column("bytes").to_pylist())) for b in sent) < 1000 + 220
    rows = [r for b in sent for r in b.to_pylist()]
    assert [(r["h"], r["doc"], r["row_key"], r["first"], r["m"]) for r in rows] == [(k, 1, 3, 5 * k, 1) for k in range(100)]
    assert all(r["bytes"] == text.encode()[r["first"] : r["first"] + 220] for r in rows)
    out = substring_dedup.remove_repeats(docs, without=["text"])
    assert sorted(out.columns) == sorted([*(c for c in docs.columns if c != "text"), "spans", "n_bytes"])
    check_repeats([r[:2] for r in documents()], out)


def test_repeated_substrings_of_frequent_anchors(spark, monkeypatch):
    """A short line in many documents, and passages that overlap in many ways."""
    monkeypatch.setattr(substring_dedup, "LEAST_FREQUENT", 4)
    draw, passage, line = random.Random(2), prose(200, 70), "a line of about sixty bytes that stands in every document here"
    rows = []
    for i in range(40):
        a = draw.randrange(0, 500)
        rows.append((i, prose(40, 200 + i % 30) + "\n" + line + "\n" + passage[a : a + draw.randrange(150, 420)] + prose(10, 300 + i)))
    check_repeats(rows, substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")))
    assert substring_dedup.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_edges_of_a_frequent_passage_spread(spark, monkeypatch):
    """Segments at the edges of a passage share an inner part but differ; no anchor may keep them all."""
    monkeypatch.setattr(substring_dedup, "LEAST_FREQUENT", 4)
    monkeypatch.setattr(substring_dedup, "HEAVY", 8, raising=False)
    tables, settle = {}, substring_dedup.settle
    monkeypatch.setattr(substring_dedup, "settle", lambda df, name: tables.setdefault(name, settle(df, name)))
    passage = prose(70, 99)[:400]
    rows = [(i, prose(30, 500 + i) + passage[: 400 - i % 3] + prose(30, 700 + i)) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(1)
    check_repeats(rows, substring_dedup.remove_repeats(frame))
    open_ = tables["segments"].where("is_rep and alike > 1")
    assert max((r["count"] for r in open_.groupBy("h").count().collect()), default=0) < 8


def test_long_text_in_pieces(monkeypatch):
    """Segments of a text that is taken in pieces cover every window once."""
    data, bounds = flat.flat(pa.array([prose(3000, 8)]))
    whole = substring_dedup.segments(data, bounds)
    monkeypatch.setattr(substring_dedup, "PLACE", 13)
    monkeypatch.setattr(substring_dedup, "PIECE", 4096)
    _, first, count, anchor, _ = substring_dedup.segments(data[:8000], np.array([0, 8000]))
    covered = np.concatenate([np.arange(a, a + c) for a, c in zip(first, count)])
    assert np.array_equal(covered, np.arange(8000 - 199))
    assert whole[2].sum() == len(data) - 199


@pytest.mark.parametrize("letters", [1, 2, 4, 20])
def test_suffix_arrays(letters):
    draw = np.random.default_rng(letters)
    for _ in range(60):
        x = draw.integers(0, letters, int(draw.integers(1, 80))).astype(np.uint8)
        order = induced.suffix_array(x)
        t = x.tobytes()
        assert order.tolist() == [len(x), *sorted(range(len(x)), key=lambda i: t[i:])]
        shared = induced.common_prefixes(x, order)
        for i, j in zip(order[1:], order[:-1]):
            n = 0
            while max(i, j) + n < len(x) and x[i + n] == x[j + n]:
                n += 1
            assert shared[i] == n


def test_line_frequency(spark):
    rows = [(i, f"menu\nbody {i}\nmenu\n\n rare " + ("twice" if i < 2 else str(i)), "a", 0.0, "") for i in range(30)]
    rows += [(100 + i, "menu\nother", None if i % 2 else "b", 0.0, "") for i in range(4)] + [(200, None, "a", 0.0, ""), (201, "", "a", 0.0, "")]
    pages = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r for r in line_dedup.drop_boilerplate(pages, max_ratio=0.05, min_pages=20).collect()}
    assert got[5].text == "body 5\n\n rare 5" and (got[5].n_lines, got[5].n_dropped) == (5, 2)
    assert got[0].text == "body 0\n\n rare twice"
    assert got[100].text == got[101].text == "menu\nother"
    assert got[200].text is None and got[200].n_lines == 0 and got[201].text == ""
    low = {r.doc_id: r.text for r in line_dedup.drop_boilerplate(pages, max_ratio=0.9, min_pages=2).collect()}
    assert low[101] == low[100] == "" and low[5] == "body 5\n\n rare 5"
    none = line_dedup.drop_boilerplate(spark.createDataFrame([], SCHEMA))
    assert none.count() == 0 and none.columns == [*SCHEMA.replace("string", "").replace("long", "").replace("double", "").replace(" ", "").split(","), "n_lines", "n_dropped"]


def vectors():
    draw = np.random.default_rng(7)
    rows = [draw.standard_normal(16) for _ in range(300)]
    for i in range(60):
        rows.append(rows[i % 12] + 0.08 * draw.standard_normal(16))
    out = [(i, [float(v) for v in x], i % 2) for i, x in enumerate(rows)]
    out += [(400, out[0][1], 0), (401, out[0][1], 0), (402, out[0][1], None), (403, None, 0), (404, [0.0] * 16, 0), (405, [float("nan")] * 16, 0)]
    out += [(406, [1.0, None] + [0.0] * 14, 0), (407, [float("inf")] * 16, 0), (408, [1.0, 2.0], 0), (409, [2.0, 4.0], 0), (None, out[0][1], 0), (410, [], 1)]
    return out


def check_embeddings(got):
    rows = [(i, np.array(v, float), l) for i, v, l in vectors() if i is not None and l is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links = [
        (a, b) for a, x, l in rows for b, y, m in rows
        if a < b and l == m and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93
    ]
    want, n = reach({i for i, *_ in vectors() if i is not None}, links), collections.Counter(x for p in links for x in p)
    assert len(got) == len(vectors())
    for r in got:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, False)
        else:
            assert (r.n_links, r.component_id, r.kept) == (n[r.vec_id], want[r.vec_id], want[r.vec_id] == r.vec_id)


def test_embeddings(spark, monkeypatch):
    rows = spark.createDataFrame(vectors(), "vec_id long, embedding array<double>, label int")
    check_embeddings(embedding_dedup.near_duplicates(rows).collect())
    # small leaves, so that trees split, and small tiles
    monkeypatch.setattr(embedding_dedup, "LEAF", 32)
    monkeypatch.setattr(embedding_dedup, "TILE", 8)
    check_embeddings(embedding_dedup.near_duplicates(rows).collect())
    assert embedding_dedup.near_duplicates(rows.where("false")).count() == 0


def test_embeddings_of_many_lengths(spark, monkeypatch):
    """More lengths than trees are fitted for: all are compared."""
    monkeypatch.setattr(embedding_dedup, "LENGTHS", 5)
    monkeypatch.setattr(embedding_dedup, "LEAF", 4)
    draw, rows = np.random.default_rng(2), []
    for w in range(3, 73):
        base = draw.standard_normal(w)
        for x in (base, 2 * base, base + 1e-3 * draw.standard_normal(w), -base, *draw.standard_normal((4, w))):
            rows.append((len(rows), [float(v) for v in x], 1))
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    vectors_, want = {i: np.array(v) for i, v, _ in rows}, 0
    for i, x in vectors_.items():
        want += sum(len(x) == len(y) and i != j and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93 for j, y in vectors_.items() if abs(i - j) < 16)
    found = got.selectExpr("count(*)", "sum(n_links)").first()
    assert found[0] == len(rows) and 0.9 * want <= found[1] <= want and want >= 70 * 6


@pytest.mark.parametrize("depth,least", [(6, 0.99), (14, 0.98), (18, 0.98), (22, 0.97), (24, 0.97)])
def test_recall_by_depth(depth, least):
    """Pairs at the threshold that share a leaf, in trees as deep as a table of up to 8 billion vectors of a label has."""
    draw, width, n = np.random.default_rng(depth), 64, 400
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    a = unit(draw.standard_normal((n, width)))
    side = draw.standard_normal((n, width))
    side = unit(side - (side * a).sum(axis=1, keepdims=True) * a)
    b = 0.93 * a + np.sqrt(1 - 0.93**2) * side
    forest = embedding_dedup.Forest(unit(draw.standard_normal((20_000, width))), width, depth)
    row, leaf = forest.leaves(np.concatenate([a, b]), np.full(2 * n, depth))
    of = [set() for _ in range(2 * n)]
    for r, x in zip(row.tolist(), leaf.tolist()):
        of[r].add(x)
    assert np.mean([bool(of[i] & of[n + i]) for i in range(n)]) >= least


def test_boilerplate_of_small_hosts(spark):
    """A share alone decides, so hosts of a few pages and the same mix at ten times the size lose the same lines."""
    def pages(host, n):
        # a menu on all pages, a notice on a quarter, a line on one page in fifty
        return [(i, "\n".join(["menu", f"body {host} {i}"] + ["notice"] * (i % 4 == 0) + [f"rare {i // 2}"] * (i % 50 < 2)), host) for i in range(n)]

    rows = pages("two", 2) + pages("three", 3) + pages("four", 4) + pages("small", 100) + pages("large", 1000)
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    left = {}
    for r in line_dedup.drop_boilerplate(frame).collect():
        left.setdefault(r.source, set()).update(x.split(" ")[0] for x in r.text.split("\n"))
    assert left["two"] == left["three"] == {"body", "notice"}
    assert left["small"] == left["large"] == {"body", "rare"}


def test_boilerplate_keeps_columns_of_any_name(spark):
    rows = [(i, "menu\nbody %d" % i, "h", "s", "b", "k", "r", "x") for i in range(9)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, `my.host` string, site string, bad string, kept string, row string, `a.b` string")
    got = line_dedup.drop_boilerplate(frame, host="`my.host`")
    assert got.columns == [*frame.columns, "n_lines", "n_dropped"]
    assert sorted(map(tuple, got.collect())) == sorted((i, "body %d" % i, *rest, 2, 1) for i, _, *rest in rows)
