"""N-gram Jaccard join with adaptive multi-match prefixes.

A document's shingles are put in one order for all documents: rare ones first, those known to be frequent
last, by frequency. Two sets of the wanted similarity share at least l of the shingles in their
prefixes of length n - ceil(t n) + l. Each document chooses its l by the estimated cost of its
candidates (documents that its prefix shingles bring, and how many of them are left to verify if l must
be shared); a pair must share the smaller of its two l.

Frequent shingles are found exactly enough for an order: any shingle that a batch of documents holds
more than once is counted, and those in more than a share of all documents are listed. The
list has at most (shingles per document / share) entries whatever the corpus, and only the order, never the
result, depends on it.

Only links between different components matter for components, so candidates are taken in two steps:
first each document with one hub (the smallest document it shares most prefix shingles
with); then, for shingles whose documents are still in different components, all pairs across components.
Documents of a shingle that many hold are cut into tiles by a hash, apart for the shingle's largest component and
all others; every two tiles that have such pairs are a group, and no group keeps more than HELD_PAIRS
and one tile of candidates. These pairs remain as many as they are.
A candidate whose shared shingles come too late in the order to reach the overlap is left out; every
other one is verified on the whole sets.

Defined cases: documents without words are linked with nothing; fewer words than a shingle make one
shingle of all of them; null ids are linked with nothing; documents with equal sets are one group
without comparison; an id is taken to name one text, and repeated rows fall in the same component; an empty table gives an empty table;
further columns are ignored. Shingles are known by 64-bit hashes, equal sets by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm import flat
from tallymark.llm.components import components
from tallymark.plans.lineage import settle

WORDS, PERCENT = 5, 80
#: A shingle in this share of documents, and in this many, is frequent.
SHARE, LEAST_FREQUENT = 1 / 2000, 32
#: Most shared shingles asked for; cost of verifying a candidate against reading one posting.
MOST_SHARED, VERIFY_COST = 8, 20.0
BUCKET_BYTES = 24 << 20
#: Candidates a task holds before it adds up those of the same pair and sends them on (some 250 bytes each on the way).
HELD_PAIRS = 1 << 18
#: Documents whose shingles a task looks at together, however many come at a time.
TOGETHER = 10_000
#: Documents of a shingle that are compared in one group.
POSTINGS = 1024
#: Documents in a tile of a large cluster of candidates.
TILE = 128
#: Largest set whose low 16 bits tell hashes apart well; pairs whose ids, and documents whose components, may be broadcast (tens of MB).
SHORT, FEW = 4096, 500_000
U = np.uint64


def shingle_sets(data: np.ndarray, bounds: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's distinct shingles, ascending, and where each text's begin."""
    low = flat.LOWER[data]
    begins, ends, each = flat.words(low, bounds)
    at = np.concatenate([[0], np.cumsum(each)])
    text = np.repeat(np.arange(len(each)), each)
    h = flat.hashes(low, begins, ends)
    n = len(h)
    rolled, step = h.copy(), U(0xC2B2AE3D27D4EB4F)
    used = at[text + 1] - np.arange(n) >= words
    value = np.zeros(n, U)
    for k in range(1, words + 1):
        if k > 1 and n >= k:
            rolled[: n - k + 1] = rolled[: n - k + 1] * step + h[k - 1 :]
        # windows, or at smaller k whole texts of k words
        now = used if k == words else at[:-1][each == k]
        value[now] = flat.mixed(rolled[now] + U(k))
    used[at[:-1][(each > 0) & (each < words)]] = True
    value, text = value[used], text[used]
    order = np.lexsort([value, text])
    value, text = value[order], text[order]
    first = np.ones(len(value), bool)
    first[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    value, text = value[first], text[first]
    return value, np.searchsorted(text, np.arange(len(each) + 1))



def _distinct_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Per chunk: ids, set sizes, digests, sets and their begins."""
    for batch in batches:
        for a, b, data, bounds in flat.chunks(batch.column(1)):
            value, at = shingle_sets(data, bounds)
            raw = value.tobytes()
            digests = [xxhash.xxh3_128_digest(raw[8 * x : 8 * y]) for x, y in zip(at[:-1], at[1:])]
            yield batch.column(0).slice(a, b - a), np.diff(at), digests, value, at


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document (id, size, digest), and rows of shingles that several documents at hand hold."""
    names = ["doc_id", "n", "digest", "token", "df"]
    tokens, seen, held = [], set(), 0

    def counted() -> pa.RecordBatch:
        every = np.concatenate(tokens)
        tokens.clear()
        seen.clear()
        every.sort()  # in place: long documents have tens of megabytes of shingles together
        first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.zeros(0, np.int64)
        df = np.diff(np.append(first, len(every)))
        some = df > 1
        n = int(some.sum())
        return pa.RecordBatch.from_arrays(
            [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.array(every[first[some]].view(np.int64)), pa.array(df[some])],
            names=names,
        )

    for batch in batches:
        for ids, sizes, digests, value, at in _distinct_batches(iter([batch])):
            none = pa.nulls(len(ids), pa.int64())
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes.astype(np.int64)), pa.array(digests, pa.binary()), none, none], names=names)
            new = np.array([d not in seen and not seen.add(d) for d in digests], bool)
            tokens.append(value[np.repeat(new, sizes)])
        held += batch.num_rows
        if held >= TOGETHER:
            yield counted()
            held = 0
    if tokens:
        yield counted()
    flat.give_back()


def prefixes(value: np.ndarray, at: np.ndarray, hot: np.ndarray, hot_df: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, shingle, whether it is frequent, place in order) of every text's prefix, and l of every text."""
    sizes = np.diff(at)
    text = np.repeat(np.arange(len(sizes)), sizes)
    if len(hot):
        i = np.minimum(np.searchsorted(hot, value), len(hot) - 1)
        df = np.where(hot[i] == value, hot_df[i], 0)
    else:
        df = np.zeros(len(value), np.int64)
    order = np.lexsort([value, df, text])
    value, df = value[order], df[order]
    rank = np.arange(len(value)) - at[text]
    need = -(-sizes * PERCENT // 100)
    base = sizes - need  # one less than the prefix for l = 1
    # cost of l: postings read, and candidates left if l of them must agree
    read = np.concatenate([[0.0], np.cumsum(df + 1.0)])
    best, shared = np.full(len(sizes), np.inf), np.ones(len(sizes), np.int64)
    for l in range(1, MOST_SHARED + 1):
        fits = need >= l
        brought = read[np.minimum(at[:-1] + base + l, at[1:])] - read[at[:-1]]
        cost = np.where(fits, brought * (1 + VERIFY_COST / l), np.inf)
        better = cost < best * (0.999 if l > 1 else 1)
        extra = df[np.minimum(at[:-1] + base, len(df) - 1)] > 0 if len(df) else np.zeros(len(sizes), bool)
        better &= (l == 1) | extra  # longer prefixes only pay where they meet frequent shingles
        best, shared = np.where(better, cost, best), np.where(better, l, shared)
    inside = rank < (base + shared)[text]
    return text[inside], value[inside], df[inside] > 0, rank[inside], shared


def _posting_task(buckets: int, hot: np.ndarray, hot_df: np.ndarray):
    names = ["bucket", "tokens", "docs", "sizes", "places", "shared"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, seen, held = [], set(), 0

        def packed() -> pa.RecordBatch:
            bucket, *columns = (np.concatenate(c) for c in zip(*parts))
            parts.clear()
            seen.clear()
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order])) + 1
            groups = [g for g in np.split(order, cuts) if len(g)]
            return pa.RecordBatch.from_arrays(
                [pa.array([int(bucket[g[0]]) for g in groups], pa.int64())]
                + [pa.array([flat.squeezed(c[g]) for g in groups], pa.binary()) for c in columns], names=names,
            )

        for batch in batches:
            for ids, sizes, digests, value, at in _distinct_batches(iter([batch])):
                text, token, frequent, place, shared = prefixes(value, at, hot, hot_df)
                # of equal sets in a batch one goes on: the digest links the others
                known = ids.is_valid().to_numpy(zero_copy_only=False)
                new = np.array([bool(ok) and n > 0 and d not in seen and not seen.add(d) for ok, n, d in zip(known, sizes, digests)], bool)
                keep = new[text]
                text, token, frequent, place = text[keep], token[keep], frequent[keep], place[keep]
                doc = ids.fill_null(0).to_numpy(zero_copy_only=False)[text]
                # what is known to be frequent needs no look for company, and is spread by document
                bucket = np.where(frequent, buckets + (doc & 1023), (token % U(buckets)).astype(np.int64))
                parts.append((bucket, token, doc.astype(np.int64), sizes[text].astype(np.int32), place.astype(np.int32), shared[text].astype(np.int8)))
            held += batch.num_rows
            if held >= TOGETHER:
                yield packed()
                held = 0
        if parts:
            yield packed()
        flat.give_back()

    return run


def _shared_postings(buckets: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        token, doc, size, place, shared = (
            np.concatenate([flat.opened(x.as_buffer(), t) for x in table.column(c)])
            for c, t in (("tokens", U), ("docs", np.int64), ("sizes", np.int32), ("places", np.int32), ("shared", np.int8))
        )
        if key[0].as_py() < buckets:
            order = np.argsort(token, kind="stable")
            s = token[order]
            same = s[1:] == s[:-1]
            keep = np.zeros(len(s), bool)
            keep[1:] |= same
            keep[:-1] |= same
            order = order[keep]
            token, doc, size, place, shared = token[order], doc[order], size[order], place[order], shared[order]
        return pa.table({"token": token.view(np.int64), "doc": doc, "n": size, "place": place, "l": shared.astype(np.int32)})

    return run


def _sets(short: bool):
    """The last column, a text, replaced by the size of its set and the set. A short set holds
    the distinct low bits of its hashes only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wide = batch.num_columns - 1
            for a, b, data, bounds in flat.chunks(batch.column(wide)):
                value, at = shingle_sets(data, bounds)
                each = [value[x:y] for x, y in zip(at[:-1], at[1:])]
                if short:
                    each = [np.unique(v.astype(np.uint16 if len(v) <= SHORT else np.uint32)) for v in each]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(a, b - a) for i in range(wide)), pa.array(np.diff(at).astype(np.int64)), pa.array([v.tobytes() for v in each], pa.binary())],
                    names=[*batch.schema.names[:wide], "n", "set"],
                )
        flat.give_back()

    return run


def _both(x: np.ndarray, y: np.ndarray) -> int:
    both = np.sort(np.concatenate([x, y]), kind="stable")
    return int((both[1:] == both[:-1]).sum())


def _overlaps(short: bool):
    """The pairs of a group that are similar enough; with short sets, that may be: what is lost when
    hashes of one set fall together is added to the low bits in common.
    """

    def run(key: tuple, pairs: pa.Table, sets: pa.Table) -> pa.Table:
        size = dict(zip(sets.column("doc").to_pylist(), sets.column("n").to_pylist()))
        kind = lambda n: U if not short else np.uint16 if n <= SHORT else np.uint32
        of = {d: np.frombuffer(v.as_buffer(), kind(size[d])) for d, v in zip(sets.column("doc").to_pylist(), sets.column("set"))}
        keep = np.zeros(pairs.num_rows, bool)
        for r, (i, j) in enumerate(zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist())):
            x, y = of[i], of[j]
            if x.dtype != y.dtype:
                x, y = np.unique(x.astype(np.uint16)), np.unique(y.astype(np.uint16))
            common = _both(x, y) + min(size[i] - len(x), size[j] - len(y))
            keep[r] = (100 + PERCENT) * common >= PERCENT * (size[i] + size[j])
        return pairs.select(["a", "b", "g"]).filter(pa.array(keep))

    return run


def _place(pairs: DataFrame, set_bytes: float) -> DataFrame:
    """The pairs with the group that compares them (``g``).

    Candidates come in clusters. A set goes to its cluster once; small clusters share a task,
    and large ones are cut into tiles, with a task for every two tiles that have a pair.
    """
    clusters = settle(components(pairs), "clusters")
    n = clusters.count()
    bundles = max(1, -(-int(n * set_bytes) // BUCKET_BYTES))
    tiles = clusters.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / F.lit(TILE)).cast("int").alias("tiles"))
    tile = lambda c: F.pmod(F.xxhash64(c), F.col("tiles")).cast("int")
    whole = F.col("tiles") == 1
    group = F.struct(
        F.when(whole, F.pmod(F.xxhash64("component"), F.lit(bundles))).otherwise(F.col("component")).alias("c"),
        F.when(whole, -1).otherwise(F.least(tile("a"), tile("b"))).alias("s"),
        F.when(whole, -1).otherwise(F.greatest(tile("a"), tile("b"))).alias("t"),
    )
    placed = pairs.join(clusters, F.col("a") == F.col("node")).join(tiles, "component").select("a", "b", group.alias("g"))
    return settle(placed, "placed")


def _compared(placed: DataFrame, rows: DataFrame, few: bool, short: bool) -> DataFrame:
    """The placed pairs whose sets pass, with their group."""
    wanted = placed.select(F.col("a").alias("doc"), "g").unionByName(placed.select(F.col("b").alias("doc"), "g"))
    wanted = wanted.groupBy("doc").agg(F.collect_set("g").alias("gs"))
    # at most two ids a pair, and the pairs are counted; if they are many, texts are dealt out by id
    near = F.broadcast(wanted) if few else wanted
    sets = rows.join(near, F.col("doc_id") == F.col("doc")).select("doc", "gs", "text").mapInArrow(
        _sets(short), T.StructType([*wanted.schema.fields, T.StructField("n", T.LongType()), T.StructField("set", T.BinaryType())])
    )
    sent = sets.select("doc", "n", "set", F.explode("gs").alias("g"))
    return placed.groupBy("g").cogroup(sent.groupBy("g")).applyInArrow(_overlaps(short), placed.schema)


def verified(pairs: DataFrame, rows: DataFrame, set_bytes: float) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough. ``rows``: doc_id, text.

    Low bits of the hashes, a quarter of the size, give an upper bound for the overlap first; what passes
    is decided on the hashes themselves.
    """
    placed = _place(pairs, set_bytes)
    likely = settle(_compared(placed, rows, placed.count() <= FEW, True), "likely")
    return _compared(likely, rows, likely.count() <= FEW, False).select("a", "b")


def _enough(m, n, o, la, lb, x, y, least, most, floor):
    """Whether a candidate can be similar enough, for columns or arrays.

    ``m`` prefix shingles are shared, the last at places ``x`` and ``y`` of sets of sizes ``n`` and ``o``. Whatever else they
    share comes later in both and lies outside one of the prefixes, so no more of it is left than
    the part of that set after its prefix, and than the rest of the other set.
    """
    px, py = floor(n * (100 - PERCENT) / 100) + la, floor(o * (100 - PERCENT) / 100) + lb
    rest = most(least(n - px, o - y - 1), least(n - x - 1, o - py))
    return (m >= least(la, lb)) & ((100 + PERCENT) * (m + rest) >= PERCENT * (n + o))


_PAIR = (("a", np.int64), ("b", np.int64), ("n", np.int32), ("o", np.int32), ("la", np.int8), ("lb", np.int8), ("m", np.int32), ("x", np.int32), ("y", np.int32))


def _merged(c: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Counts of each pair added up, places at their last."""
    order = np.lexsort([c["b"], c["a"]])
    c = {k: v[order] for k, v in c.items()}
    if not len(order):
        return c
    first = np.flatnonzero(np.concatenate([[True], (c["a"][1:] != c["a"][:-1]) | (c["b"][1:] != c["b"][:-1])]))
    out = {k: v[first] for k, v in c.items()}
    out["m"] = np.add.reduceat(c["m"], first)
    out["x"], out["y"] = np.maximum.reduceat(c["x"], first), np.maximum.reduceat(c["y"], first)
    return out


def _across(buckets: int):
    """Pairs of documents in different components that share shingles of a group, packed by pair.

    A row of ``half`` 0 or 1 meets only rows of the other half, one of 2 meets all.
    """
    names = ["bucket", *(c for c, _ in _PAIR)]
    columns = ("token", "doc", "n", "place", "l", "part", "half")

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches([b.select(columns) for b in batches])
        token, doc, n, place, l, part, half = (table.column(c).to_numpy() for c in columns)
        order = np.lexsort([doc, part, token])
        token, doc, n, place, l, part, half = (v[order] for v in (token, doc, n, place, l, part, half))
        ends = np.append(np.flatnonzero(token[1:] != token[:-1]) + 1, len(token))
        out: list[tuple] = []
        held = 0

        def take() -> pa.RecordBatch:
            i, j = (np.concatenate(c) for c in zip(*out))
            out.clear()
            high = doc[i] > doc[j]
            i, j = np.where(high, i, j), np.where(high, j, i)
            pairs = _merged({
                "a": doc[i], "b": doc[j], "n": n[i], "o": n[j], "la": l[i], "lb": l[j],
                "m": np.ones(len(i), np.int32), "x": place[i], "y": place[j],
            })
            to = (flat.mixed(pairs["a"].view(U) * U(31) + pairs["b"].view(U)) % U(buckets)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            groups = [g for g in np.split(order, np.flatnonzero(np.diff(to[order])) + 1) if len(g)]
            return pa.RecordBatch.from_arrays(
                [pa.array([int(to[g[0]]) for g in groups], pa.int64())]
                + [pa.array([flat.squeezed(pairs[c][g].astype(t)) for g in groups], pa.binary()) for c, t in _PAIR], names=names,
            )

        start = 0
        for end in ends.tolist():
            # each component against what comes after it
            cuts = np.flatnonzero(part[start + 1 : end] != part[start : end - 1]) + 1 + start
            begins = [start, *cuts.tolist()]
            for a, b in zip(begins, cuts.tolist()):
                for i in range(a, b):
                    other = slice(b, end)
                    meets = (n[other] * 100 >= n[i] * PERCENT) & (n[i] * 100 >= n[other] * PERCENT)
                    near = np.flatnonzero(meets & ((half[other] != half[i]) | (half[i] == 2))) + b
                    if len(near):
                        out.append((np.full(len(near), i), near))
                        held += len(near)
                        if held > HELD_PAIRS:
                            yield take()
                            held = 0
            start = end
        if out:
            yield take()

    return run


def _tiled(placed: DataFrame, sides: DataFrame) -> DataFrame:
    """Postings of shingles that many documents hold, once for each group (``g``) they belong to.

    Side 0 is the largest component of a shingle and needs no look at itself. Shingles of the same largest
    component and like numbers share their groups, so that their pairs are added up there.
    """
    power = lambda n: F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(F.col(n), F.lit(1)) / F.lit(POSTINGS)))).cast("int")
    tiles = lambda p: F.pow(F.lit(2), F.col(p)).cast("int")
    cut = sides.select("token", "largest", power("c0").alias("p"), power("c1").alias("q"))
    side = F.col("part") == F.col("largest")
    tile = F.pmod(F.xxhash64("doc"), F.when(side, tiles("p")).otherwise(tiles("q"))).cast("int")
    group = lambda s, i, j, half: F.struct(F.lit(s).alias("s"), i.alias("i"), j.alias("j"), half.cast("int").alias("half"))
    one, t = F.lit(1), F.col("tile")
    with_others = F.transform(F.sequence(F.lit(0), tiles("q") - one), lambda j: group(0, t, j, F.lit(0)))
    with_largest = F.transform(F.sequence(F.lit(0), tiles("p") - one), lambda i: group(0, i, t, F.lit(1)))
    with_own = F.transform(
        F.sequence(F.lit(0), tiles("q") - one),
        lambda j: group(1, F.least(t, j), F.greatest(t, j), F.when(t == j, 2).when(t < j, 0).otherwise(1)),
    )
    rows = placed.join(cut, "token").withColumn("tile", tile)
    rows = rows.withColumn("to", F.explode(F.when(side, with_others).otherwise(F.concat(with_largest, with_own))))
    where = F.struct(F.col("largest").alias("c"), "p", "q", "to.s", "to.i", "to.j").alias("g")
    return rows.select("token", "doc", "n", "place", "l", "part", F.col("to.half").alias("half"), where)


def _counted(key: tuple, table: pa.Table) -> pa.Table:
    """The pairs of a bucket that can be similar enough."""
    c = {k: np.concatenate([flat.opened(v.as_buffer(), t) for v in table.column(k)]).astype(np.int64) for k, t in _PAIR}
    c = _merged(c)
    keep = _enough(c["m"], c["n"], c["o"], c["la"], c["lb"], c["x"], c["y"], np.minimum, np.maximum, np.floor)
    return pa.table({"a": c["a"][keep], "b": c["b"][keep]})


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id``, and ``set_id`` (the smallest id with an equal set)."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    survey = settle(rows.mapInArrow(_survey, "doc_id long, n long, digest binary, token long, df long"), "survey")
    every = survey.where("digest is not null").select("doc_id", "n", "digest")
    n_docs, n_tokens = every.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    least = max(LEAST_FREQUENT, int(n_docs * SHARE))
    # at most (shingles per document / SHARE) rows
    hot = survey.where("token is not null").groupBy("token").agg(F.sum("df").alias("df")).where(F.col("df") >= least).toPandas()
    tokens = hot["token"].to_numpy().astype(np.int64).view(U)
    order = np.argsort(tokens)
    buckets = max(1, -(-int(n_tokens * (100 - PERCENT) / 100) * 25 // BUCKET_BYTES))
    packed = rows.mapInArrow(
        _posting_task(buckets, tokens[order], hot["df"].to_numpy().astype(np.int64)[order]),
        "bucket long, tokens binary, docs binary, sizes binary, places binary, shared binary",
    )
    postings = settle(packed.groupBy("bucket").applyInArrow(_shared_postings(buckets), "token long, doc long, n int, place int, l int"), "postings")
    set_bytes = 8.0 * n_tokens / max(1, n_docs)
    # first step: one hub each
    tops = postings.groupBy("token").agg(F.min(F.struct("doc", "n", "l", "place")).alias("top"))
    met = postings.join(tops, "token").where("doc <> top.doc").select(
        F.col("doc").alias("a"), F.col("top.doc").alias("b"), "n", F.col("top.n").alias("o"),
        F.col("l").alias("la"), F.col("top.l").alias("lb"), F.col("place").alias("x"), F.col("top.place").alias("y"),
    )
    counted = met.groupBy("a", "b").agg(
        F.max("n").alias("n"), F.max("o").alias("o"), F.max("la").alias("la"), F.max("lb").alias("lb"),
        F.count(F.lit(1)).alias("m"), F.max("x").alias("x"), F.max("y").alias("y"),
    ).where(_enough(*map(F.col, ("m", "n", "o", "la", "lb", "x", "y")), F.least, F.greatest, F.floor))
    hubs = settle(counted.groupBy("a").agg(F.max_by("b", F.struct("m", -F.col("b"))).alias("b")), "hubs")
    known = every.where("doc_id is not null and n > 0")
    sets = known.groupBy("digest").agg(F.min("doc_id").alias("set_id"))
    same = settle(known.join(sets, "digest").select("doc_id", "set_id", "n").distinct(), "sets")
    links = settle(verified(hubs, rows, set_bytes), "links").unionByName(
        same.where("doc_id <> set_id").select(F.col("doc_id").alias("a"), F.col("set_id").alias("b"))
    )
    first = settle(components(links), "first")
    # second step: what shares shingles across components
    # read by three jobs, so written once; where the components are few, postings of a shingle stay together
    near = F.broadcast(first) if first.count() <= FEW else first
    placed = settle(postings.join(near, F.col("doc") == F.col("node"), "left").select(
        "token", "doc", "n", "place", "l", F.coalesce("component", "doc").alias("part")
    ), "placed")
    mixed_ = placed.groupBy("token").agg(F.min("part").alias("p"), F.max("part").alias("q"), F.count(F.lit(1)).alias("held"))
    mixed_ = settle(mixed_.where("p <> q").select("token", "held"), "mixed")
    few, many = (mixed_.where(F.col("held") <= POSTINGS).select("token"), mixed_.where(F.col("held") > POSTINGS).select("token"))
    none = [F.lit(-1).alias(c) for c in ("p", "q", "s", "i", "j")]
    open_ = placed.join(few, "token", "left_semi").select(
        *placed.columns, F.lit(2).alias("half"), F.struct(F.pmod(F.xxhash64("token"), F.lit(buckets)).alias("c"), *none).alias("g")
    )
    # at most one shingle for POSTINGS postings
    shares = placed.join(F.broadcast(many), "token", "left_semi").groupBy("token", "part").agg(F.count(F.lit(1)).alias("c"))
    sides = settle(shares.groupBy("token").agg(
        F.max_by("part", F.struct("c", "part")).alias("largest"), F.max("c").alias("c0"), (F.sum("c") - F.max("c")).alias("c1")
    ), "sides")
    across = sides.agg(F.sum(F.col("c1").cast("double") * (F.col("c0") + F.col("c1") / 2))).first()[0]
    if across is not None:
        open_ = open_.unionByName(_tiled(placed, sides))
    # groups that add up the pairs grow with them
    adding = 4 * buckets + int((across or 0) * sum(np.dtype(t).itemsize for _, t in _PAIR) // BUCKET_BYTES)
    found = open_.groupBy("g").applyInArrow(_across(adding), "bucket long, " + ", ".join(f"{c} binary" for c, _ in _PAIR))
    pairs = found.groupBy("bucket").applyInArrow(_counted, "a long, b long")
    pairs = settle(pairs.join(hubs, ["a", "b"], "left_anti"), "pairs")
    more = settle(verified(pairs, rows, set_bytes), "more")
    whole = components(more.unionByName(first.select(F.col("node").alias("a"), F.col("component").alias("b"))))
    found = same.join(whole, F.col("doc_id") == F.col("node"), "left").groupBy("doc_id").agg(
        F.min(F.coalesce("component", "doc_id")).alias("component"), F.min("set_id").alias("set_id")
    )
    return every.select("doc_id", "n").join(found, "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce("set_id", "doc_id").alias("set_id"),
    )


def one_per_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Of each component the document with the smallest id, once; rows without id all stay.

    Of rows that repeat that id, the one with the smallest hash of its text stays.
    """
    ids = jaccard_components(docs, doc_id, text).where("doc_id is not null").groupBy("doc_id").agg(
        F.max("component_id").alias("c"), F.count(F.lit(1)).alias("n")
    )
    # only ids that lose rows are listed: far fewer than those that stay, so that they may be broadcast where the others may not
    some = ids.where("doc_id <> c or n > 1").select("doc_id", F.col("doc_id") == F.col("c"))
    some = settle(some, "some").toDF("_some", "_several")
    # texts are dealt out once at most; only those of repeated ids are numbered
    found = docs.where(F.col(doc_id).isNotNull()).join(some, F.col(doc_id).cast("long") == F.col("_some"), "left")
    turn = F.row_number().over(Window.partitionBy("_some").orderBy(F.xxhash64(text)))
    again = found.where("_several").withColumn("_turn", turn).where("_turn = 1")
    out = found.where("_several is null").select(docs.columns).unionByName(again.select(docs.columns))
    return out.unionByName(docs.where(F.col(doc_id).isNull()))
