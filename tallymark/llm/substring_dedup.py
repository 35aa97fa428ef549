"""Removal of long repeated substrings with suffix arrays over shards.

Every window of ``LENGTH`` bytes has an anchor: the GRAM-byte string in it with the smallest hash,
the leftmost of equal ones. Equal windows have equal anchors, so a shard that holds everything
around the anchors it is given can decide about their windows alone. Runs of windows with the same anchor
are segments; equal segments are merged (their windows occur as often as they do), anchors that
occur once are dropped, and the texts of the other segments go to shards by their anchors. A shard
sorts its suffixes by induction, computes the permuted common prefixes, and marks windows that share
LENGTH bytes with a neighbour in order.

Anchors of many different segments are listed beforehand; their segments are cut into classes by the
distance of window and anchor, and dealt by the bytes all windows of the class contain, so that a
short line that a third of all documents hold does not meet in one shard. The list has at most
(anchors per document / SHARE) entries whatever the corpus; results do not depend on it.

At the edges of a passage that many documents hold, those bytes lie inside it while the segments reach into
each document's own text. Classes with more than HEAVY different segments are listed by a second survey and cut
into single windows, dealt by the hash of the window: equal windows of a batch are merged before
the shuffle, and others need no shard unless their hashes fall together. This list has at most
(segments of frequent anchors / HEAVY) entries.

Defined cases: null and empty texts, and those below LENGTH bytes, keep everything; repeated rows are
documents of their own, so each is a copy of the other; null ids are allowed; an empty table gives
an empty table; columns named like a result column are replaced. Windows are told apart by bytes in
shards, equal segments by two 64-bit hashes, rows by id and a 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm import flat
from tallymark.llm.induced import common_prefixes, suffix_array
from tallymark.plans.lineage import settle

LENGTH, GRAM = 200, 32
#: Width of a class of windows of a frequent anchor; share and number of documents that make one frequent.
CLASS, SHARE, LEAST_FREQUENT = 21, 1 / 2000, 64
BUCKET_BYTES, SHARD_BYTES = 24 << 20, 1 << 20
#: Bytes of segments or of texts that a task holds as objects before it sends them on.
SENT_BYTES = 1 << 20
#: Different segments of a class that fill a shard.
HEAVY = SHARD_BYTES // (LENGTH + CLASS)
#: Bits for a position beside a hash, and windows taken at a time in a text too long for them.
PLACE, PIECE = 24, 8 << 20
#: Seed of the hash that deals single windows.
ALONE = 1 << 32
U = np.uint64


def segments(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of every run of windows with one anchor: text, first window, number of windows, anchor, hash."""
    n, top = len(data), (1 << PLACE) - 1
    if n > top:  # one long text
        parts = []
        for a in range(0, n - LENGTH + 1, PIECE):
            b = min(n, a + PIECE + LENGTH - 1)
            text, first, count, anchor, h = segments(data[a:b], np.array([0, b - a]))
            parts.append((text, first + a, count, anchor + a, h))
        text, *rest = (np.concatenate(c) for c in zip(*parts))
        return np.searchsorted(bounds, rest[0], "right") - 1, *rest
    if n < LENGTH:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none.astype(U)
    h, width, factor = flat.BYTE_CODE[data], 1, int(flat.STEP)
    while width < GRAM:
        h = h[:-width] * U(factor) + h[width:]
        width, factor = 2 * width, factor * factor % 2**64
    h = flat.mixed(h)
    least = (h & U(2**64 - 1 - top)) | np.arange(len(h), dtype=U)
    width, grams = 1, LENGTH - GRAM + 1
    while 2 * width <= grams:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < grams:
        least = np.minimum(least[: -(grams - width)], least[grams - width :])
    size = np.diff(bounds)
    long = np.flatnonzero(size >= LENGTH)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, bounds[long], 1)
    np.add.at(edge, bounds[long + 1] - LENGTH + 1, -1)
    windows = np.flatnonzero(np.cumsum(edge[: n - LENGTH + 1]) > 0)
    if not len(windows):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none.astype(U)
    anchor = (least[windows] & U(top)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    count = np.diff(np.append(first, len(windows)))
    begin, anchor = windows[first], anchor[first]
    return np.searchsorted(bounds, begin, "right") - 1, begin, count, anchor, h[anchor]


def _digests(raw: memoryview, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    of = xxhash.xxh3_64_intdigest
    return np.fromiter((of(raw[a:b]) for a, b in zip(begin.tolist(), end.tolist())), U, len(begin))


def _chunk_rows(batch: pa.RecordBatch, hot: np.ndarray, heavy: np.ndarray, only_hot: bool) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor hash, segment hash, row of the batch, first window in its text, windows) of each chunk."""
    known = set(heavy.tolist())
    for a, _, data, bounds in flat.chunks(batch.column(2)):
        text, begin, count, anchor, h = segments(data, bounds)
        raw = memoryview(np.ascontiguousarray(data))
        is_hot = np.zeros(len(h), bool)
        if len(hot) and len(h):
            i = np.minimum(np.searchsorted(hot, h), len(hot) - 1)
            is_hot = hot[i] == h
            if is_hot.any():
                cut = []
                for r in np.flatnonzero(is_hot):
                    far = int(anchor[r] - begin[r])
                    near = far - int(count[r]) + 1
                    for c in range(near // CLASS, far // CLASS + 1):
                        d0, d1 = max(near, c * CLASS), min(far, c * CLASS + CLASS - 1)
                        s = int(anchor[r]) - c * CLASS  # bytes that all windows of the class hold
                        core = xxhash.xxh3_64_intdigest(raw[s : s - CLASS + 1 + LENGTH], c + 1)
                        w = int(anchor[r]) - d1
                        if core in known:
                            cut += [(text[r], w + k, 1, xxhash.xxh3_64_intdigest(raw[w + k : w + k + LENGTH], ALONE)) for k in range(d1 - d0 + 1)]
                        else:
                            cut.append((text[r], w, d1 - d0 + 1, core))
                more_text, more_begin, more_count = (np.array([x[k] for x in cut], np.int64) for k in range(3))
                keep = ~is_hot & (not only_hot)
                text, begin, count = np.append(text[keep], more_text), np.append(begin[keep], more_begin), np.append(count[keep], more_count)
                h = np.append(h[keep], np.array([x[3] for x in cut], U))
        if only_hot and not is_hot.any():
            continue
        seg = _digests(raw, begin, begin + count - 1 + LENGTH)
        yield h, seg, text + a, begin - bounds[text] if len(text) else begin, count


def _whole_batch(batch: pa.RecordBatch, hot: np.ndarray, heavy: np.ndarray, only_hot: bool = False) -> tuple[np.ndarray, ...]:
    """All segments of a batch, or those of frequent anchors, by anchor, then segment; and where an equal segment begins."""
    parts = list(_chunk_rows(batch, hot, heavy, only_hot)) or [(np.zeros(0, U), np.zeros(0, U), *(np.zeros(0, np.int64),) * 3)]
    h, seg, row, begin, count = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort([seg, h])
    h, seg, row, begin, count = (x[order] for x in (h, seg, row, begin, count))
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (seg[1:] != seg[:-1])
    return h, seg, row, begin, count, new


_NONE = np.zeros(0, U)


def _survey(hot: np.ndarray | None = None):
    """Anchors with several different segments at hand, and how many; of frequent anchors, their classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, _, _, _, _, new = _whole_batch(batch, _NONE if hot is None else hot, _NONE, hot is not None)
            h = h[new]
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
            n = np.diff(np.append(first, len(h)))
            some = n > 1
            yield pa.RecordBatch.from_arrays([pa.array(h[first[some]].view(np.int64)), pa.array(n[some])], names=["h", "n"])

    return run


def _frequent(rows: DataFrame, least: int, hot: np.ndarray | None = None) -> tuple[np.ndarray, int]:
    """Hashes with at least so many different segments, ascending, and the number of these segments."""
    found = rows.mapInArrow(_survey(hot), "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least).toPandas()
    return np.sort(found["h"].to_numpy().astype(np.int64).view(U)), int(found["n"].sum())


PACKED = "bucket long, h binary, seg binary, doc binary, row_key binary, first binary, windows binary, m binary"
FLAT = "h long, seg long, doc long, row_key long, first int, windows int, m long, alike long, is_rep boolean"
_FIELDS = (("h", U), ("seg", U), ("doc", np.int64), ("row_key", np.int64), ("first", np.int32), ("windows", np.int16), ("m", np.int32))


def _bucket_task(buckets: int, hot: np.ndarray, heavy: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, seg, row, begin, count, new = _whole_batch(batch, hot, heavy)
            if not len(h):
                continue
            at = np.flatnonzero(new)
            size = np.diff(np.append(at, len(h)))
            m = np.ones(len(h), np.int64)
            m[at] = size
            m[~new] = 2
            doc, key = (batch.column(k).to_numpy(zero_copy_only=False)[row] for k in (0, 1))
            # of equal segments at hand one goes to the bucket; the others are copies whatever else there is
            bucket = np.where(new, (h % U(buckets)).astype(np.int64), buckets + (doc & 255))
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order])) + 1
            groups = [g for g in np.split(order, cuts) if len(g)]
            columns = (h, seg, doc, key, begin, count, m)
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(bucket[g[0]]) for g in groups], pa.int64())]
                + [pa.array([c[g].astype(t).tobytes() for g in groups], pa.binary()) for c, (_, t) in zip(columns, _FIELDS)],
                names=["bucket", *(f for f, _ in _FIELDS)],
            )

    return run


def _gather(buckets: int):
    """Segments whose anchor occurs elsewhere: how often each occurs, how many differ at its anchor."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        x = {f: np.concatenate([np.frombuffer(v.as_buffer(), t) for v in table.column(f)]) for f, t in _FIELDS}
        n = len(x["h"])
        alike, rep, m = np.zeros(n, np.int64), np.zeros(n, bool), x["m"].astype(np.int64)
        if key[0].as_py() < buckets:
            order = np.lexsort([x["first"], x["row_key"], x["doc"], x["seg"], x["h"]])
            x = {f: v[order] for f, v in x.items()}
            new_h = np.concatenate([[True], x["h"][1:] != x["h"][:-1]])
            rep = new_h.copy()
            rep[1:] |= x["seg"][1:] != x["seg"][:-1]
            s = np.cumsum(rep) - 1
            m = np.bincount(s, x["m"]).astype(np.int64)[s]
            g = np.cumsum(new_h) - 1
            alike = np.bincount(g, rep).astype(np.int64)[g]
            some = (m > 1) | (alike > 1)
            x, m, alike, rep = {f: v[some] for f, v in x.items()}, m[some], alike[some], rep[some]
        return pa.table({
            "h": x["h"].view(np.int64), "seg": x["seg"].view(np.int64), "doc": x["doc"], "row_key": x["row_key"],
            "first": x["first"].astype(np.int32), "windows": x["windows"].astype(np.int32), "m": m, "alike": alike, "is_rep": rep,
        })

    return run


def _cut_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each wanted segment of each text, sent on as soon as they are SENT_BYTES."""
    kinds = dict(h=pa.int64(), doc=pa.int64(), row_key=pa.int64(), first=pa.int32(), m=pa.int64(), bytes=pa.binary())

    def take() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds.values())], names=list(kinds))
        rows.clear()
        return out

    rows: list[tuple] = []
    held = 0
    for batch in batches:
        for text, doc, key, wanted in zip(*(batch.column(c) for c in ("text", "doc", "row_key", "wanted"))):
            raw = text.as_buffer().to_pybytes() if text.is_valid else b""
            doc, key = doc.as_py(), key.as_py()
            for w in wanted:
                w = w.as_py()
                cut = raw[w["first"] : w["first"] + w["windows"] - 1 + LENGTH]
                rows.append((w["h"], doc, key, w["first"], w["m"], cut))
                held += len(cut)
                if held >= SENT_BYTES:
                    yield take()
                    held = 0
    if rows:
        yield take()


def marked(texts: list[bytes]) -> np.ndarray:
    """For each byte of the texts laid end to end, with one place after each: whether the LENGTH bytes
    from it also begin elsewhere.
    """
    joined = np.zeros(sum(map(len, texts)) + len(texts), np.uint16)
    at = 0
    for t in texts:
        joined[at : at + len(t)] = np.frombuffer(t, np.uint8).astype(np.uint16) + 1
        at += len(t) + 1
    order = suffix_array(joined)
    shared = common_prefixes(joined, order)
    again = np.zeros(len(joined) + 1, bool)
    here = order[1:]
    long = shared[here] >= LENGTH
    again[here[long]] = True
    again[order[:-1][long]] = True
    return again[:-1]


def _sort_shard(key: tuple, table: pa.Table) -> pa.Table:
    """Runs of repeated windows of the segments that occur once."""
    texts = [t.as_buffer().to_pybytes() for t in table.column("bytes")]
    doc, row_key, first, m = (table.column(c).to_numpy() for c in ("doc", "row_key", "first", "m"))
    again = marked(texts)
    out: list[tuple] = []
    at = 0
    for i, t in enumerate(texts):
        if m[i] == 1:
            flags = np.concatenate([[False], again[at : at + len(t) - LENGTH + 1], [False]])
            turns = np.flatnonzero(flags[1:] != flags[:-1])
            out += [(doc[i], row_key[i], first[i] + a, first[i] + b - 1) for a, b in zip(turns[::2], turns[1::2])]
        at += len(t) + 1
    return pa.table({c: pa.array([r[k] for r in out], pa.int64()) for k, c in enumerate(("doc", "row_key", "a", "b"))})


def _removed(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by the windows (first to last) of the spans."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["a"], s["b"] + LENGTH) for s in spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", without: Sequence[str] = ()) -> DataFrame:
    """The rows with ``spans`` (removed byte ranges, start and end), ``n_bytes`` and ``kept`` (the bytes left).

    Columns named in ``without`` are not returned: texts that nobody wants need not come back from the tasks.
    """
    key = F.xxhash64(F.col(doc_id).cast("long"), F.col(text).cast("string"))
    keyed = docs.withColumns({"_doc": F.coalesce(F.col(doc_id).cast("long"), F.lit(0)), "_row_key": key})
    rows = keyed.select(F.col("_doc").alias("doc"), F.col("_row_key").alias("row_key"), F.col(text).cast("string").alias("text"))
    n_docs, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()
    least = max(LEAST_FREQUENT, int(n_docs * SHARE))
    # at most (anchors per document / SHARE) rows, and (their segments / HEAVY) rows
    hot, _ = _frequent(rows, least)
    heavy, n_heavy = _frequent(rows, HEAVY, hot) if len(hot) else (_NONE, 0)
    buckets = max(1, -(-(size * 2 // (LENGTH - GRAM) + n_heavy * CLASS) * 42 // BUCKET_BYTES))
    packed = rows.mapInArrow(_bucket_task(buckets, hot, heavy), PACKED)
    found = settle(packed.groupBy("bucket").applyInArrow(_gather(buckets), FLAT), "segments")
    open_ = found.where("is_rep and alike > 1")
    shards = max(1, -(-(open_.agg(F.sum(F.col("windows") + LENGTH)).first()[0] or 0) // SHARD_BYTES))
    wanted = open_.groupBy("doc", "row_key").agg(F.collect_list(F.struct("h", "first", "windows", "m")).alias("wanted"))
    cut = rows.join(wanted, ["doc", "row_key"]).select("text", "doc", "row_key", "wanted").mapInArrow(
        _cut_texts, "h long, doc long, row_key long, first int, m long, bytes binary"
    )
    sorted_ = cut.groupBy(F.pmod("h", F.lit(shards)).alias("shard")).applyInArrow(
        _sort_shard, "doc long, row_key long, a long, b long"
    )
    copies = found.where("m > 1").select("doc", "row_key", F.col("first").cast("long").alias("a"), (F.col("first") + F.col("windows") - 1).cast("long").alias("b"))
    spans = copies.unionByName(sorted_).groupBy(F.col("doc").alias("_doc"), F.col("row_key").alias("_row_key")).agg(
        F.collect_list(F.struct("a", "b")).alias("_spans")
    )
    added = T._parse_datatype_string("spans array<struct<start:int,end:int>>, n_bytes long, kept binary")
    kept = [c for c in docs.columns if c not in added.names and c not in without]
    joined = keyed.join(spans, ["_doc", "_row_key"], "left")
    # a text that goes out as it is is sent to the tasks once
    same = text in kept and dict(docs.dtypes)[text] == "string"
    at_text = kept.index(text) if same else len(kept)
    joined = joined.select(*kept, *([] if same else [F.col(text).cast("string").alias("_text")]), "_spans")

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.int64(), pa.binary()]
        for whole in batches:
            bounds = np.append(0, np.cumsum(pc.fill_null(pc.binary_length(whole.column(at_text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)))
            for lo, hi in flat.spans(bounds, SENT_BYTES):
                batch = whole.slice(lo, hi - lo)
                out: list[tuple] = []
                for t, s in zip(batch.column(at_text), batch.column(batch.num_columns - 1)):
                    raw = t.as_buffer().to_pybytes() if t.is_valid else b""
                    runs = _removed(s.as_py()) if s.is_valid else []
                    at, left = 0, []
                    for a, b in runs:
                        left.append(raw[at:a])
                        at = b
                    left.append(raw[at:])
                    out.append(([{"start": a, "end": b} for a, b in runs], len(raw), b"".join(left)))
                new = [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *new], names=[*kept, *added.names])

    return joined.mapInArrow(cut_out, T.StructType([*docs.select(*kept).schema.fields, *added.fields]))
