"""Language-model scores by prediction by partial matching (PPM) over bytes, with a word base line.

The trie of byte contexts up to order 5 is kept as sorted arrays of (context, byte) keys with
counts, split into parts by the last three context bytes, so that a part holds whole contexts of the
orders 3 to 5. Orders 0 to 2 are one small table of at most 2^24 rows. A context that has not seen
a byte escapes to the next shorter one with the estimate of method D (half a count per distinct
byte), and bytes of the longer contexts are excluded below. Longer
contexts count occurrences; shorter ones count the distinct longer contexts in which the byte was
seen, which is what updating only up to the matching order gives. Every text ends in a NUL byte,
which is predicted too. Texts are lower-cased (A-Z) first.

``train`` gathers the counts of all training rows in one distributed pass and writes them. ``score`` cuts
the rows into blocks of bounded bytes; each block asks the parts for the values of its distinct keys
and gets them back, so no task and no broadcast holds the whole model.

Words are known by 64-bit hashes. Defined cases: null and empty texts consist of the end alone; a
null id is hashed as null and its row is never training data unless the caller says so; repeated
rows count and are scored one by one; with no training rows everything is unseen (each byte
uniform); an empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm import flat
from tallymark.plans.lineage import settle

ORDER, LOW = 5, 2
#: Bytes of text in a block, and per part of the model; keys a task holds before it sends them on.
BLOCK_BYTES, PART_BYTES, HELD_KEYS = 12 << 20, 64 << 20, 1 << 20
GRAM, WORD = 0, 1
U = np.uint64

PACKED = "slot long, keys binary, counts binary, n_keys long, total long"


def grams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every byte of every text and its end: the ORDER bytes before it and itself, in 48 bits; and
    where each text begins in them. Bytes before a text are NUL.
    """
    n_texts = len(bounds) - 1
    at = bounds + np.arange(n_texts + 1)  # one more place per text
    byte = np.zeros(at[-1], U)
    place = np.ones(at[-1], bool)
    place[at[1:] - 1] = False
    byte[place] = flat.LOWER[data]
    out = byte.copy()
    for k in range(1, ORDER + 1):
        out[k:] |= byte[:-k] << U(8 * k)
    for k in range(ORDER):  # near a text's begin, what stands before it is another text
        first = at[:-1] + k
        first = first[first < at[1:]]
        out[first] &= U((1 << (8 * (k + 1))) - 1)
    return out, at


def tally(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and their counts."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    if counts is None:
        keys = np.sort(keys)
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return keys[first], np.diff(np.append(first, len(keys)))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts[order], first)


def _slots(keys: np.ndarray, kind: int, parts: int) -> np.ndarray:
    owner = flat.mixed((keys >> U(8)) & U(0xFFFFFF)) if kind == GRAM else keys
    return (owner % U(parts)).astype(np.int64) * 2 + kind


def by_slot(keys: np.ndarray, kind: int, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """(slot, positions of its keys) in order of slots; positions keep the keys' order."""
    slot = _slots(keys, kind, parts)
    order = np.argsort(slot, kind="stable")
    cuts = np.flatnonzero(np.diff(slot[order])) + 1
    for some in np.split(order, cuts) if len(order) else []:
        yield int(slot[some[0]]), some


def _block_keys(columns: Iterator[tuple[np.ndarray, np.ndarray]], kind: int) -> Iterator[np.ndarray]:
    for data, bounds in columns:
        if kind == GRAM:
            yield grams(data, bounds)[0]
        else:
            low = flat.LOWER[data]
            begins, ends, _ = flat.words(low, bounds)
            yield flat.hashes(low, begins, ends)


def _pack(rows: list[tuple], schema: list[str]) -> pa.RecordBatch:
    kinds = {"keys": pa.binary(), "counts": pa.binary(), "values": pa.binary()}
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kinds.get(c, pa.int64())) for i, c in enumerate(schema)], names=schema
    )


def _count_task(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {GRAM: [], WORD: []}
        size = {GRAM: 0, WORD: 0}

        def send(kind: int) -> pa.RecordBatch:
            keys, counts = tally(np.concatenate([k for k, _ in held[kind]]), np.concatenate([c for _, c in held[kind]]))
            held[kind], size[kind] = [], 0
            return _pack([
                (s, keys[i].tobytes(), counts[i].astype(np.int64).tobytes(), len(i), int(counts[i].sum()))
                for s, i in by_slot(keys, kind, parts)
            ], ["slot", "keys", "counts", "n_keys", "total"])

        for batch in batches:
            for _, _, data, bounds in flat.chunks(batch.column(0)):
                for kind in (GRAM, WORD):
                    for keys in _block_keys(iter([(data, bounds)]), kind):
                        if len(keys):
                            held[kind].append(tally(keys))
                            size[kind] += len(held[kind][-1][0])
                    if size[kind] > HELD_KEYS:
                        k, c = zip(*held[kind])
                        held[kind] = [tally(np.concatenate(k), np.concatenate(c))]
                        size[kind] = len(held[kind][0][0])
                        if size[kind] > HELD_KEYS // 2:
                            yield send(kind)
        for kind in (GRAM, WORD):
            if held[kind]:
                yield send(kind)

    return run


def _arrays(table: pa.Table, column: str, kind: type) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), kind) if x.is_valid else np.zeros(0, kind) for x in table.column(column)]


def _merge_part(key: tuple, table: pa.Table) -> pa.Table:
    keys, counts = tally(np.concatenate(_arrays(table, "keys", U)), np.concatenate(_arrays(table, "counts", np.int64)))
    row = (key[0].as_py(), keys.tobytes(), counts.tobytes(), len(keys), int(counts.sum()))
    return pa.Table.from_batches([_pack([row], ["slot", "keys", "counts", "n_keys", "total"])])


def _shorter(keys: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of one order less: each counts the distinct longer contexts it was seen in."""
    return tally(keys & U((1 << (8 * order)) - 1))


def _low_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for keys in _arrays(pa.Table.from_batches([batch]), "keys", U):
            for k in range(ORDER, LOW, -1):
                keys, counts = _shorter(keys, k)
            yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(counts.astype(np.int64))], names=["key", "n"])


def _find(sorted_: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Position of each wanted value (0 where missing) and whether it is there."""
    if not len(sorted_):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(sorted_, wanted), len(sorted_) - 1)
    return at, sorted_[at] == wanted


@dataclass
class Level:
    """Contexts of one order: distinct bytes, occurrences, and occurrences those bytes have one order below."""

    keys: np.ndarray
    counts: np.ndarray
    contexts: np.ndarray
    distinct: np.ndarray
    total: np.ndarray
    below: np.ndarray


def levels(top: tuple[np.ndarray, np.ndarray], order: int, least: int, under: Level | None = None) -> dict[int, Level]:
    """The trie's levels from ``order`` down to ``least``; ``under`` is the level below ``least``."""
    rows = {order: top}
    for k in range(order, least, -1):
        rows[k - 1] = _shorter(rows[k][0], k)
    out: dict[int, Level] = {}
    for k in range(least, order + 1):
        keys, counts = rows[k]
        context = keys >> U(8)
        first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(keys) else np.zeros(0, np.int64)
        lower = out.get(k - 1, under)
        below = np.zeros(len(keys), np.int64)
        if lower is not None and len(keys):
            at, there = _find(lower.keys, keys & U((1 << (8 * k)) - 1))
            below[there] = lower.counts[at[there]]
        add = (lambda x: np.add.reduceat(x, first)) if len(first) else (lambda x: x[:0])
        out[k] = Level(keys, counts, context[first], np.diff(np.append(first, len(keys))), add(counts), add(below))
    return out


def code(wanted: np.ndarray, trie: dict[int, Level], order: int = ORDER) -> np.ndarray:
    """log10 of the probability of each wanted key's byte after its context."""
    out = np.zeros(len(wanted))
    left = np.arange(len(wanted))  # those not yet predicted
    gone_n, gone_t = np.zeros(len(wanted)), np.zeros(len(wanted))  # excluded bytes and their occurrences
    for k in range(order, -1, -1):
        level = trie[k]
        keys = wanted[left] & U((1 << (8 * (k + 1))) - 1)
        at, seen = _find(level.contexts, keys >> U(8))
        if not len(level.contexts):
            continue
        distinct = np.where(seen, level.distinct[at] - gone_n[left], 0.0)
        total = np.where(seen, level.total[at] - gone_t[left], 0.0)
        here, hit = _find(level.keys, keys)
        out[left[hit]] += np.log10((level.counts[here[hit]] - 0.5) / total[hit])
        escape = ~hit & (distinct > 0)
        out[left[escape]] += np.log10(0.5 * distinct[escape] / total[escape])
        gone_n[left] = np.where(seen, level.distinct[at], 0)
        gone_t[left] = np.where(seen, level.below[at], 0)
        left = left[~hit]
    out[left] -= np.log10(256.0 - gone_n[left])
    return out


@dataclass
class Model:
    """Counts of the training rows: ``parts`` (written, packed by slot), the small table of the low orders
    (at most 2^24 keys), and the totals of the word base line.
    """

    parts: DataFrame
    n_parts: int
    low: tuple[np.ndarray, np.ndarray]
    n_texts: int
    n_tokens: int
    n_types: int


def _text_bytes(docs: DataFrame, text: str) -> int:
    return docs.agg(F.sum(F.octet_length(F.col(text)).cast("long"))).first()[0] or 0


def train(docs: DataFrame, text: str = "text") -> Model:
    """Count all rows of ``docs``."""
    n_texts, size = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.col(text)).cast("long"))).first()
    parts = max(1, -(-(size or 0) // PART_BYTES))
    counted = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(_count_task(parts), PACKED)
    merged = settle(counted.groupBy("slot").applyInArrow(_merge_part, PACKED), "counts")
    is_gram = F.col("slot") % 2 == GRAM
    low = merged.where(is_gram).select("keys").mapInArrow(_low_task, "key long, n long")
    # at most 2^24 rows, whatever the input
    table = low.groupBy("key").agg(F.sum("n").alias("n")).toPandas().sort_values("key")
    words = merged.where(~is_gram).agg(F.sum("n_keys"), F.sum("total")).first()
    return Model(
        merged, parts, (table["key"].to_numpy().astype(U), table["n"].to_numpy().astype(np.int64)),
        n_texts, (words[1] or 0) + n_texts, (words[0] or 0) + (n_texts > 0),
    )


def _need_task(parts: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        rows = []
        for kind in (GRAM, WORD):
            keys = _block_unique(table, kind)
            rows += [(s, key[0].as_py(), keys[i].tobytes()) for s, i in by_slot(keys, kind, parts)]
        return pa.Table.from_batches([_pack(rows, ["slot", "block", "keys"])])

    return run


def _block_unique(table: pa.Table, kind: int) -> np.ndarray:
    each = [tally(k)[0] for _, _, d, b in flat.chunks(table.column("text")) for k in _block_keys(iter([(d, b)]), kind)]
    return tally(np.concatenate(each))[0] if each else np.zeros(0, U)


def _value_task(low: tuple[np.ndarray, np.ndarray]):
    def run(key: tuple, asked: pa.Table, have: pa.Table) -> pa.Table:
        slot = key[0].as_py()
        keys = (_arrays(have, "keys", U) or [np.zeros(0, U)])[0]
        counts = (_arrays(have, "counts", np.int64) or [np.zeros(0, np.int64)])[0]
        rows = []
        if slot % 2 == GRAM and asked.num_rows:
            trie = levels(low, LOW, 0)
            trie |= levels((keys, counts), ORDER, LOW + 1, trie[LOW])
        for block, want in zip(asked.column("block").to_pylist(), _arrays(asked, "keys", U)):
            if slot % 2 == GRAM:
                values = code(want, trie)
            else:
                at, there = _find(keys, want)
                values = np.zeros(len(want))
                values[there] = counts[at[there]]
            rows.append((slot, block, values.astype(np.float64).tobytes()))
        return pa.Table.from_batches([_pack(rows, ["slot", "block", "values"])])

    return run


def _score_task(parts: int, n_texts: int, n_tokens: int, n_types: int):
    names = ["doc_id", "n_tokens", "n_known", "base_score", "score"]
    floor = np.log10(n_tokens + 1.0 * (n_types + 1))

    def run(key: tuple, docs: pa.Table, got: pa.Table) -> pa.Table:
        sent = dict(zip(got.column("slot").to_pylist(), _arrays(got, "values", np.float64)))
        tables = {}
        for kind in (GRAM, WORD):
            keys = _block_unique(docs, kind)
            values = np.zeros(len(keys))
            for s, i in by_slot(keys, kind, parts):
                values[i] = sent[s]
            tables[kind] = keys, values
        ids, out = docs.column("doc_id").combine_chunks(), []
        for a, b, data, bounds in flat.chunks(docs.column("text")):
            n = b - a
            score = np.zeros(n)
            key_, at = grams(data, bounds)
            for x in range(0, n, 65536):  # text numbers share a word with the 48 bits of a key
                y = min(n, x + 65536)
                owner = np.repeat(np.arange(y - x, dtype=U), np.diff(at[x : y + 1]))
                both = np.sort((key_[at[x] : at[y]] << U(16)) | owner)
                gram = both >> U(16)
                first = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
                value = tables[GRAM][1][np.searchsorted(tables[GRAM][0], gram[first])]
                each = np.repeat(value, np.diff(np.append(first, len(gram))))
                score[x:y] = np.bincount((both & U(0xFFFF)).astype(np.int64), each, minlength=y - x)
            low = flat.LOWER[data]
            begins, ends, n_words = flat.words(low, bounds)
            count = tables[WORD][1][np.searchsorted(tables[WORD][0], flat.hashes(low, begins, ends))]
            owner = np.repeat(np.arange(n), n_words)
            base = np.bincount(owner, np.log10(count + 1) - floor, minlength=n) + np.log10(n_texts + 1) - floor
            known = np.bincount(owner, count > 0, minlength=n).astype(np.int64) + (n_texts > 0)
            out.append(pa.RecordBatch.from_arrays(
                [ids.slice(a, n), pa.array(n_words + 1), pa.array(known), pa.array(base), pa.array(score)], names=names
            ))
        return pa.Table.from_batches(out)

    return run


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_tokens, n_known, train_tokens, base_score, score`` (log10)."""
    blocks = max(1, -(-_text_bytes(docs, text) // BLOCK_BYTES))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))
    asked = rows.groupBy("block").applyInArrow(_need_task(model.n_parts), "slot long, block long, keys binary")
    valued = asked.groupBy("slot").cogroup(model.parts.groupBy("slot")).applyInArrow(
        _value_task(model.low), "slot long, block long, values binary"
    )
    scored = rows.groupBy("block").cogroup(valued.groupBy("block")).applyInArrow(
        _score_task(model.n_parts, model.n_texts, model.n_tokens, model.n_types),
        "doc_id long, n_tokens long, n_known long, base_score double, score double",
    )
    return scored.withColumn("train_tokens", F.lit(model.n_tokens).cast("long"))
