"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text is cut into bins; boosting goes round the features in turn, fits a shallow tree
on the bins and adds it to the feature's lookup table. Then the pairs of features with the
strongest joint effect on what is left get two-way tables, boosted the same way. A score is the
sum of one table entry per feature and pair, by array lookups.

The model is fitted on the driver on a bounded sample of labelled rows (``SAMPLE``); everything
else runs in tasks over all rows. Labels, language, source and id are no features.

Defined cases: null and empty texts are scored like a text without words; rows with a null label are not
learned from; without labels of both kinds every score is the smoothed share of label 1;
repeated rows are scored one by one; an empty table gives an empty table. Columns named
``score`` or ``predicted`` in the input are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm import flat
from tallymark.llm.passing import add_columns
from tallymark.llm.quality_rules import SYMBOLS

#: Labelled rows the fit takes at most: those with the smallest hashes of their ids.
SAMPLE = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 8
ROUNDS, PAIR_ROUNDS, RATE, PRIOR = 120, 40, 0.1, 5.0

FEATURES = (
    "words", "word_length", "symbols", "upper", "digits", "stops", "marks", "equal_neighbours", "distinct",
    "short_words", "repeated_lines", "repeated_fives", "words_per_line", "capital_words", "other_bytes",
    "entropy", "longest_word", "single_letters",
)

UPPER, DIGIT, STOP, MARK, LETTER = (np.zeros(256, bool) for _ in range(5))
UPPER[65:91] = True
DIGIT[48:58] = True
STOP[[ord(c) for c in ".,;:"]] = True
MARK[[ord(c) for c in "!?"]] = True
LETTER[65:91] = LETTER[97:123] = True


def features(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of FEATURES per text of a chunk."""
    n_texts = len(bounds) - 1
    begins, ends, n_words = flat.words(data, bounds)
    word_at = np.concatenate([[0], np.cumsum(n_words)])
    text_of = np.repeat(np.arange(n_texts), n_words)
    size = np.diff(bounds)
    leads = np.zeros(len(data) + 1, np.int64)
    np.cumsum(flat.LEADS[data], out=leads[1:])
    length = leads[ends] - leads[begins]
    salt = flat.mixed(text_of.astype(np.uint64) + np.uint64(1))
    word = flat.hashes(data, begins, ends)
    per_word = lambda flags: flat.per_text(flags, word_at)
    per_byte = lambda table: flat.per_text(table[data], bounds)
    share = lambda a, b: a / np.maximum(b, 1)
    equal = np.zeros(len(word), bool)
    equal[1:] = (word[1:] == word[:-1]) & (text_of[1:] == text_of[:-1])
    _, again = flat.repeats(word ^ salt)
    repeated = np.zeros(len(word), bool)
    repeated[again] = True
    rolled = word.copy()
    n = len(word)
    for k in range(2, 6):
        if n >= k:
            rolled[: n - k + 1] = rolled[: n - k + 1] * np.uint64(0xC2B2AE3D27D4EB4F) + word[k - 1 :]
    at = np.flatnonzero(word_at[text_of + 1] - np.arange(n) >= 5)
    _, later = flat.repeats(flat.mixed(rolled[at]) ^ salt[at], at)
    fives = flat.covered(later, 5, n)
    l_begin, l_end, each = flat.lines(data, bounds)
    l_text = np.repeat(np.arange(n_texts), each)
    full = np.flatnonzero(l_end > l_begin)
    keys = flat.hashes(data, l_begin[full], l_end[full]) ^ flat.mixed(l_text[full].astype(np.uint64) + np.uint64(1))
    _, l_later = flat.repeats(keys, full)
    l_repeat = np.bincount(l_text[l_later], (l_end - l_begin)[l_later], minlength=n_texts)
    filled = np.bincount(l_text[full], minlength=n_texts)
    owner = np.repeat(np.arange(n_texts), size)
    counts = np.bincount(owner * 256 + data, minlength=n_texts * 256).reshape(n_texts, 256)
    p = counts / np.maximum(size, 1)[:, None]
    entropy = -(p * np.log2(np.where(p > 0, p, 1))).sum(axis=1)
    longest = np.zeros(n_texts)
    np.maximum.at(longest, text_of, length)
    first = data[begins] if n else data[:0]
    return np.stack([
        np.log1p(n_words), share(per_word(length), n_words), share(per_byte(SYMBOLS), n_words),
        share(per_byte(UPPER), per_byte(LETTER)), share(per_byte(DIGIT), size), share(per_byte(STOP), n_words),
        share(per_byte(MARK), n_words), share(per_word(equal), n_words), 1 - share(per_word(repeated), n_words),
        share(per_word(length <= 3), n_words), share(l_repeat, size), share(per_word(fives), n_words),
        np.log1p(share(n_words, filled)), share(per_word(UPPER[first]), n_words), share(per_byte(~LETTER & (np.arange(256) > 127)), size),
        entropy, np.log1p(longest), share(per_word(length == 1), n_words),
    ], axis=1).astype(float)


@dataclass
class Model:
    base: float
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def logit(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for j, table in enumerate(self.tables):
            out += table[np.searchsorted(self.cuts[j], x[:, j], "right")]
        wide = {j: np.searchsorted(self.coarse[j], x[:, j], "right") for pair in self.pairs for j in pair}
        for (i, j), table in zip(self.pairs, self.pair_tables):
            out += table[wide[i], wide[j]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


def _cut(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.arange(1, bins) / bins))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + PRIOR)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Values per bin of a tree with few leaves, cut where the loss falls most."""
    parts, gs, hs = [(0, len(g))], np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    while len(parts) < leaves:
        best = (1e-9, None, None)
        for a, b in parts:
            if b - a < 2:
                continue
            at = np.arange(a + 1, b)
            gain = _gain(gs[at] - gs[a], hs[at] - hs[a]) + _gain(gs[b] - gs[at], hs[b] - hs[at]) - _gain(gs[b] - gs[a], hs[b] - hs[a])
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], (a, b), int(at[k]))
        if best[1] is None:
            break
        a, b = best[1]
        parts = [p for p in parts if p != (a, b)] + [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = (gs[b] - gs[a]) / (hs[b] - hs[a] + PRIOR)
    return out


def _cross(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree that cuts the first feature, then the second on either side."""
    best = (0.0, np.zeros(g.shape))
    for at in range(1, g.shape[0]):
        gain, values = 0.0, np.zeros(g.shape)
        for rows in (slice(0, at), slice(at, None)):
            side = _tree(g[rows].sum(axis=0), h[rows].sum(axis=0), 2)
            values[rows] = side
            for v in np.unique(side):
                same = side == v
                gain += float(_gain(g[rows][:, same].sum(), h[rows][:, same].sum()))
        if gain > best[0]:
            best = (gain, values)
    return best


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Boost the tables on rows of features and 0/1 labels."""
    prior = (y.sum() + 1) / (len(y) + 2)
    model = Model(float(np.log(prior / (1 - prior))))
    if len(np.unique(y)) < 2:
        return model
    model.cuts = [_cut(c, BINS) for c in x.T]
    model.coarse = [_cut(c, PAIR_BINS) for c in x.T]
    fine = [np.searchsorted(c, v, "right") for c, v in zip(model.cuts, x.T)]
    wide = [np.searchsorted(c, v, "right") for c, v in zip(model.coarse, x.T)]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    logit = np.full(len(y), model.base)
    for _ in range(ROUNDS):
        for j, bins in enumerate(fine):
            p = 1 / (1 + np.exp(-logit))
            n = len(model.tables[j])
            step = RATE * _tree(np.bincount(bins, y - p, n), np.bincount(bins, p * (1 - p), n))
            model.tables[j] += step
            logit += step[bins]

    def joint(i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        shape = (len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)
        cell, p = wide[i] * shape[1] + wide[j], 1 / (1 + np.exp(-logit))
        size = shape[0] * shape[1]
        return cell, np.bincount(cell, y - p, size).reshape(shape), np.bincount(cell, p * (1 - p), size).reshape(shape)

    every = [(i, j) for i in range(len(fine)) for j in range(i + 1, len(fine))]
    strength = {pair: _cross(*joint(*pair)[1:])[0] for pair in every}
    model.pairs = sorted(every, key=lambda pair: (-strength[pair], pair))[:PAIRS]
    model.pair_tables = [np.zeros((len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)) for i, j in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, pair in enumerate(model.pairs):
            cell, g, h = joint(*pair)
            step = RATE * _cross(g, h)[1]
            model.pair_tables[k] += step
            logit += step.ravel()[cell]
    return model


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE,
) -> Model:
    """Fit on at most ``sample`` of the labelled rows. Of an id's several labels the largest counts."""
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).cast("int").alias("_y"))
    some = known.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    # at most ``sample`` rows of two numbers
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text")).join(F.broadcast(some), "_id")
    measured = add_columns(rows, "text", "x array<double>", _as_lists).select("_id", "_y", "x")
    got = measured.toPandas().sort_values("_id", kind="stable")
    x = np.array(got["x"].tolist(), float).reshape(len(got), len(FEATURES))
    order = np.lexsort([*x.T, got["_id"].to_numpy()])  # repeated ids too come in a fixed order
    return fit(x[order], got["_y"].to_numpy().astype(float)[order]) if len(got) else Model(0.0)


def _as_lists(data: np.ndarray, bounds: np.ndarray) -> list[pa.Array]:
    x = features(data, bounds)
    return [pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], pa.array(x.ravel()))]


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows with ``score`` (of label 1) and ``predicted``; no shuffle."""

    def work(data: np.ndarray, bounds: np.ndarray) -> list[pa.Array]:
        s = model.score(features(data, bounds))
        return [pa.array(s), pa.array((s >= 0.5).astype(np.int32))]

    return add_columns(docs, text, "score double, predicted int", work)
