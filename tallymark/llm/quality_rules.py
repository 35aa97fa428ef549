"""Quality rules by repetition coverage.

For several n, the n-word windows of a text are given rolling hashes; the share of the text's
word characters that lie in later occurrences of a window, and in lines that repeat an earlier
line, decide together with plain counts.

Defined cases: a null or empty text has no words and fails; repeated rows are judged one by one; an
empty table gives an empty table; only id and text are read, further columns do not matter. A
text is judged whole, whatever its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm import flat

# Published limits for the share of characters in repeated n-grams and lines.
NGRAM_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
LINE_LIMIT = 0.20
#: Symbols per word of running text stay far below this.
SYMBOL_LIMIT = 0.30
#: Base rule: fewest words, and share of words in 8-word windows that occur twice.
LEAST_WORDS, WINDOW, WINDOW_SHARE = 20, 8, 30

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "line_chars long, repeat_chars array<long>, base_failed boolean, kept boolean"
)


def measure(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of each text of a chunk. ``repeat_chars``: per n of NGRAM_LIMITS, characters of
    words in a window that stands earlier in the text; ``line_chars``: those of repeated lines.
    """
    n_texts = len(bounds) - 1
    leads = flat.LEADS[data] & ~flat.BLANK[data]
    chars = np.zeros(len(data) + 1, np.int64)
    np.cumsum(leads, out=chars[1:])
    begins, ends, n_words = flat.words(data, bounds)
    word_at = np.concatenate([[0], np.cumsum(n_words)])
    text_of = np.repeat(np.arange(n_texts), n_words)
    size = chars[ends] - chars[begins]
    size_at = np.concatenate([[0], np.cumsum(size)])
    out = {
        "n_words": n_words, "word_chars": size_at[word_at[1:]] - size_at[word_at[:-1]],
        "n_symbols": flat.per_text(SYMBOLS[data], bounds),
    }
    # lines with a word that equal an earlier one of the text
    l_begin, l_end, each = flat.lines(data, bounds)
    l_text = np.repeat(np.arange(n_texts), each)
    l_chars = chars[l_end] - chars[l_begin]
    full = np.flatnonzero(l_chars > 0)
    keys = flat.hashes(data, l_begin[full], l_end[full]) ^ flat.mixed(l_text[full].astype(np.uint64) + np.uint64(1))
    _, later = flat.repeats(keys, full)
    out["n_dup_lines"] = np.bincount(l_text[later], minlength=n_texts)
    out["line_chars"] = np.bincount(l_text[later], l_chars[later], minlength=n_texts).astype(np.int64)
    # windows of words, longer ones only where the shorter one is repeated
    n, step = len(begins), np.uint64(0xC2B2AE3D27D4EB4F)
    word = flat.hashes(data, begins, ends)
    left = word_at[text_of + 1] - np.arange(n)  # words from here to the end of the text
    rolled, salt = word.copy(), flat.mixed(text_of.astype(np.uint64) + np.uint64(1))
    shortest, longest = min([WINDOW, *NGRAM_LIMITS]), max([WINDOW, *NGRAM_LIMITS])
    found, at = {}, None
    for k in range(2, longest + 1):
        rolled[: n - k + 1] = rolled[: n - k + 1] * step + word[k - 1 :] if n >= k else rolled[: max(0, n - k + 1)]
        if k < shortest:
            continue
        at = np.flatnonzero(left >= k) if at is None else at[left[at] >= k]
        both, later = flat.repeats(flat.mixed(rolled[at]) ^ salt[at], at)
        found[k] = later
        if k == WINDOW:
            inside = flat.covered(both, k, n)
            out["n_repeat_words"] = flat.per_text(inside, word_at)
        at = both
    by_n = []
    for k in NGRAM_LIMITS:
        inside = flat.covered(found[k], k, n)
        by_n.append(np.bincount(text_of[inside], size[inside], minlength=n_texts).astype(np.int64))
    out["repeat_chars"] = np.stack(by_n, axis=1)
    return out


def verdict(m: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(base_failed, kept)."""
    failed = (m["n_words"] < LEAST_WORDS) | (100 * m["n_repeat_words"] > WINDOW_SHARE * m["n_words"])
    most = np.array(list(NGRAM_LIMITS.values())) * m["word_chars"][:, None]
    poor = (m["repeat_chars"] > most).any(axis=1) | (m["line_chars"] > LINE_LIMIT * m["word_chars"])
    poor |= m["n_symbols"] > SYMBOL_LIMIT * m["n_words"]
    return failed, ~failed & ~poor


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, data, bounds in flat.chunks(batch.column(1)):
            m = measure(data, bounds)
            failed, kept = verdict(m)
            wide = m["repeat_chars"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a)]
                + [pa.array(m[c].astype(np.int64)) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "line_chars")]
                + [pa.ListArray.from_arrays(np.arange(len(wide) + 1, dtype=np.int32) * wide.shape[1], pa.array(wide.ravel()))]
                + [pa.array(failed), pa.array(kept)],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "line_chars", "repeat_chars", "base_failed", "kept"],
            )


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and verdict of every text; no shuffle."""
    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(_judge, SCHEMA)
