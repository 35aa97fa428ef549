"""Encoding and decoding with a SentencePiece model, by a forward table shared between words.

A text is cut into marked words (blanks become the mark and begin a word) and into characters that no
longer piece contains; no piece crosses these cuts. The distinct words of a chunk of texts are
sorted, which is a depth-first walk of their trie, and each word goes on with the forward table of the
prefix it shares with the word before it.

In a unigram model the forward table holds, for each prefix, the best sum of piece scores and its last
piece (Viterbi). In a BPE model scores are merge ranks, and the best sum would not be the encoding. There the
table holds the last piece of the prefix's encoding: of the pieces that end the prefix, the one that
stays apart from the last piece of the prefix before it when the two are merged by rank; exactly one does.
Words that begin with several marks, whose pieces tie in rank, are merged outright.

The model file is read on the driver (its size is that of a vocabulary) and sent with the tasks.

Defined cases: null and empty texts have no pieces, as in the library; characters outside the
vocabulary become byte pieces; the mark itself (U+2581) in a text is read as a blank and comes back as
one; repeated rows are encoded one by one; an empty table gives an empty table. Columns named like a
result column are replaced. Texts are encoded whole, whatever their length.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallymark.llm.passing import add_columns

# Fixed values of the model format: the mark, piece types, model types, the penalty of an unknown character.
MARK = "▁"
NORMAL, BYTE, UNIGRAM, BPE, UNKNOWN_PENALTY = 1, 6, 1, 2, 10.0
#: Words (and half the pairs of pieces) a worker remembers between chunks. Beyond half of it, words are set aside until the
#: next time, when those that have not come again are forgotten; pairs are begun anew.
REMEMBERED = 120_000
CHUNK_BYTES = 1 << 20

#: In place of a piece: a word's begin, or a character outside the vocabulary.
NONE = -1

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@dataclass
class Vocabulary:
    """Pieces (blanks in place of marks), their scores and types, as stored in the model file."""

    pieces: list[str]
    scores: list[float]
    types: list[int]
    kind: int

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as f:
            return cls.parse(sentencepiece_model_pb2.ModelProto.FromString(f.read()))

    @classmethod
    def parse(cls, proto) -> Vocabulary:
        norm, kind = proto.normalizer_spec, proto.trainer_spec.model_type
        if kind not in (UNIGRAM, BPE) or not proto.trainer_spec.byte_fallback:
            raise ValueError("only unigram and BPE models with byte pieces")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix:
            raise ValueError("only models that leave text as it is, but for the mark before it")
        every = proto.pieces
        return cls([p.piece.replace(MARK, " ") for p in every], [p.score for p in every], [p.type for p in every], kind)


class Encoder:
    """Encodes words; keeps what it has learned about words and pairs of pieces."""

    def __init__(self, v: Vocabulary):
        self.kind = v.kind
        self.id_of = {p: i for i, (p, t) in enumerate(zip(v.pieces, v.types)) if t == NORMAL}
        self.score = v.scores
        self.piece = v.pieces
        self.byte_id = {int(p[3:5], 16): i for i, (p, t) in enumerate(zip(v.pieces, v.types)) if t == BYTE}
        self.length = [*map(len, v.pieces), 1]
        self._build()
        joined = {c for p in self.id_of if len(p) > 1 for c in p} - {" "}
        if any(" " in p.lstrip(" ") for p in self.id_of):
            raise ValueError("pieces must not go on after a mark")
        inner = "[" + "".join(map(re.escape, sorted(joined))) + "]"
        self.words = re.compile(f" *{inner}+| +|[^ ]", re.DOTALL)
        self.unknown = min(self.score[i] for i in self.id_of.values()) - UNKNOWN_PENALTY
        self.rank_of = {p: -self.score[i] for p, i in self.id_of.items()}
        self.courses: dict[int, tuple[list[float], list[str], list[str]] | None] = {}
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        text = [bytes([int(p[3:5], 16)]) if t == BYTE else p.encode() if t == NORMAL else b"" for p, t in zip(v.pieces, v.types)]
        self.out_bytes = np.frombuffer(b"".join(text), np.uint8)
        self.out_at = np.concatenate([[0], np.cumsum([len(t) for t in text])])

    def _build(self) -> None:
        """The trie of pieces as an automaton: state 0 is its root, the state of a text the longest of its ends that begins a piece.

        Per state: the next one by character, the state of the next shorter such end, and the pieces that end
        the text, longest first, each with its length and what is known of it after other pieces.
        """
        self.step: list[dict[str, int]] = [{}]
        own = [NONE]
        for p, i in self.id_of.items():
            state = 0
            for c in p:
                to = self.step[state].get(c)
                if to is None:
                    to = self.step[state][c] = len(self.step)
                    self.step.append({})
                    own.append(NONE)
                state = to
            own[state] = i
        self.apart: list[dict[int, bool]] = [{} for _ in self.piece]
        self.judged = 0
        self.shorter = [0] * len(self.step)
        self.ends: list[tuple] = [()] * len(self.step)
        level = [0]
        while level:
            below = []
            for state in level:
                for c, to in self.step[state].items():
                    back = self.shorter[state]
                    while back and c not in self.step[back]:
                        back = self.shorter[back]
                    back = self.step[back].get(c, 0) if state else 0
                    self.shorter[to], i = back, own[to]
                    self.ends[to] = self.ends[back] if i == NONE else ((self.length[i], i, self.apart[i]), *self.ends[back])
                    below.append(to)
            level = below

    def merged(self, symbols: list[str]) -> list[str]:
        """Merge neighbours by the rank of what they make, the leftmost first among equals."""
        parts: list[str | None] = list(symbols)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple] = []

        def offer(a: int) -> None:
            b = after[a]
            if a >= 0 and b < len(parts):
                i = self.id_of.get(parts[a] + parts[b])
                if i is not None:
                    heapq.heappush(heap, (-self.score[i], a, b, parts[a], parts[b]))

        for a in range(len(parts) - 1):
            offer(a)
        while heap:
            _, a, b, x, y = heapq.heappop(heap)
            if parts[a] != x or parts[b] != y or after[a] != b:
                continue
            parts[a], parts[b] = x + y, None
            after[a] = after[b]
            if after[b] < len(parts):
                before[after[b]] = a
            offer(a)
            if before[a] >= 0:
                offer(before[a])
        return [p for p in parts if p is not None]

    def _course(self, i: int) -> tuple[list[float], list[str], list[str]] | None:
        """How the text of piece i is merged by rank: the ranks in turn (infinite at the end), and the first and the
        last part before each; None if it does not end as one piece.
        """
        if i in self.courses:
            return self.courses[i]
        parts, rank, never = list(self.piece[i]), self.rank_of, float("inf")
        ranks, firsts, lasts = [], [parts[0]], [parts[-1]]
        # so few symbols need no heap
        offers = [rank.get(u + v, never) for u, v in zip(parts, parts[1:])]
        while offers and (best := min(offers)) < never:
            at = offers.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del offers[at]
            if at:
                offers[at - 1] = rank.get(parts[at - 1] + parts[at], never)
            if at < len(offers):
                offers[at] = rank.get(parts[at] + parts[at + 1], never)
            ranks.append(best)
            firsts.append(parts[0])
            lasts.append(parts[-1])
        out = self.courses[i] = ([*ranks, never], firsts, lasts) if len(parts) == 1 else None
        return out

    def _apart(self, a: int, b: int) -> bool:
        """Whether piece b stays a piece after piece a (or at a begin, or after an unknown character, for NONE),
        when the text of both is merged by rank: no merge across comes before the next one inside of either.
        """
        x, y = None if a == NONE else self._course(a), self._course(b)
        ok = y is not None and (x is not None or a == NONE)
        if ok and x:
            (mine, _, lasts), (its, firsts, _), rank, never, i, j = x, y, self.rank_of, float("inf"), 0, 0
            while True:
                across = rank.get(lasts[i] + firsts[j], never)
                least = min(mine[i], across, its[j])
                if least == never:
                    break
                # the leftmost first among equals
                if mine[i] == least:
                    i += 1
                elif across == least:
                    ok = False
                    break
                else:
                    j += 1
        self.apart[b][a] = ok
        self.judged += 1
        return ok

    def _forward(self, words: list[str]) -> Iterator[list[int]]:
        """The piece ids of each of the sorted words (NONE: an unknown character).

        For every depth of the path in the trie of words: the last piece, the best sum, and
        the state of the automaton of pieces.
        """
        last, best, states, previous = [NONE], [0.0], [0], ""
        check, score, bpe, size, unknown = self._apart, self.score, self.kind == BPE, self.length, self.unknown
        step, shorter, ends = self.step, self.shorter, self.ends
        for word in words:
            shared = 0
            for x, y in zip(word, previous):
                if x != y:
                    break
                shared += 1
            del last[shared + 1 :], best[shared + 1 :], states[shared + 1 :]
            state, at = states[shared], shared
            for c in word[shared:]:
                at += 1
                to = step[state].get(c)
                while to is None and state:
                    state = shorter[state]
                    to = step[state].get(c)
                state = to or 0
                states.append(state)
                found = NONE
                if bpe:
                    for n, i, apart in ends[state]:
                        before = last[at - n]
                        ok = apart.get(before)
                        if ok or (ok is None and check(before, i)):
                            found = i
                            break
                else:
                    top = best[at - 1] + unknown
                    for n, i, _ in ends[state]:
                        if best[at - n] + score[i] > top:
                            found, top = i, best[at - n] + score[i]
                    best.append(top)
                last.append(found)
            pieces, end = [], len(word)
            while end:
                pieces.append(last[end])
                end -= size[last[end]]
            yield pieces[::-1]
            previous = word

    def _ids(self, word: str, pieces: list[int]) -> tuple[int, ...]:
        if NONE not in pieces:
            return tuple(pieces)
        out, at = [], 0
        for i in pieces:
            out += [i] if i != NONE else [self.byte_id[b] for b in word[at].encode()]
            at += self.length[i]
        return tuple(out)

    def learn(self, words: set[str]) -> None:
        """Encode the words that are not known yet."""
        if len(self.known) > REMEMBERED // 2:
            self.known, self.older = {}, self.known
        if self.judged > 2 * REMEMBERED:
            self.judged = 0
            for pairs in self.apart:
                pairs.clear()
        known = self.known
        words = words - known.keys()
        again = words & self.older.keys()
        known.update((w, self.older[w]) for w in again)
        new = sorted(words - again)
        if self.kind == BPE:
            for word in [w for w in new if w.startswith("  ")]:
                known[word] = self._ids(word, [self.id_of.get(p, NONE) for p in self.merged(list(word))])
            new = [w for w in new if not w.startswith("  ")]
        for word, pieces in zip(new, self._forward(new)):
            known[word] = self._ids(word, pieces)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each begins."""
        cut = [self.words.findall(" " + t.replace(MARK, " ")) if t else [] for t in texts]
        every = set().union(*cut)
        self.learn(every)
        number = dict(zip(every, range(len(every))))
        at = np.fromiter(map(number.__getitem__, chain.from_iterable(cut)), np.int64, sum(map(len, cut)))
        ids = [self.known[w] for w in number]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum()))
        starts = np.cumsum(sizes) - sizes
        per_word = sizes[at]
        ends = np.concatenate([[0], np.cumsum(per_word)])
        place = np.arange(ends[-1]) + np.repeat(starts[at] - ends[:-1], per_word)
        bounds = np.concatenate([[0], np.cumsum([len(words) for words in cut])]).astype(np.int64)
        return flat[place] if len(flat) else flat, ends[bounds]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts in one array, and where each begins: pieces joined, without the mark before the text."""
        sizes = np.diff(self.out_at)[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        data = self.out_bytes[np.arange(ends[-1]) + np.repeat(self.out_at[ids] - ends[:-1], sizes)]
        at = ends[bounds]
        keep = np.ones(len(data), bool)
        keep[at[:-1][at[:-1] < at[1:]]] = False
        return data[keep], np.concatenate([[0], np.cumsum(np.diff(at) - (np.diff(at) > 0))])


_encoders: dict[int, Encoder] = {}


def _encoder(v: Vocabulary) -> Encoder:
    """One per worker process and vocabulary."""
    key = hash((v.kind, tuple(v.pieces), tuple(v.scores)))
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(v)
    return _encoders[key]


def _texts(data: np.ndarray, bounds: np.ndarray) -> list[str]:
    whole = data.tobytes()
    return [whole[a:b].decode() for a, b in zip(bounds[:-1], bounds[1:])]


def encode(docs: DataFrame, text: str = "text", model: str = MODEL) -> DataFrame:
    """The rows with ``ids`` (piece ids), ``n_tokens`` and ``round_trip`` (the ids decode to the text's
    bytes again); no shuffle.
    """
    v = Vocabulary.read(model)

    def work(data: np.ndarray, bounds: np.ndarray) -> list[pa.Array]:
        encoder = _encoder(v)
        ids, at = encoder.encode(_texts(data, bounds))
        back, back_at = encoder.decode(ids, at)
        same = np.diff(back_at) == np.diff(bounds)
        if not same.all() or not np.array_equal(back, data):
            same &= [np.array_equal(back[a:b], data[c:d]) for a, b, c, d in zip(back_at[:-1], back_at[1:], bounds[:-1], bounds[1:])]
        return [pa.ListArray.from_arrays(at.astype(np.int32), pa.array(ids)), pa.array(np.diff(at)), pa.array(same)]

    return add_columns(docs, text, "ids array<int>, n_tokens long, round_trip boolean", work, CHUNK_BYTES)


def decode(rows: DataFrame, ids: str = "ids", model: str = MODEL) -> DataFrame:
    """The rows with ``decoded``, the text of their ids; a null list is an empty one."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    v = Vocabulary.read(model)
    kept = [c for c in rows.columns if c != "decoded"]
    source = rows.select(*[F.col(f"`{c}`") for c in kept], F.coalesce(F.col(ids).cast("array<int>"), F.array().cast("array<int>")).alias("_ids"))

    def run(batches):
        for batch in batches:
            lists = batch.column(len(kept))
            at = np.asarray(lists.offsets).astype(np.int64)
            data, bounds = _encoder(v).decode(np.asarray(lists.values)[at[0] : at[-1]], at - at[0])
            texts = pa.Array.from_buffers(pa.large_string(), len(lists), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], texts.cast(pa.string())], names=[*kept, "decoded"])

    schema = T.StructType([*rows.select(*[f"`{c}`" for c in kept]).schema.fields, T.StructField("decoded", T.StringType())])
    return source.mapInArrow(run, schema)
