"""SentencePiece encoding and decoding over a relational lattice.

Method. A text is cut into words where no piece can span (at white space, and
at characters that are part of no longer piece). The substrings of
bounded length of many distinct words at once are joined to the piece table,
by array keys; the edges found are the words' lattices, and a fold goes over
all of them together, by the kind of the model:

* unigram: Viterbi, position by position: the best score of a path that ends
  there, and where its last edge starts; then it walks back;
* BPE: its library does not take the path of the best score sum, so the fold
  merges: from single characters, each step takes the edge of the best score
  (leftmost of equals) that spans exactly two neighbouring symbols.

The state is a bit mask of symbol boundaries for each word. Characters without
a piece fall back to byte pieces. Words of more than ``LONG`` characters do
not fit the mask; they are cut between two characters that stand side by side
in no piece, and what is still long is folded by itself, in n log n steps.
Decoding takes pieces by id and strings their bytes together.

Scale. Both ways are maps over the rows: nothing is shuffled or written aside,
for the words of natural text are so many that a dictionary of their ids,
joined back to the texts, is larger than the texts (measured: 3.8 x the input
on disk). A worker keeps the ids of the words it met first, by count bounded;
the others pass the lattice where they stand, some thousands together. A task
holds ``CHUNK`` bytes of texts, or one longer text.

Defined results: a null or empty text has no pieces; repeated rows stay apart
(row ids); an empty table gives an empty result. Spaces and the piece mark are
one and the same, as in the library.
"""

from __future__ import annotations

import gc
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qtrail.llm.common import by_bytes, slices, tokenizer_file

MARK = "▁"
LONG = 60
CHUNK = 4 << 20  # bytes of texts whose words are looked up together
LATTICE_WORDS = 8_192  # folded together
MEMO_WORDS = 400_000  # kept words of a worker, some 80 MB
UNIGRAM, BPE = 1, 2
UNKNOWN_COST = 10.0  # under the worst score, for a character without a piece


def piece_table(path: str) -> list[tuple[int, str, float, bool]]:
    """``id, piece, score, is_byte`` of the pieces that text can yield."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(i, sp.id_to_piece(i), sp.get_score(i), sp.is_byte(i)) for i in range(len(sp))
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]


def model_kind(model: bytes) -> int:
    """``model_type`` (field 3) of the trainer's settings (field 2) of a model
    file; a file that names none is a unigram model."""
    def fields(buf: bytes) -> Iterator[tuple[int, int | bytes]]:
        at = 0

        def number() -> int:
            nonlocal at
            out = shift = 0
            while True:
                byte = buf[at]
                at += 1
                out |= (byte & 127) << shift
                if byte < 128:
                    return out
                shift += 7

        while at < len(buf):
            tag = number()
            if tag & 7 == 0:
                yield tag >> 3, number()
            else:
                size = {1: 8, 5: 4}.get(tag & 7) or number()
                yield tag >> 3, buf[at:at + size]
                at += size

    trainer = b"".join(v for k, v in fields(model) if k == 2)
    return next((v for k, v in fields(trainer) if k == 3), UNIGRAM)


def word_pattern(pieces: list[tuple[int, str, float, bool]]) -> str:
    """Words: marks with the merging characters behind them, or marks alone,
    or one character that is part of no longer piece."""
    codes = sorted({ord(c) for _, p, _, byte in pieces if not byte and len(p) > 1 for c in p} - {ord(MARK)})
    ranges, start = [], None
    for a, b in zip(codes, [*codes[1:], -1]):
        start = a if start is None else start
        if b != a + 1:
            ranges.append(f"\\U{start:08X}-\\U{a:08X}")
            start = None
    merging = "".join(ranges)
    return f"(?s){MARK}*[{merging}]+|{MARK}+|[^{merging}{MARK}]" if merging else f"(?s){MARK}|[^{MARK}]"


# -- long words --------------------------------------------------------------
def merge_plainly(word: str, scores: dict[str, float]) -> list[str]:
    """The merging rule for one word: a heap of neighbouring pairs, the best
    score first, leftmost of equals. A pair whose symbols have changed since is
    passed over."""
    n = len(word)
    end = list(range(1, n + 1))  # of the symbol that starts here; 0 where none does any more
    start = list(range(-1, n))  # of the symbol that ends here
    heap: list[tuple[float, int, int, int]] = []

    def offer(a: int, b: int) -> None:
        if 0 <= a and b < n:
            score = scores.get(word[a:end[b]])
            if score is not None:
                heapq.heappush(heap, (-score, a, b, end[b]))

    for i in range(n - 1):
        offer(i, i + 1)
    while heap:
        _, a, b, stop = heapq.heappop(heap)
        if end[a] != b or end[b] != stop:
            continue
        end[a], end[b], start[stop] = stop, 0, a
        if a:
            offer(start[a], a)
        offer(a, stop)
    out, at = [], 0
    while at < n:
        out.append(word[at:end[at]])
        at = end[at]
    return out


def best_path_plainly(word: str, scores: dict[str, float], longest: int, unknown: float) -> list[str]:
    """Viterbi for one word; of equal paths the one whose last piece is longest."""
    best, back = [0.0] + [-np.inf] * len(word), [0] * (len(word) + 1)
    for e in range(1, len(word) + 1):
        for s in range(max(0, e - longest), e):
            piece = word[s:e]
            score = scores.get(piece, unknown if e - s == 1 else None)
            if score is not None and best[s] + score > best[e]:
                best[e], back[e] = best[s] + score, s
    out, at = [], len(word)
    while at:
        out.append(word[back[at]:at])
        at = back[at]
    return out[::-1]


# -- lattice -----------------------------------------------------------------
class Lattice:
    """The edges of many words at once: ``word, s, e, id, score``, one for each
    piece within a word (by word, then start, then end)."""

    def __init__(self, word: np.ndarray, s: np.ndarray, e: np.ndarray, id: np.ndarray, score: np.ndarray):
        self.word, self.s, self.e, self.id, self.score = word, s, e, id, score

    def taken(self, keep: np.ndarray) -> Lattice:
        return Lattice(self.word[keep], self.s[keep], self.e[keep], self.id[keep], self.score[keep])


class PieceTable:
    """The pieces as a table of steps: (state, character) to the next state,
    where a state is a beginning of a piece. All places of all words step
    together, so an edge is an equal key in this table."""

    def __init__(self, table: list[tuple[int, str, float, bool]]):
        plain = [(p, i, float(s)) for i, p, s, byte in table if not byte]
        self.byte_base = next((i for i, p, _, byte in table if byte and p == "<0x00>"), 0)
        self.unknown = min(s for _, _, s in plain) - UNKNOWN_COST
        begun = sorted({p[:n] for p, _, _ in plain for n in range(1, len(p) + 1)})
        state = {"": 0, **{p: n for n, p in enumerate(begun, 1)}}
        keys = np.array([state[p[:-1]] << 21 | ord(p[-1]) for p in begun], np.int64)
        order = np.argsort(keys)
        # Of each state, the piece that it is (-1: it is none).
        self.id, self.score = np.full(len(state), -1, np.int32), np.zeros(len(state))
        for p, i, score in plain:
            self.id[state[p]], self.score[state[p]] = i, score
        self.keys, self.next = keys[order], (order + 1).astype(np.int64)

        self.ids, self.scores = {p: i for p, i, _ in plain}, {p: s for p, _, s in plain}

    def long_ids(self, word: str, kind: int) -> list[int]:
        cut = (merge_plainly(word, self.scores) if kind == BPE
               else best_path_plainly(word, self.scores, max(map(len, self.scores)), self.unknown))
        return [x for p in cut for x in ([self.ids[p]] if p in self.ids else [self.byte_base + c for c in p.encode()])]

    def step(self, state: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which places go on, and their next states."""
        key = state << 21 | code
        at = np.searchsorted(self.keys, key)
        at[at == self.keys.size] = 0
        on = self.keys[at] == key
        return on, self.next[at[on]]

    def lattice(self, codes: np.ndarray, word: np.ndarray, start: np.ndarray, end: np.ndarray) -> Lattice:
        """Of words written one behind the other: ``codes``, the word of each
        place, and by word its first place and the one behind its last."""
        place, state, length, found = np.arange(codes.size), np.zeros(codes.size, np.int64), 0, []
        while place.size:
            on, state = self.step(state, codes[place + length])
            place, length = place[on], length + 1
            here = self.id[state] >= 0
            found.append((place[here], np.full(int(here.sum()), length), state[here]))
            inside = place + length < end[word[place]]
            place, state = place[inside], state[inside]
        s, n, state = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(s, kind="stable")  # ends already stand in rising order
        s, n, state = s[order], n[order], state[order]
        w = word[s]
        return Lattice(w, s - start[w], s - start[w] + n, self.id[state], self.score[state])


def merged(edges: Lattice, sizes: np.ndarray) -> np.ndarray:
    """By word the mask of its symbol boundaries after merging. In each round
    every word takes its first open edge: the best score, leftmost of equals,
    over exactly two symbols. An edge with a lost end can't open any more."""
    one = np.int64(1)
    mask = (one << (sizes + 1)) - 1
    e = edges.taken(edges.e - edges.s > 1)
    e = e.taken(np.lexsort((e.e, e.s, -e.score, e.word)))
    word, ends, inner = e.word, (one << e.s) + (one << e.e), (one << e.e) - (one << (e.s + 1))
    while word.size:
        now = mask[word]
        left = now & inner
        alive = ((now & ends) == ends) & (left != 0)
        word, ends, inner, left = word[alive], ends[alive], inner[alive], left[alive]
        open_ = np.flatnonzero((left & (left - 1)) == 0)
        first = open_[np.flatnonzero(np.diff(word[open_], prepend=-1))]
        if not first.size:
            break
        mask[word[first]] &= ~inner[first]
        # Only words that changed have something to do.
        changed = np.zeros(sizes.size, bool)
        changed[word[first]] = True
        on = changed[word]
        word, ends, inner = word[on], ends[on], inner[on]
    return mask


def best_paths(edges: Lattice, sizes: np.ndarray, unknown: float) -> np.ndarray:
    """By word the mask of the boundaries of its best path (Viterbi, all words
    position by position); of equal paths the one whose last piece is longest.
    A character without a piece is an edge of score ``unknown``."""
    words, most = np.arange(sizes.size), int(sizes.max(initial=0))
    best, back = np.full((sizes.size, most + 1), -np.inf), np.zeros((sizes.size, most + 1), np.int64)
    best[:, 0] = 0.0
    single = np.full((sizes.size, most + 1), unknown)
    alone = edges.e - edges.s == 1
    single[edges.word[alone], edges.s[alone]] = edges.score[alone]
    longer = edges.taken(~alone)
    longer = longer.taken(np.lexsort((longer.s, longer.word, longer.e)))
    bounds = np.searchsorted(longer.e, np.arange(most + 2))
    for e in range(1, most + 1):
        to = words[sizes >= e]
        best[to, e], back[to, e] = best[to, e - 1] + single[to, e - 1], e - 1
        here = longer.taken(slice(bounds[e], bounds[e + 1]))
        score = best[here.word, here.s] + here.score
        # Per word the best score, then the longest piece.
        order = np.lexsort((here.s, -score, here.word))
        first = order[np.flatnonzero(np.diff(here.word[order], prepend=-1))]
        first = first[score[first] >= best[here.word[first], e]]
        best[here.word[first], e], back[here.word[first], e] = score[first], here.s[first]
    one, at, mask = np.int64(1), sizes.copy(), np.zeros(sizes.size, np.int64)
    while (open_ := at > 0).any():
        mask[open_] |= one << at[open_]
        at[open_] = back[words[open_], at[open_]]
    return mask | one


def cut_ids(codes: np.ndarray, word: np.ndarray, start: np.ndarray, mask: np.ndarray, edges: Lattice,
            byte_base: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the edges between the boundaries of ``mask``, or bytes where
    there is none; and where each word's begin."""
    one = np.int64(1)
    inner = (one << edges.e) - (one << (edges.s + 1))
    ends = (one << edges.s) + (one << edges.e)
    used = ((mask[edges.word] & ends) == ends) & ((mask[edges.word] & inner) == 0)
    id_at = np.full(codes.size, -1, np.int64)  # by the place where a symbol starts
    id_at[start[edges.word[used]] + edges.s[used]] = edges.id[used]
    starts = ((mask[word] >> (np.arange(codes.size) - start[word])) & 1) == 1
    width = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)  # bytes in UTF-8
    count = np.where(starts, np.where(id_at >= 0, 1, width), 0)
    first = np.concatenate([[0], np.cumsum(count)])
    out = np.zeros(first[-1], np.int32)
    known = starts & (id_at >= 0)
    out[first[:-1][known]] = id_at[known]
    for at in np.flatnonzero(starts & (id_at < 0)).tolist():  # rare characters
        out[first[at]:first[at + 1]] = [byte_base + c for c in chr(codes[at]).encode()]
    return out, np.append(first[start], first[-1])


def short_ids(words: list[str], pieces: PieceTable, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words of 1 to ``LONG`` characters, and where each word's begin."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(sizes)
    start, word = end - sizes, np.repeat(np.arange(sizes.size), sizes)
    edges = pieces.lattice(codes, word, start, end)
    mask = merged(edges, sizes) if kind == BPE else best_paths(edges, sizes, pieces.unknown)
    return cut_ids(codes, word, start, mask, edges, pieces.byte_base)


# -- texts -------------------------------------------------------------------
def _words(text: str | None, pattern: re.Pattern) -> list[str]:
    return pattern.findall(MARK + text.replace(" ", MARK)) if text else []


def inner_pairs(table: list[tuple[int, str, float, bool]]) -> frozenset[str]:
    """Neighbouring characters within pieces: no piece spans any other two."""
    return frozenset(p[i:i + 2] for _, p, _, byte in table if not byte for i in range(len(p) - 1))


def cut_word(word: str, pairs: frozenset[str]) -> list[str]:
    out, at = [], 0
    for i in range(1, len(word)):
        if word[i - 1:i + 1] not in pairs:
            out.append(word[at:i])
            at = i
    out.append(word[at:])
    return out


class WordIds:
    """Ids of words, as the bytes of 32-bit numbers: the lattice is passed by
    the words that the worker does not hold yet, many at a time."""

    def __init__(self, table: list[tuple[int, str, float, bool]], kind: int):
        self.pieces, self.kind, self.pairs = PieceTable(table), kind, inner_pairs(table)
        self.find = re.compile(word_pattern(table)).findall
        self.words: dict[str, bytes] = {}

    def _learn(self, missing: list[str]) -> None:
        short = [w for w in missing if len(w) <= LONG]
        for at in range(0, len(short), LATTICE_WORDS):
            some = short[at:at + LATTICE_WORDS]
            ids, cuts = short_ids(some, self.pieces, self.kind)
            raw, ends = ids.tobytes(), (cuts * 4).tolist()
            self.words.update(zip(some, [raw[i:j] for i, j in zip(ends, ends[1:])]))
        for word in missing:
            if len(word) > LONG:
                parts = cut_word(word, self.pairs)
                if len(parts) == 1:
                    self.words[word] = np.array(self.pieces.long_ids(word, self.kind), np.int32).tobytes()
                else:
                    self._learn(list(set(parts).difference(self.words)))
                    self.words[word] = b"".join([self.words[p] for p in parts])

    def texts(self, texts: list[str | None]) -> list[bytes]:
        """The ids of every text."""
        found = [self.find(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if missing := set().union(*found).difference(self.words):
            self._learn(list(missing))
        out = [b"".join(map(self.words.__getitem__, words)) for words in found]
        while len(self.words) > MEMO_WORDS:  # the newest go: frequent words were met early
            self.words.popitem()
        return out


@lru_cache(maxsize=1)
def _word_ids(table: tuple[tuple[int, str, float, bool], ...], kind: int) -> WordIds:
    gc.disable()  # in this worker: the memo holds no cycles, and scanning it is slow
    return WordIds(table, kind)  # kept from task to task


def encode(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``row`` (an id of the row), ``key`` and ``ids`` of every text."""
    path = path or tokenizer_file("piece_bpe_32k.model")
    table = piece_table(path)
    with open(path, "rb") as f:
        kind = model_kind(f.read())
    return encode_with(docs, table, kind, key, text)


def encode_with(docs: DataFrame, table: list[tuple[int, str, float, bool]], kind: int, key: str = "doc_id",
                text: str = "text") -> DataFrame:
    """``encode`` with a piece table and the kind of its model."""
    known = tuple(table)
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField(key, rows.schema["key"].dataType),
                           T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, done = _word_ids(known, kind), TaskContext.get().partitionId() << 33
        for b in slices(batches):
            sizes = pc.fill_null(pc.binary_length(b.column(1)), 0).to_pylist()
            for lo, hi in by_bytes([n + 1 for n in sizes], CHUNK):
                raw = memo.texts(b.column(1).slice(lo, hi - lo).to_pylist())
                cuts = np.concatenate([[0], np.cumsum([len(r) >> 2 for r in raw])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.frombuffer(b"".join(raw), np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(done, done + hi - lo)), b.column(0).slice(lo, hi - lo), ids],
                                                 names=schema.names)
                done += hi - lo

    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` (with ``ids``) and ``text``."""
    table = piece_table(path or tokenizer_file("piece_bpe_32k.model"))
    raw = [b""] * (max(i for i, *_ in table) + 1)
    for i, p, _, byte in table:
        raw[i] = bytes([int(p[3:5], 16)]) if byte else p.replace(MARK, " ").encode()
    schema = T.StructType([*encoded.schema.fields, T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pa.array(raw, pa.binary())
        for b in slices(batches):
            ids = b.column("ids")
            parts = pa.ListArray.from_arrays(pc.subtract(ids.offsets, ids.offsets[0]), pieces.take(ids.flatten()))
            # The mark in front of the text is no part of it.
            texts = [t[1:] for t in pc.binary_join(parts, b"").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.binary()).cast(pa.string())], names=schema.names)

    return encoded.mapInArrow(run, schema)
