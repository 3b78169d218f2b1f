"""SentencePiece encoding and decoding with the N best segmentations.

The lattice of a text holds every piece of the model that matches, and for a
character that is no piece an unknown edge, which becomes byte pieces.  Scores of a
segmentation add up.  Viterbi scores of all prefixes come first; a search from the
text's end then uses them as its exact heuristic (A*), so segmentations are found
in the order of their scores.

No piece continues over the start of a word or over a line's end (checked when the
model is read), so a text's lattice is a chain of word lattices.  The Viterbi scores of
all distinct words of a bounded stretch of text are found together in numpy, forward
and backward; the two passes give each word's best and second-best score, hence the
words in which the text's next best segmentations can differ, and only these words
are searched.

Decoding gives back the text exactly: one blank is put before the text and taken off
again, blanks become U+2581, and a U+2581 of the text itself goes through bytes.

Defined results: a null or empty text has no pieces, one segmentation of score 0,
and decodes to the empty text; equal scores are ordered by the search, the same
way on every run; repeated rows get equal results; an empty table gives an empty result.
Time and memory are linear in the longest word.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = "▁"
OWN_SPACE = "\ud800"  # stands for a U+2581 of the text; decoded UTF-8 never holds a lone surrogate
WORDS = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")
UNKNOWN_COST = 10.0  # below the lowest score of a piece
KEPT_WORDS = 50_000  # searched words whose segmentations a Python worker keeps
BATCH_CHARS = 1 << 20  # characters whose words are handled together; a longer text is taken alone
SEGMENT_CHARS = 100_000  # characters of distinct words whose lattices are held at once; a longer word is taken alone
ENCODED = "ids array<int>, score double, others array<struct<score:double,ids:array<int>>>"



def escape(text: str) -> str:
    return text.replace(SPACE, OWN_SPACE).replace(" ", SPACE)


Choice = tuple[float, tuple[int, ...]]


@dataclass
class PieceModel:
    ids: dict[str, int]  # normal pieces
    scores: dict[str, float]
    prefixes: frozenset[str]
    byte_ids: list[int]
    unknown_score: float
    kept: dict = field(default_factory=dict, repr=False)

    @classmethod
    def read(cls, path: str) -> PieceModel:
        """From a SentencePiece model file with byte fallback."""
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        special = {i for i in range(size) if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)}
        ids = {sp.id_to_piece(i): i for i in range(size) if i not in special}
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in ids):
            raise ValueError("a piece continues over the start of a word or over a line's end")
        byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(not sp.is_byte(i) for i in byte_ids):
            raise ValueError("the model has no byte pieces")
        scores = {p: sp.get_score(i) for p, i in ids.items()}
        prefixes = frozenset(p[:k] for p in ids for k in range(1, len(p) + 1))
        return cls(ids, scores, prefixes, byte_ids, min(scores.values()) - UNKNOWN_COST)

    def __getstate__(self):
        return self.__dict__ | {"kept": {}}

    def edges(self, word: str) -> list[list[tuple[int, str]]]:
        """For each place the pieces that end there, with their starts."""
        into: list[list[tuple[int, str]]] = [[] for _ in range(len(word) + 1)]
        for i in range(len(word)):
            for j in range(i + 1, len(word) + 1):
                piece = word[i:j]
                if piece not in self.prefixes:
                    break
                if piece in self.scores:
                    into[j].append((i, piece))
            if word[i] not in self.scores:
                into[i + 1].append((i, word[i]))
        return into

    def piece_ids(self, piece: str) -> tuple[int, ...]:
        if piece in self.ids:
            return (self.ids[piece],)
        return tuple(self.byte_ids[b] for b in piece.replace(OWN_SPACE, SPACE).encode())

    def word_choices(self, word: str, n: int) -> list[Choice]:
        """The N best segmentations of one word, best first."""
        into, scores, unknown = self.edges(word), self.scores, self.unknown_score
        best = [0.0] * (len(word) + 1)
        for j in range(1, len(word) + 1):
            best[j] = max(best[i] + scores.get(piece, unknown) for i, piece in into[j])
        # backward from the end; what is still open costs exactly best[place]
        out: list[Choice] = []
        order = count()
        heap = [(-best[-1], next(order), len(word), 0.0, None)]
        while heap and len(out) < n:
            cost, _, place, done, path = heapq.heappop(heap)
            if place == 0:
                ids: list[int] = []
                while path is not None:
                    ids += self.piece_ids(path[0])
                    path = path[1]
                out.append((-cost, tuple(ids)))
                continue
            for i, piece in into[place]:
                step = done + scores.get(piece, unknown)
                heapq.heappush(heap, (-(best[i] + step), next(order), i, step, (piece, path)))
        return out

    def choices(self, word: str, n: int) -> list[Choice]:
        found = self.kept.get((word, n))
        if found is None:
            found = self.word_choices(word, n)
            if len(word) <= 64:
                if len(self.kept) >= KEPT_WORDS:
                    self.kept.clear()
                self.kept[word, n] = found
        return found

    def lookup(self) -> PieceTable:
        table = self.kept.get("table")
        if table is None:
            table = self.kept["table"] = PieceTable(self)
        return table

    def encode(self, texts: list[str], n: int) -> list[list[tuple[float, np.ndarray]]]:
        """The N best segmentations of each whole text, best first."""
        split = [WORDS.findall(SPACE + escape(text)) if text else [] for text in texts]
        words = list(dict.fromkeys(chain.from_iterable(split)))
        number = {w: i for i, w in enumerate(words)}.__getitem__
        lines = [np.fromiter(map(number, line), np.int64, len(line)) for line in split]
        del split
        best, second, flat, begin = self.lookup().segment(words)
        return [self._encode_line(line, words, best, second, flat, begin, n) for line in lines]

    def _encode_line(self, line, words, best, second, flat, begin, n) -> list[tuple[float, np.ndarray]]:
        if not len(line):
            return [(0.0, np.zeros(0, np.int32))]
        score = float(best[line].sum())
        sizes = begin[line + 1] - begin[line]
        starts = np.cumsum(sizes) - sizes
        ids = flat[np.arange(sizes.sum()) + np.repeat(begin[line] - starts, sizes)]
        out = [(score, ids)]
        # only the words whose second choice costs least can differ in the next n - 1
        loss = best[line] - second[line]
        cheap = np.argsort(loss, kind="stable")[: n - 1] if n > 2 else np.argmin(loss, keepdims=True)[: n - 1]
        cheap = np.sort(cheap[np.isfinite(loss[cheap])]).tolist()
        lists = [self.choices(words[line[w]], n) for w in cheap]
        # best first over the choices taken in these words
        start = (0,) * len(cheap)
        heap, seen = [(0.0, start)], {start}
        while heap and len(out) < n:
            cost, taken = heapq.heappop(heap)
            if any(taken):
                parts, done = [], 0
                for w, choices, t in zip(cheap, lists, taken):
                    parts += [ids[done : starts[w]], np.array(choices[t][1], np.int32)]
                    done = starts[w] + sizes[w]
                out.append((score - cost, np.concatenate([*parts, ids[done:]])))
            for k, choices in enumerate(lists):
                t = taken[k] + 1
                if t < len(choices) and (nxt := taken[:k] + (t,) + taken[k + 1 :]) not in seen:
                    seen.add(nxt)
                    heapq.heappush(heap, (cost + choices[t - 1][0] - choices[t][0], nxt))
        return out

    def decoder(self) -> Decoder:
        return Decoder({i: p for p, i in self.ids.items()}, {i: b for b, i in enumerate(self.byte_ids)})


class PieceTable:
    """The pieces as a trie in arrays, and Viterbi passes over many words at once."""

    def __init__(self, model: PieceModel):
        self.model = model
        pieces = sorted(model.ids)
        letters = sorted({c for p in pieces for c in p})
        self.letter = np.zeros(0x110000, np.int64)  # code point -> letter from 1; 0: in no piece
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.width = len(letters) + 1
        nodes = {p: i for i, p in enumerate(sorted(model.prefixes), 1)}  # 0 is the root
        keys = np.array([(nodes[p[:-1]] if len(p) > 1 else 0) * self.width + self.letter[ord(p[-1])] for p in nodes], np.int64)
        self.piece = np.full(len(nodes) + 1, -1, np.int64)  # node -> id
        for p, i in model.ids.items():
            self.piece[nodes[p]] = i
        self.score = np.zeros(max(model.ids.values()) + 1)
        for p, i in model.ids.items():
            self.score[i] = model.scores[p]
        # steps of the trie, hashed with linear probing
        self.bits = int(len(keys) * 4).bit_length()
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.next = np.zeros(1 << self.bits, np.int64)
        slots, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[slots[left]] < 0]
            free = free[np.unique(slots[free], return_index=True)[1]]
            self.keys[slots[free]], self.next[slots[free]] = keys[free], free + 1
            left = np.setdiff1d(left, free)
            slots[left] = (slots[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _step(self, node: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The next node of each, or -1."""
        keys = node * self.width + letter
        slots, out = self._slot(keys), np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        while len(left):
            held = self.keys[slots[left]]
            hit = held == keys[left]
            out[left[hit]] = self.next[slots[left[hit]]]
            left = left[~hit & (held >= 0)]
            slots[left] = (slots[left] + 1) & ((1 << self.bits) - 1)
        return out

    def segment(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each word the best and the second-best score (-inf: none), and the ids of
        its best segmentation as one flat array with each word's begin."""
        upto = np.cumsum([0, *map(len, words)])
        cuts = np.unique(np.searchsorted(upto, np.arange(0, upto[-1] + SEGMENT_CHARS, SEGMENT_CHARS)))
        parts = [self._segment(words[a:b]) for a, b in zip(cuts, [*cuts[1:], len(words)]) if a < b]
        parts = parts or [self._segment([])]
        done = np.cumsum([0, *(len(p[2]) for p in parts)])
        begin = [p[3][:-1] + d for p, d in zip(parts, done)]
        best, second, flat = (np.concatenate([p[i] for p in parts]) for i in range(3))
        return best, second, flat, np.concatenate([*begin, done[-1:]])

    def _segment(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        n, chars = len(words), int(lengths.sum())
        if not n:
            return np.zeros(0), np.zeros(0), np.zeros(0, np.int32), np.zeros(1, np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = self.letter[points]
        word = np.repeat(np.arange(n), lengths)
        offset = np.cumsum(lengths) - lengths
        left = np.repeat(offset + lengths, lengths) - np.arange(chars)  # characters up to the word's end
        # lattice: edges from every character as far as the trie goes; a word of k letters has k + 1 places
        at, node, d = np.flatnonzero(letter > 0), None, 0
        node = np.zeros(len(at), np.int64)
        starts, ends, ids = [], [], []
        while len(at):
            node = self._step(node, letter[at + d])
            d += 1
            some = node >= 0
            at, node = at[some], node[some]
            is_piece = self.piece[node] >= 0
            starts.append(at[is_piece])
            ends.append(at[is_piece] + d)
            ids.append(self.piece[node[is_piece]])
            on = left[at] > d
            at, node = at[on], node[on]
        single = np.zeros(chars, bool)
        if starts:
            single[starts[0]] = True
        unknown = np.flatnonzero(~single)
        piece = np.concatenate([*ids, np.full(len(unknown), -1)])
        start = np.concatenate([*starts, unknown])
        end = np.concatenate([*ends, unknown + 1])
        gain = np.where(piece >= 0, self.score[piece], self.model.unknown_score)
        of = word[start]
        a, b = start + of, end + of  # places
        forward, backward = np.full(chars + n, -np.inf), np.full(chars + n, -np.inf)
        first, last = offset + np.arange(n), offset + lengths + np.arange(n)
        forward[first] = 0.0
        backward[last] = 0.0
        for mine, edges in by_value(end - offset[of]):
            e = edges[mine]
            np.maximum.at(forward, b[e], forward[a[e]] + gain[e])
        for mine, edges in reversed(by_value(start - offset[of])):
            e = edges[mine]
            np.maximum.at(backward, a[e], backward[b[e]] + gain[e])
        # the best path, from the end; of equal choices the longest last piece
        tight = np.flatnonzero(forward[a] + gain == forward[b])
        into = np.full(chars + n, -1, np.int64)
        reach = np.full(chars + n, chars + 1, np.int64)
        np.minimum.at(reach, b[tight], start[tight])
        tight = tight[start[tight] == reach[b[tight]]]
        into[b[tight]] = tight
        place, w, steps = last.copy(), np.arange(n), []
        while len(w):
            e = into[place]
            steps.append((w, e))
            place = a[e]
            on = place != first[w]
            place, w = place[on], w[on]
        on_best = np.zeros(len(start), bool)
        for _, e in steps:
            on_best[e] = True
        through = forward[a] + gain + backward[b]
        second = np.full(n, -np.inf)
        np.maximum.at(second, of[~on_best], through[~on_best])
        # ids in reading order; an unknown character gives its bytes
        path_word = np.concatenate([w for w, _ in steps])
        path_edge = np.concatenate([e for _, e in steps])
        order = np.lexsort((start[path_edge], path_word))
        path_word, path_edge = path_word[order], path_edge[order]
        value = piece[path_edge]
        spelled = {int(c): self.model.piece_ids(chr(c)) for c in np.unique(points[start[path_edge[value < 0]]])}
        sizes = np.ones(len(value), np.int64)
        lost = np.flatnonzero(value < 0)
        codes = points[start[path_edge[lost]]].tolist()
        sizes[lost] = [len(spelled[c]) for c in codes]
        flat = np.repeat(value, sizes)
        if len(lost):
            flat[flat < 0] = np.fromiter(chain.from_iterable(spelled[c] for c in codes), np.int64)
        begin = np.concatenate(([0], np.cumsum(np.bincount(path_word, sizes, n)))).astype(np.int64)
        return forward[last], second, flat.astype(np.int32), begin


def by_value(values: np.ndarray) -> list[tuple[slice, np.ndarray]]:
    """The places of each distinct value, in the values' order."""
    small = len(values) and values.max() < 1 << 16  # 16-bit keys sort by radix
    order = np.argsort(values.astype(np.uint16) if small else values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order])) + 1
    edges = [0, *cuts.tolist(), len(values)]
    return [(slice(x, y), order) for x, y in zip(edges, edges[1:])]


@dataclass
class Decoder:
    pieces: dict[int, str]
    bytes_: dict[int, int]

    def __post_init__(self):
        self.parts = {i: p.replace(SPACE, " ").encode() for i, p in self.pieces.items()}
        self.parts |= {i: bytes([b]) for i, b in self.bytes_.items()}

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.parts.__getitem__, ids)).decode("utf-8", "replace")[1:]


def encode(docs: DataFrame, model: PieceModel, into: str, nbest: int = 2) -> DataFrame:
    """``docs`` with a struct column ``into``: ``ids`` and ``score`` of the best segmentation
    and ``others``, score and ids of the next ``nbest - 1``.  A column of that name is
    replaced.  The model's size is that of its file."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def lists(values: list[np.ndarray]) -> pa.ListArray:
        ends = np.cumsum([0, *map(len, values)])
        flat = np.concatenate([np.zeros(0, np.int32), *values])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))

    def coded(texts: list[str]) -> pa.StructArray:
        found = shared.value.encode(texts, nbest)
        others = [c for choices in found for c in choices[1:]]
        scored = pa.StructArray.from_arrays(
            [pa.array([c[0] for c in others], pa.float64()), lists([c[1] for c in others])], ["score", "ids"]
        )
        ends = np.cumsum([0, *(len(c) - 1 for c in found)])
        best, scores = lists([c[0][1] for c in found]), pa.array([c[0][0] for c in found], pa.float64())
        return pa.StructArray.from_arrays(
            [best, scores, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), scored)], ["ids", "score", "others"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, part, size = 0, [], 0
            for i, t in enumerate(batch.column("text").cast(pa.binary()), 1):
                part.append((t.as_py() or b"").decode("utf-8", "replace"))
                size += len(part[-1])
                if size >= BATCH_CHARS or i == len(batch):
                    rows = batch.slice(at, i - at)
                    yield pa.RecordBatch.from_arrays([*rows.columns, coded(part)], [*rows.schema.names, into])
                    at, part, size = i, [], 0

    kept = docs.drop(into)
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(into, T.StructType.fromDDL(ENCODED))]))


def decode_column(df: DataFrame, model: PieceModel, ids: Column) -> Column:
    """The text that the ids stand for."""
    shared = df.sparkSession.sparkContext.broadcast(model.decoder())

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        text = shared.value.decode
        for batch in batches:
            at, flat = batch.offsets.to_pylist(), batch.values.to_numpy()
            yield pa.array([text(flat[a:b].tolist()) for a, b in zip(at, at[1:])], pa.string())

    return decode(ids)
