"""Benchmark decontamination by an FM-index per training shard.

Each task turns its texts, shard by shard (``shard_bytes`` of text, at least one
text), into one sequence of word symbols, sorts its suffixes, and keeps the
Burrows-Wheeler transform in a wavelet matrix.  The benchmark's windows are
searched backward, all at once, through wavelet ranks; occurrences are located by
walking to sampled suffix positions; their spans are merged per text.

Words that no benchmark item holds end a run, as a text's end does; only runs
that are long enough for the shortest window enter the index.

The benchmark is read in blocks of at most ``block_bytes`` of text (a longer item is a
block of its own); one block at a time is broadcast.

Defined results: null and wordless texts have no words and no hits; an item
without words has no windows; a null item_id counts as the id ``''``; repeated
items with one id count once; empty tables give no rows or no hits; only
``doc_id``, ``text`` and ``item_id`` are read, other columns may have any name but one
that begins with ``__dc_``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import freeze
from .suffixes import suffix_array

SAMPLE = 16  # every 16th position of the sequence is sampled
SPANS = "array<struct<first:int,last:int>>"
HITS = f"struct<n_words:long,spans:{SPANS},items:array<string>>"

# A-Z to a-z; bytes outside 0-9, a-z and 0x80-0xFF to a blank
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(WORD_BYTES).split()


@dataclass
class Windows:
    vocabulary: dict[bytes, int]  # word -> symbol from 1; 0 is any other word
    symbols: np.ndarray  # windows x size, padded with 0 at the front
    lengths: np.ndarray
    items: list[list[str]]  # item ids of each window

    @classmethod
    def of(cls, items: list[tuple[str | None, bytes | None]], size: int) -> Windows:
        vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item_id, text in items:
            line = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]
            if line:
                for i in range(max(1, len(line) - size + 1)):
                    found.setdefault(tuple(line[i : i + size]), set()).add(item_id or "")
        symbols = np.zeros((len(found), size), np.int64)
        for row, w in zip(symbols, found):
            row[size - len(w) :] = w
        return cls(vocabulary, symbols, np.array([len(w) for w in found], np.int64), [sorted(x) for x in found.values()])


class WaveletMatrix:
    """Ranks of symbols in a sequence, one bit plane per level."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels: list[tuple[int, np.ndarray, int]] = []  # bit, zeros before each place, all zeros
        for bit in reversed(range(max(1, int(symbols - 1).bit_length()))):
            one = (sequence >> bit) & 1
            zeros = np.zeros(len(sequence) + 1, np.int32)
            np.cumsum(1 - one, out=zeros[1:])
            self.levels.append((bit, zeros, int(zeros[-1])))
            sequence = np.concatenate((sequence[one == 0], sequence[one == 1]))
        self.start = self._down(np.arange(symbols), np.zeros(symbols, np.int64))

    def _down(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for bit, zeros, total in self.levels:
            z = zeros[place]
            place = np.where((symbol >> bit) & 1 == 1, total + place - z, z)
        return place

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        return self._down(symbol, place) - self.start[symbol]


class FMIndex:
    def __init__(self, sequence: np.ndarray, symbols: int):
        """``sequence`` begins with 0 and holds symbols below ``symbols``; every 0
        is an end that matches nothing, itself included."""
        ends = sequence == 0
        order = np.where(ends, np.cumsum(ends) - 1, sequence + int(ends.sum()))
        sa, _ = suffix_array(order)
        self.last = sequence[sa - 1]  # the first suffix wraps round to the last symbol
        self.matrix = WaveletMatrix(self.last, symbols)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(sequence, minlength=symbols))))
        self.sampled = (sa % SAMPLE == 0) | (self.last == 0)  # a step back over an end would lose its place
        self.at = np.where(self.sampled, sa, 0)

    def _back(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        return self.first[symbol] + self.matrix.rank(symbol, place)

    def search(self, windows: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search: the windows that occur, and their ranges of suffixes."""
        n, size = len(self.last), windows.symbols.shape[1]
        which = np.arange(len(windows.lengths))
        low, high = np.zeros(len(which), np.int64), np.full(len(which), n, np.int64)
        for step in range(size):
            going = windows.lengths[which] > step
            symbol = windows.symbols[which, size - 1 - step]
            low = np.where(going, self._back(symbol, low), low)
            high = np.where(going, self._back(symbol, high), high)
            some = low < high
            which, low, high = which[some], low[some], high[some]
        return which, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions in the sequence of the given suffixes."""
        place, steps = rows.copy(), np.zeros(len(rows), np.int64)
        while len(walk := np.flatnonzero(~self.sampled[place])):
            place[walk] = self._back(self.last[place[walk]], place[walk])
            steps[walk] += 1
        return self.at[place] + steps


def expand(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges [low, high), and the range of each."""
    sizes = high - low
    owner = np.repeat(np.arange(len(low)), sizes)
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[owner], owner


def search_shard(texts: list[bytes | None], windows: Windows) -> list[dict]:
    """The merged hits of each text of one shard."""
    lookup = windows.vocabulary.get
    lines = [words_of(t) for t in texts]
    n_words = np.array([len(x) for x in lines], np.int64)
    out: list[dict] = [{"n_words": int(n), "spans": [], "items": []} for n in n_words]
    if not len(windows.lengths):
        return out
    # one end before each text and one after the last
    sequence = np.zeros(int(n_words.sum()) + len(lines) + 1, np.int64)
    begins = np.cumsum(n_words + 1) - n_words
    for at, line in zip(begins.tolist(), lines):
        sequence[at : at + len(line)] = np.fromiter(map(lookup, line, repeat(0)), np.int64, len(line))
    del lines
    # runs of known words, without those too short for any window; one end is left between two
    edges = np.diff(np.concatenate(([0], (sequence != 0).view(np.int8), [0])))
    run, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    long = end - run >= windows.lengths.min()
    places, _ = expand(run[long] - 1, end[long])  # each run with the end before it
    if not len(places):
        return out
    index = FMIndex(sequence[places], len(windows.vocabulary) + 1)
    which, low, high = index.search(windows)
    rows, owner = expand(low, high)
    if not len(rows):
        return out
    first = places[index.locate(rows)]
    which = which[owner]
    depth = np.zeros(len(sequence) + 1, np.int64)
    np.add.at(depth, first, 1)
    np.add.at(depth, first + windows.lengths[which], -1)
    edges = np.diff(np.concatenate(([0], (np.cumsum(depth) > 0).view(np.int8))))
    starts, stops = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    for doc, a, b in zip((np.searchsorted(begins, starts, "right") - 1).tolist(), starts.tolist(), stops.tolist()):
        at = int(begins[doc])
        out[doc]["spans"].append({"first": a - at, "last": b - at - 1})
    pairs = np.unique(np.stack((np.searchsorted(begins, first, "right") - 1, which)), axis=1)
    of: dict[int, set[str]] = {}
    for doc, w in pairs.T.tolist():
        of.setdefault(doc, set()).update(windows.items[w])
    for doc, items in of.items():
        out[doc]["items"] = sorted(items)
    return out


def hits_column(spark: SparkSession, windows: Windows, text: Column, shard_bytes: int) -> Column:
    shared = spark.sparkContext.broadcast(windows)  # at most a block's windows

    @F.arrow_udf(HITS)
    def hits(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            made: list[dict] = []
            shard: list[bytes | None] = []
            size = 0
            for t in batch:
                shard.append(t.as_py())
                size += len(shard[-1] or b"")
                if size >= shard_bytes:
                    made += search_shard(shard, shared.value)
                    shard, size = [], 0
            made += search_shard(shard, shared.value) if shard else []
            yield pa.array(made, pa.struct([
                ("n_words", pa.int64()),
                ("spans", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
                ("items", pa.list_(pa.string())),
            ]))

    return hits(text.cast("binary"))


def distinct_items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("binary")).distinct()


def blocks_of(benchmark: DataFrame, size: int, block_bytes: int) -> Iterator[Windows]:
    """The benchmark's windows, one bounded block of distinct items after the other."""
    items = distinct_items(benchmark)
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // max(1, block_bytes // 2)))
    for i in range(n):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)
        yield Windows.of([tuple(r) for r in part.collect()], size)


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    shard_bytes: int = 4 << 20,
    block_bytes: int = 4 << 20,
) -> DataFrame:
    """``docs`` with a column ``hits``: ``n_words``, the merged ``spans`` of hit
    words (first and last, from 0) and the ``items`` whose windows occur."""
    spark = docs.sparkSession
    total = distinct_items(benchmark).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = blocks_of(benchmark, window, block_bytes)
    if total <= block_bytes // 2:
        return docs.withColumn("hits", hits_column(spark, next(blocks), F.col("text"), shard_bytes))
    row = "__dc_row"
    docs = freeze(docs.withColumn(row, F.monotonically_increasing_id()), "decontam-input")
    parts = [
        freeze(docs.select(row, hits_column(spark, w, F.col("text"), shard_bytes).alias("hits")), "decontam-block")
        for w in blocks
    ]
    all_hits = parts[0]
    for p in parts[1:]:
        all_hits = all_hits.unionByName(p)
    merged = all_hits.groupBy(row).agg(
        F.struct(
            F.max("hits.n_words").alias("n_words"),
            merge_spans(F.flatten(F.collect_list("hits.spans"))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits.items")))).alias("items"),
        ).alias("hits")
    )
    return docs.join(merged, row).drop(row)


def merge_spans(spans: Column) -> Column:
    """Overlapping or touching spans become one."""
    none = F.array().cast(SPANS)
    return F.aggregate(
        F.array_sort(spans),
        none,
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["last"] >= s["first"] - 1),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["first"].alias("first"),
                        F.greatest(F.element_at(done, -1)["last"], s["last"]).alias("last"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )


def hit_words(hits: str = "hits") -> Column:
    return F.aggregate(
        f"{hits}.spans", F.lit(0).cast("long"), lambda n, s: n + (s["last"] - s["first"] + 1).cast("long")
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without any benchmark window."""
    found = find(docs.withColumnsRenamed({"hits": "__dc_hits"}), benchmark, **options)
    return found.filter(F.size("hits.spans") == 0).drop("hits").withColumnsRenamed({"__dc_hits": "hits"})
