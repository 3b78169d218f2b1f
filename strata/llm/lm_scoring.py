"""Language-model scores from a log-frequency Bloom filter.

The corpus is coded once: chunks of documents become one row each, with the chunk's
distinct words and the words' numbers in reading order.

Unigram counts are exact.  Every chunk sends each of its distinct words once, with its
count in learning documents, to the word's bucket; the bucket adds up and answers each
chunk in the order it was asked.

The model works in steps of its own, with the filter as a table between them:

1. ``learn_slices``: tasks add up the n-grams (orders 1 to ``order``) of their learning
   documents and send them to buckets by hash.  A bucket's counts are quantised as
   ``1 + floor(log_b c)`` and its slice of the filter holds one item for every level up to
   that; only the slice's bits and its highest level are written.
2. ``probe_slices``: chunks send the hashes of their n-grams, without counts, to the slices,
   which are probed level after level until one is missing.  The chunks that probe a slice are
   dealt over parts with a copy of it each, so an n-gram of every chunk makes no large group.
3. The levels go back to the chunks, where

    p(word | before) = mix * c(before word) / c(before) + (1 - mix) * p(word | shorter before)

   and, with nothing before, (c(word) + 1) / (N + V + 1).  Where ``before`` was never
   learned, the model backs off to the shorter one.

A slice takes ``bits_per_item`` bits for each item it holds, so the filter grows with the
n-grams and false positives stay equally rare (0.24 % a level at 16 bits); no worker holds
more than the slice it probes.

Defined results: a null or blank text is one end token; equal rows get equal scores; with
no learning documents N = V = 0; an empty table gives an empty result; only ``doc_id`` and
``text`` are read, other columns may have any name.  ``doc_id`` is an integer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import freeze

KEY_BITS = np.uint64(40)  # of an n-gram within its bucket of about two million
BEFORE, END = b"\nbefore", b"\nend"  # no word holds white space
HASHES = 4
BASE = 1.5  # of the logarithm that quantises counts
GATHERED = 1 << 22  # n-grams that a learning task adds up before it sends them
PROBERS = 1 << 14  # chunks that probe one copy of a slice


def packed(x: np.ndarray) -> bytes:
    """Compressed numbers, the bytes of equal weight side by side."""
    return pa.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T), "zstd", asbytes=True)


def unpacked(made: bytes, kind: type, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(made, n * size, "zstd"), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


# ---- coding the corpus
def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts, one after the other, and their number in each text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, ends = lists.values, lists.offsets.to_numpy()
    full = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0  # a blank at an end leaves an empty word
    upto = np.concatenate(([0], np.cumsum(full)))
    return words.filter(pa.array(full)), np.diff(upto[ends])


def code_corpus(docs: DataFrame, learn: Column, chunk_bytes: int = 4 << 20) -> DataFrame:
    """One row per chunk of ``docs``: ``chunk, doc_ids, learns, sizes`` (words in each
    document), ``numbers`` (packed int32 of each word's place in ``words``)."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            bytes_ = np.concatenate(([0], np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))))
            cuts = np.unique(np.searchsorted(bytes_, np.arange(0, bytes_[-1] + 1, chunk_bytes)))
            for a, b in zip(cuts, [*cuts[1:], len(batch)]):
                if a == b:
                    continue
                rows = batch.slice(a, b - a)
                words, sizes = split_words(rows.column("text"))
                coded = words.cast(pa.binary()).dictionary_encode()
                yield pa.RecordBatch.from_pydict(
                    {
                        "chunk": [part << 32 | made],
                        "doc_ids": pa.array([rows.column("doc_id")], pa.list_(pa.int64())),
                        "learns": pa.array([rows.column("learns")], pa.list_(pa.bool_())),
                        "sizes": [sizes.astype(np.int32).tobytes()],
                        "numbers": [packed(coded.indices.to_numpy().astype(np.int32))],
                        "words": pa.array([coded.dictionary], pa.list_(pa.binary())),
                        "tokens": [len(words)],
                        "word_bytes": [int(coded.dictionary.nbytes)],
                    },
                    pa.schema([
                        ("chunk", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("learns", pa.list_(pa.bool_())),
                        ("sizes", pa.binary()), ("numbers", pa.binary()), ("words", pa.list_(pa.binary())),
                        ("tokens", pa.int64()), ("word_bytes", pa.int64()),
                    ]),
                )
                made += 1

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), learn.alias("learns"))
    schema = "chunk long, doc_ids array<long>, learns array<boolean>, sizes binary, numbers binary, words array<binary>, tokens long, word_bytes long"
    return freeze(rows.mapInArrow(code, schema), "lm-corpus")


class Chunk:
    """One coded row.  Word numbers get two more: the end token and what is before a text."""

    def __init__(self, row: dict[str, pa.Array]):
        self.words = row["words"][0].values
        self.sizes = np.frombuffer(row["sizes"][0].as_py(), np.int32).astype(np.int64)
        numbers = unpacked(row["numbers"][0].as_py(), np.int32, int(self.sizes.sum()))
        self.end, self.before = len(self.words), len(self.words) + 1
        self.lengths = self.sizes + 1  # tokens, the end included
        self.learns = np.array(row["learns"][0].values.to_numpy(zero_copy_only=False), bool)
        # tokens of all documents; each document's last one is the end
        self.tokens = np.full(len(numbers) + len(self.sizes), self.end, np.int64)
        self.last = np.cumsum(self.lengths) - 1
        word = np.ones(len(self.tokens), bool)
        word[self.last] = False
        self.tokens[word] = numbers
        self.owner = np.repeat(np.arange(len(self.sizes)), self.lengths)
        self.first = self.last - self.sizes

    def hashes(self) -> np.ndarray:
        """64-bit hashes of the words, the end and what is before."""
        all_words = [*self.words.to_pylist(), END, BEFORE]
        return np.fromiter((xxhash.xxh64_intdigest(w, 1) for w in all_words), np.uint64, len(all_words))

    def grams(self, order: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct n-grams as bucket and key within it, in ascending order, and the place
        in them of the n-grams of order 1 at each token, of order 2 and so on, and then of
        the starts of a text (nothing but what is before it) of order 1, 2 and so on."""
        h = self.hashes()
        tokens, before = h[self.tokens], h[self.before :]
        gram, start = tokens, before
        grams, starts = [mixed(gram)], [mixed(start)]
        for _ in range(1, order):
            gram, start = chained(self.shifted(gram, start), tokens), chained(start, before)
            grams.append(gram)
            starts.append(start)
        hashes = np.concatenate((*grams, *starts[: order - 1]))
        bucket = bucket_of(hashes, buckets).astype(np.uint64) << KEY_BITS
        return np.unique(bucket | hashes & ((np.uint64(1) << KEY_BITS) - np.uint64(1)), return_inverse=True)

    def shifted(self, values: np.ndarray, start: np.ndarray) -> np.ndarray:
        """What each token has before it: the value of the token before, at the first one ``start``."""
        before = np.roll(values, 1)
        before[self.first] = start
        return before

    def learned(self, order: int, where: np.ndarray, n: int) -> np.ndarray:
        """Counts in learning documents of the chunk's ``n`` distinct n-grams."""
        here = np.tile(self.learns[self.owner], order)
        weights = np.concatenate((here, np.full(order - 1, np.count_nonzero(self.learns))))
        return np.bincount(where, weights, n).astype(np.int64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def chained(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mixed(before * np.uint64(0x94D049BB133111EB) + word)


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    return (((h >> np.uint64(40)) * np.uint64(buckets)) >> np.uint64(24)).astype(np.int64)


def in_buckets(bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A stable order by bucket, the buckets that occur and their bounds in it."""
    order = np.argsort(bucket, kind="stable")
    names, starts = np.unique(bucket[order], return_index=True)
    return order, names, np.append(starts, len(order))


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Chunk]]:
    for batch in batches:
        for i in range(len(batch)):
            row = {name: batch.column(name).slice(i, 1) for name in batch.schema.names}
            yield row["chunk"][0].as_py(), Chunk(row)


# ---- exact unigram counts
def unigram_totals(corpus: DataFrame, buckets: int) -> DataFrame:
    """``chunk, bucket, totals`` (packed int64 for the chunk's words of the bucket, in the
    chunk's order), and one row per bucket with a null chunk: its distinct and all
    learning tokens."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, c in chunks(batches):
            learned = np.bincount(c.tokens[c.learns[c.owner]], minlength=c.end + 1)
            words = pa.concat_arrays([c.words, pa.array([END], pa.binary())])
            order, names, bounds = in_buckets(bucket_of(mixed(c.hashes()[:-1]), buckets))
            words, learned = words.take(pa.array(order)), learned[order]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names),
                    pa.array(np.full(len(names), name)),
                    pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), words),
                    pa.array([packed(learned[a:b].astype(np.int64)) for a, b in zip(bounds, bounds[1:])], pa.binary()),
                ],
                ["bucket", "chunk", "words", "learned"],
            )

    def answer(group: pa.Table) -> pa.Table:
        words = pa.concat_arrays([x.flatten() for x in group.column("words").chunks])
        sizes = pc.list_value_length(group.column("words")).to_numpy()
        coded = words.dictionary_encode()
        at = coded.indices.to_numpy()
        learned = np.concatenate([unpacked(x, np.int64, k) for x, k in zip(group.column("learned").to_pylist(), sizes)])
        totals = np.zeros(len(coded.dictionary), np.int64)
        np.add.at(totals, at, learned)
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        sums = np.array([np.count_nonzero(totals), totals.sum()], np.int64)
        bucket = group.column("bucket")[0].as_py()
        replies = totals[at]
        return pa.table(
            {
                "chunk": pa.array([*group.column("chunk").to_pylist(), None], pa.int64()),
                "bucket": pa.array([bucket] * (len(group) + 1), pa.int64()),
                "totals": pa.array([*(packed(replies[a:b]) for a, b in zip(bounds, bounds[1:])), sums.tobytes()], pa.binary()),
            }
        )

    asked = corpus.mapInArrow(ask, "bucket long, chunk long, words array<binary>, learned binary")
    return freeze(asked.groupBy("bucket").applyInArrow(answer, "chunk long, bucket long, totals binary"), "lm-unigrams")


# ---- the filter
def probe(key: np.ndarray, level: int, i: int, slice_bits: int) -> np.ndarray:
    """The i-th bit of one level of each n-gram, in its slice."""
    h = mixed(key + np.uint64(level * 0x9E3779B97F4A7C15 % 2**64))
    step = (h >> np.uint64(32)) | np.uint64(1)
    return (((h & np.uint64(0xFFFFFFFF)) + np.uint64(i) * step) % np.uint64(slice_bits)).astype(np.int64)


def quantise(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / np.log(BASE) + 1e-9).astype(np.int64)


def by_bucket(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """The buckets of ascending n-grams, their bounds, and each bucket's packed keys."""
    names, starts = np.unique(grams >> KEY_BITS, return_index=True)
    bounds = np.append(starts, len(grams))
    steps = np.diff(grams, prepend=np.uint64(0))
    steps[starts] = grams[starts] - (names << KEY_BITS)
    return names.astype(np.int64), bounds, [packed(steps[a:b]) for a, b in zip(bounds, bounds[1:])]


def keys_of(group: pa.Table) -> np.ndarray:
    """The keys of all rows of a bucket, one after the other."""
    column = zip(group.column("steps").to_pylist(), group.column("size").to_pylist())
    return np.concatenate([np.cumsum(unpacked(x, np.uint64, k)) for x, k in column])


def learn_slices(corpus: DataFrame, order: int, buckets: int, bits_per_item: int) -> DataFrame:
    """The filter: ``bucket, highest`` (level), ``n_bits, bits``, one row a bucket that learned
    anything."""

    def send(gathered: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        grams, where = np.unique(np.concatenate([g for g, _ in gathered]), return_inverse=True)
        n = np.bincount(where, np.concatenate([n for _, n in gathered]), len(grams)).astype(np.int64)
        names, bounds, steps = by_bucket(grams)
        counts = [packed(n[a:b]) for a, b in zip(bounds, bounds[1:])]
        columns = [pa.array(names), pa.array(np.diff(bounds)), pa.array(steps, pa.binary()), pa.array(counts, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["bucket", "size", "steps", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, held = [], 0
        for _, c in chunks(batches):
            grams, where = c.grams(order, buckets)
            n = c.learned(order, where, len(grams))
            gathered.append((grams[n > 0], n[n > 0]))
            held += len(gathered[-1][0])
            if held >= GATHERED:
                yield send(gathered)
                gathered, held = [], 0
        if held:
            yield send(gathered)

    def build(group: pa.Table) -> pa.Table:
        key, where = np.unique(keys_of(group), return_inverse=True)
        read = zip(group.column("n").to_pylist(), group.column("size").to_pylist())
        n = np.bincount(where, np.concatenate([unpacked(x, np.int64, k) for x, k in read]), len(key))
        held, highest = make_slice(key, quantise(n), bits_per_item)
        return pa.table(
            {
                "bucket": group.column("bucket").slice(0, 1),
                "highest": pa.array([highest], pa.int32()),
                "n_bits": pa.array([len(held)], pa.int64()),
                "bits": pa.array([np.packbits(held).tobytes()], pa.binary()),
            }
        )

    sent = corpus.mapInArrow(count, "bucket long, size long, steps binary, n binary")
    made = sent.repartition(partitions(buckets), "bucket").groupBy("bucket")
    return freeze(made.applyInArrow(build, "bucket long, highest int, n_bits long, bits binary"), "lm-filter")


def probe_slices(corpus: DataFrame, slices: DataFrame, order: int, buckets: int, n_chunks: int) -> DataFrame:
    """``chunk, bucket, size, levels`` (packed uint8 for the chunk's n-grams of the bucket,
    in the order of their keys) as the bucket's slice gives them back, zero without a slice."""
    parts = -(-n_chunks // PROBERS) or 1

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, c in chunks(batches):
            names, bounds, steps = by_bucket(c.grams(order, buckets)[0])
            columns = [pa.array(names), pa.array(np.full(len(names), name)), pa.array(np.diff(bounds)), pa.array(steps, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "chunk", "size", "steps"])

    def answer(probes: pa.Table, held: pa.Table) -> pa.Table:
        sizes = probes.column("size").to_numpy()
        key = keys_of(probes) if len(probes) else np.zeros(0, np.uint64)
        levels = np.zeros(len(key), np.uint8)
        for row in held.to_pylist():  # at most one
            distinct, where = np.unique(key, return_inverse=True)
            bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=row["n_bits"]).astype(bool)
            levels = read_levels(bits, row["highest"], distinct).astype(np.uint8)[where]
        bounds = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        return pa.table(
            {
                "chunk": probes.column("chunk"),
                "bucket": probes.column("bucket"),
                "size": probes.column("size"),
                "levels": pa.array([packed(levels[a:b]) for a, b in zip(bounds, bounds[1:])], pa.binary()),
            }
        )

    asked = corpus.mapInArrow(ask, "bucket long, chunk long, size long, steps binary")
    asked = asked.withColumn("part", F.pmod(F.xxhash64("chunk"), F.lit(parts)).cast("int"))
    copies = slices.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    n = partitions(buckets * parts)
    left, right = (x.repartition(n, "bucket", "part").groupBy("bucket", "part") for x in (asked, copies))
    return left.cogroup(right).applyInArrow(answer, "chunk long, bucket long, size long, levels binary")


def partitions(groups: int) -> int:
    """Shuffle partitions for groups of a bounded size, so that a task's size does not grow."""
    return max(8, min(groups, 1 << 15))


def make_slice(key: np.ndarray, levels: np.ndarray, bits_per_item: int) -> tuple[np.ndarray, int]:
    """The bits of one bucket's slice, and its highest level."""
    held = np.zeros(max(512, bits_per_item * int(levels.sum())), bool)
    highest = int(levels.max(initial=0))
    for level in range(1, highest + 1):
        on = levels >= level
        key, levels = key[on], levels[on]
        for i in range(HASHES):
            held[probe(key, level, i, len(held))] = True
    return held, highest


def read_levels(held: np.ndarray, highest: int, key: np.ndarray) -> np.ndarray:
    """Levels of n-grams, read by probing one after the other up to the highest written."""
    level, left = np.zeros(len(key), np.int64), np.arange(len(key))
    for at in range(1, highest + 1):
        for i in range(HASHES):
            left = left[held[probe(key[left], at, i, len(held))]]
        level[left] = at
    return level


def estimates(level: np.ndarray) -> np.ndarray:
    """Counts that quantised ones stand for."""
    level = level.astype(np.int64)
    return np.where(level > 0, np.maximum(1.0, (BASE ** (level - 1.0) + BASE**level - 1) / 2), 0.0)


SCORES = "doc_id long, learns boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_documents(
    docs: DataFrame,
    learn: Column,
    mix: float = 0.7,
    bits_per_item: int = 16,
    order: int = 2,
    bucket_bytes: int = 16 << 20,
) -> DataFrame:
    """One row per row of ``docs``; the model learns from those where ``learn`` (a
    condition on doc_id) holds, with n-grams of up to ``order`` words."""
    corpus = code_corpus(docs, learn)
    asked, tokens, n_chunks = corpus.agg(F.sum("word_bytes"), F.sum("tokens"), F.count(F.lit(1))).first()
    buckets = max(8, -(-(asked or 0) // bucket_bytes))
    totals = unigram_totals(corpus, buckets)
    n = v = 0
    for row in totals.filter("chunk is null").collect():  # one row a bucket
        distinct, learned = np.frombuffer(row["totals"], np.int64)
        n, v = n + int(learned), v + int(distinct)
    gram_buckets = max(8, -(-4 * order * (tokens or 0) // bucket_bytes))
    slices = learn_slices(corpus, order, gram_buckets, bits_per_item)
    levels = probe_slices(corpus, slices, order, gram_buckets, n_chunks)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        row = {name: left.column(name).combine_chunks() for name in left.schema.names}
        c = Chunk(row)
        # exact counts come back bucket by bucket, in the order they were asked
        placed, names, bounds = in_buckets(bucket_of(mixed(c.hashes()[:-1]), buckets))
        of_words = right.filter(pc.is_valid(right.column("totals")))
        replies = dict(zip(of_words.column("bucket").to_pylist(), of_words.column("totals").to_pylist()))
        exact = np.zeros(c.end + 1, np.int64)
        for name, a, b in zip(names.tolist(), bounds, bounds[1:]):
            exact[placed[a:b]] = unpacked(replies[name], np.int64, b - a)
        base = np.log10((exact + 1.0) / (n + 1.0 * (v + 1)))
        # levels too, in the order of the n-grams' keys
        of_grams = right.filter(pc.is_valid(right.column("levels"))).sort_by("bucket")
        read = zip(of_grams.column("levels").to_pylist(), of_grams.column("size").to_pylist())
        counts = estimates(np.concatenate([unpacked(x, np.uint8, k) for x, k in read]))[c.grams(order, gram_buckets)[1]]
        *of_order, starts = np.split(counts, np.arange(1, order + 1) * len(c.tokens))
        p = (of_order[0] + 1.0) / (n + v + 1.0)
        for both, shorter, start in zip(of_order[1:], of_order, starts):
            seen = c.shifted(shorter, start)
            p = np.where(seen > 0, mix * np.minimum(both, seen) / np.maximum(seen, 1.0) + (1 - mix) * p, p)
        logs = np.log10(np.minimum(p, 1.0))
        docs_ = len(c.sizes)
        return pa.table(
            {
                "doc_id": row["doc_ids"][0].values,
                "learns": pa.array(c.learns),
                "n_tokens": pa.array(c.lengths, pa.int64()),
                "n_known": pa.array(np.bincount(c.owner, exact[c.tokens] > 0, docs_).astype(np.int64)),
                "train_tokens": pa.array(np.full(docs_, n, np.int64)),
                "base_score": pa.array(np.bincount(c.owner, base[c.tokens], docs_)),
                "score": pa.array(np.bincount(c.owner, logs, docs_)),
            }
        )

    replied = totals.filter("chunk is not null").unionByName(levels, allowMissingColumns=True)
    return corpus.groupBy("chunk").cogroup(replied.groupBy("chunk")).applyInArrow(score, SCORES)
