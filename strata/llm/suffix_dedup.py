"""Removal of repeated byte strings by suffix arrays per shard.

Texts are packed into shards of about ``shard_bytes``.  Every window of ``size`` bytes has an
anchor, the leftmost minimum of the hashes of its ``GRAM``-byte strings, so equal windows have
equal anchors at equal distances.

1. Each shard sends the sorted hashes of its anchors, split over buckets; the buckets
   merge the shards' lists and answer which anchors occur twice in the corpus.
2. Each shard looks its anchors up in the answer by binary search.  Windows around repeated
   anchors enter the shard's suffix array (Larsson-Sadakane refinement); common prefixes
   by Kasai's lemma show the windows that start earlier in the same shard.
3. For anchors of several shards, the stretches that hold the shard's first windows go to
   the anchor's bucket.  Equal stretches collapse into the earliest; windows that different
   stretches share are found by a suffix array over the bucket's stretches.
4. The removed windows of each shard come back to its texts.

An anchor that more than ``hot_shards`` shards hold sends its windows one by one to buckets
of their own, so a passage's neighbourhoods don't gather in one task.  Such windows are first
merged among slices of ``hot_shards`` shards, and only each slice's earliest copy of a window goes on,
so a passage that every shard holds doesn't send a row from each of them to one task.

Order of documents: by doc_id (null first), equal ids in the order they were read.
Defined results: a null or empty text has no bytes; texts shorter than ``size`` lose nothing;
an empty table gives an empty result; only ``doc_id`` and ``text`` are read, other columns
may have any name.  ``doc_id`` is an integer above -2**63, which stands for a null id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import freeze
from .suffixes import repeated_windows

GRAM = 32
NO_ID = -(1 << 63)
HIGH = np.uint64(0xFFFFFFFF00000000)


def packed(data: bytes) -> bytes:
    return pa.compress(data, codec="zstd", asbytes=True)


def unpacked(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, size, codec="zstd") if size else b"", np.uint8)


def make_shards(docs: DataFrame, shard_bytes: int) -> DataFrame:
    """``shard, doc_ids, sizes, bytes`` (packed), texts of a shard by doc_id."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 32
        held: list[tuple[int, bytes]] = []
        size = 0

        def shard() -> pa.RecordBatch:
            held.sort(key=lambda r: r[0])
            text = b"".join(r[1] for r in held)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([made], pa.int64()),
                    pa.array([np.array([r[0] for r in held], np.int64).tobytes()], pa.binary()),
                    pa.array([np.array([len(r[1]) for r in held], np.int64).tobytes()], pa.binary()),
                    pa.array([packed(text)], pa.binary()),
                ],
                ["shard", "doc_ids", "sizes", "bytes"],
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                doc_id, text = doc_id.as_py(), text.as_py() or b""
                if held and size + len(text) > shard_bytes:
                    yield shard()
                    made, held, size = made + 1, [], 0
                held.append((NO_ID if doc_id is None else doc_id, text))
                size += len(text)
        if held:
            yield shard()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return freeze(rows.mapInArrow(pack, "shard long, doc_ids binary, sizes binary, bytes binary"), "suffix-shards")


class Shard:
    def __init__(self, doc_ids: bytes, sizes: bytes, data: bytes):
        self.doc_ids = np.frombuffer(doc_ids, np.int64)
        self.sizes = np.frombuffer(sizes, np.int64)
        self.text = unpacked(data, int(self.sizes.sum()))
        self.begins = np.cumsum(self.sizes) - self.sizes

    def anchors(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each anchor its hash, place, and the first and last window it stands for."""
        none = np.zeros(0, np.int64)
        n = len(self.text)
        if n < size:
            return none.astype(np.uint64), none, none, none
        h = self.text.astype(np.uint64) + np.uint64(1)
        width = 1
        while width < GRAM:
            h = h[: len(h) - width] * np.uint64(0x9E3779B97F4A7C15 + 2 * width) + h[width:]
            h ^= h >> np.uint64(29)
            width *= 2
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        least = (h & HIGH) | np.arange(len(h), dtype=np.uint64)
        # minimum over the grams of a window, by doubling
        grams, width = size - GRAM + 1, 1
        while 2 * width <= grams:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < grams:
            least = np.minimum(least[: n - size + 1], least[grams - width :][: n - size + 1])
        ends = np.repeat(self.begins + self.sizes, self.sizes)
        windows = np.flatnonzero(np.arange(n - size + 1) + size <= ends[: n - size + 1])
        if not len(windows):
            return none.astype(np.uint64), none, none, none
        place = (least[windows] & ~HIGH).astype(np.int64)
        new = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        place = place[new]
        return h[place], place, windows[new], windows[np.append(new[1:], len(windows)) - 1]


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    """By the low half: a minimum's high half is small more often than not."""
    return (((h & ~HIGH) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def pieces_of(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket that occurs with the indexes of its rows, in order."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int(bucket[part[0]]), part


def spread(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All numbers from first to last of each row, in order."""
    sizes = last - first + 1
    return np.arange(sizes.sum()) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes)


def repeated_anchors(shards: DataFrame, size: int, buckets: int) -> DataFrame:
    """``shard, hashes`` (uint64, ascending in a bucket), ``holders`` (int32: how many shards hold
    each): the shard's anchors that occur more than once in the corpus."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                h = Shard(r["doc_ids"], r["sizes"], r["bytes"]).anchors(size)[0]
                h, n = np.unique(h, return_counts=True)
                parts = list(pieces_of(bucket_of(h, buckets)))
                yield pa.RecordBatch.from_pydict(
                    {
                        "bucket": pa.array([b for b, _ in parts], pa.int64()),
                        "shard": pa.array([r["shard"]] * len(parts), pa.int64()),
                        "hashes": pa.array([h[p].tobytes() for _, p in parts], pa.binary()),
                        "twice": pa.array([np.packbits(n[p] > 1).tobytes() for _, p in parts], pa.binary()),
                    }
                )

    def merge(group: pa.Table) -> pa.Table:
        lists = [np.frombuffer(x, np.uint64) for x in group.column("hashes").to_pylist()]
        twice = [
            np.unpackbits(np.frombuffer(x, np.uint8), count=len(h)).astype(bool)
            for x, h in zip(group.column("twice").to_pylist(), lists)
        ]
        every, holders = np.unique(np.concatenate(lists), return_counts=True)
        found = []
        for h, t in zip(lists, twice):
            n = holders[np.searchsorted(every, h)]
            kept = t | (n > 1)
            found.append((h[kept].tobytes(), n[kept].astype(np.int32).tobytes()))
        return pa.table(
            {
                "shard": group.column("shard"),
                "hashes": pa.array([f[0] for f in found], pa.binary()),
                "holders": pa.array([f[1] for f in found], pa.binary()),
            }
        )

    asked = shards.mapInArrow(ask, "bucket long, shard long, hashes binary, twice binary")
    return asked.groupBy("bucket").applyInArrow(merge, "shard long, hashes binary, holders binary")


# rows between the steps: in kind 0, ``a`` and ``b`` are first and last removed windows in the
# shard's text; in kind 1, ``a`` holds six int64 columns of stretches and ``b`` their packed bytes;
# kind 2 is like kind 1, of single windows around hot anchors
STEP = "bucket long, shard long, kind int, a binary, b binary"


def step_table(rows: list[tuple[int, int, int, bytes, bytes]]) -> pa.Table:
    kinds = [("bucket", pa.int64()), ("shard", pa.int64()), ("kind", pa.int32()), ("a", pa.binary()), ("b", pa.binary())]
    return pa.table({name: pa.array([r[i] for r in rows], t) for i, (name, t) in enumerate(kinds)})


def runs(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of the runs of consecutive numbers."""
    if not len(places):
        return places, places
    cut = np.flatnonzero(np.diff(places) != 1)
    return places[np.concatenate(([0], cut + 1))], places[np.append(cut, len(places) - 1)]


def search_shard(size: int, buckets: int, hot_shards: int):
    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return step_table([])
        r = left.to_pylist()[0]
        shard = Shard(r["doc_ids"], r["sizes"], r["bytes"])
        answer = np.frombuffer(b"".join(right.column("hashes").to_pylist()), np.uint64)
        holders = np.frombuffer(b"".join(right.column("holders").to_pylist()), np.int32)
        order = np.argsort(answer)
        answer, holders = answer[order], holders[order]
        if not len(answer):
            return step_table([])
        h, place, first, last = shard.anchors(size)
        at = np.minimum(np.searchsorted(answer, h), len(answer) - 1)
        known = answer[at] == h
        h, place, first, last, holders = h[known], place[known], first[known], last[known], holders[at[known]]

        # the shard's own repeats: bytes of the windows around repeated anchors
        windows = spread(first, last)
        covered = np.zeros(len(shard.text) + 1, np.int64)
        np.add.at(covered, first, 1)
        np.add.at(covered, last + size, -1)
        region = np.flatnonzero(np.cumsum(covered)[:-1] > 0)
        where = np.zeros(len(shard.text), np.int64)
        where[region] = np.arange(len(region))
        again = np.zeros(len(shard.text), bool)
        again[windows] = repeated_windows(shard.text[region], where[windows], size)
        a, b = runs(np.flatnonzero(again))
        rows = [(r["shard"] % buckets, r["shard"], 0, a.tobytes(), b.tobytes())] if len(a) else []

        # first windows around anchors of several shards
        fresh = np.zeros(len(shard.text) + 1, np.int64)
        fresh[windows] = ~again[windows]
        upto = np.concatenate(([0], np.cumsum(fresh)))
        some = (upto[last + 1] - upto[first] > 0) & (holders > 1)
        h, place, first, last, holders = (x[some] for x in (h, place, first, last, holders))
        if not len(h):
            return step_table(rows)
        following = np.flatnonzero(fresh)
        first, last = following[np.searchsorted(following, first)], following[np.searchsorted(following, last, "right") - 1]
        hot = holders > hot_shards

        def send(kind: int, bucket: np.ndarray, h: np.ndarray, place: np.ndarray, first: np.ndarray, last: np.ndarray) -> None:
            # by the texts' ends, as an empty text shares its begin with the next one
            doc = np.searchsorted(shard.begins + shard.sizes, first, "right")
            for name, part in pieces_of(bucket):
                f, t = first[part], last[part] + size
                columns = np.stack((h[part].view(np.int64), shard.doc_ids[doc[part]], doc[part], f, place[part] - f, t - f))
                rows.append((name, r["shard"], kind, columns.tobytes(), packed(shard.text[spread(f, t - 1)].tobytes())))

        if hot.any():
            one = spread(first[hot], last[hot])
            n = last[hot] - first[hot] + 1
            # a hot window's bucket follows from all its bytes
            key = np.zeros(len(one), np.uint64)
            for i in range(size):
                key = key * np.uint64(0x9E3779B97F4A7C15) + shard.text[one + i] + np.uint64(1)
            key ^= key >> np.uint64(32)
            send(2, bucket_of(key, buckets), np.repeat(h[hot], n), np.repeat(place[hot], n), one, one)
        h, place, first, last = h[~hot], place[~hot], first[~hot], last[~hot]
        if len(h):
            send(1, bucket_of(h, buckets), h, place, first, last)
        return step_table(rows)

    return search


class Stretches:
    """The stretches of some rows between the steps, and which of them lead: of equal
    stretches the earliest in document order."""

    def __init__(self, rows: list[dict], size: int):
        parts = [np.frombuffer(r["a"], np.int64).reshape(6, -1) for r in rows]
        texts = [unpacked(r["b"], int(p[5].sum())) for r, p in zip(rows, parts)]
        self.h, self.doc_id, self.doc, self.first, self.lead, self.n = self.columns = np.concatenate(parts, axis=1)
        self.shard = np.concatenate([np.full(p.shape[1], r["shard"], np.int64) for r, p in zip(rows, parts)])
        self.text = np.concatenate(texts)
        self.begin = np.cumsum(self.n) - self.n
        self.last = self.first + self.n - size
        order = np.lexsort((self.first, self.doc, self.shard, self.doc_id))
        self.rank = np.empty(len(order), np.int64)
        self.rank[order] = np.arange(len(order))
        ends = np.append(self.begin, len(self.text)).astype(np.int64)
        whole = pa.Array.from_buffers(pa.large_binary(), len(self.n), [None, pa.py_buffer(ends), pa.py_buffer(self.text)])
        same = whole.dictionary_encode().indices.to_numpy().astype(np.int64) * size + self.lead
        _, same = np.unique(same, return_inverse=True)
        least = np.full(same.max() + 1, len(self.rank), np.int64)
        np.minimum.at(least, same, self.rank)
        self.leads = self.rank == least[same]

    def bytes_of(self, pick: np.ndarray) -> np.ndarray:
        return self.text[spread(self.begin[pick], self.begin[pick] + self.n[pick] - 1)]


def removed_rows(bucket: int, shard: np.ndarray, first: np.ndarray, last: np.ndarray) -> Iterator[tuple]:
    """Rows of kind 0, one a shard, of removed windows; neighbouring ones are joined."""
    for s, part in pieces_of(shard) if len(shard) else ():
        order = np.argsort(first[part])
        f, t = first[part][order], last[part][order]
        new = np.concatenate(([True], f[1:] != t[:-1] + 1))
        f, t = f[new], t[np.append(np.flatnonzero(new)[1:], len(t)) - 1]
        yield bucket, s, 0, f.tobytes(), t.tobytes()


def merge_slice(size: int):
    """Of single windows of one bucket and one slice of the shards: the later copies are removed, the
    earliest go on as rows of kind 1."""

    def merge(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        bucket, x = rows[0]["bucket"], Stretches(rows, size)
        out = list(removed_rows(bucket, x.shard[~x.leads], x.first[~x.leads], x.last[~x.leads]))
        pick = np.flatnonzero(x.leads)
        for s, part in pieces_of(x.shard[pick]):
            mine = pick[part]
            out.append((bucket, s, 1, np.ascontiguousarray(x.columns[:, mine]).tobytes(), packed(x.bytes_of(mine).tobytes())))
        return step_table(out)

    return merge


def merge_bucket(size: int):
    """Removed windows of the stretches of one bucket; kind 0 passes through."""

    def merge(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        out = [(r["bucket"], r["shard"], 0, r["a"], r["b"]) for r in rows if r["kind"] == 0]
        rows = [r for r in rows if r["kind"] != 0]
        if not rows:
            return step_table(out)
        x = Stretches(rows, size)
        gone_shard, gone_first, gone_last = [x.shard[~x.leads]], [x.first[~x.leads]], [x.last[~x.leads]]
        # windows that different stretches with one anchor share
        pick = np.flatnonzero(x.leads)
        _, which, many = np.unique(x.h[pick], return_inverse=True, return_counts=True)
        pick = pick[many[which] > 1]
        pick = pick[np.argsort(x.rank[pick])]
        if len(pick):
            joined, n = x.bytes_of(pick), x.n[pick]
            start = np.cumsum(n) - n
            windows = spread(start, start + n - size)
            owner = np.repeat(np.arange(len(pick)), n - size + 1)
            again = repeated_windows(joined, windows, size)
            windows, owner = windows[again], owner[again]
            at = x.first[pick][owner] + windows - start[owner]
            gone_shard.append(x.shard[pick][owner])
            gone_first.append(at)
            gone_last.append(at)
        out += removed_rows(rows[0]["bucket"], *(np.concatenate(g) for g in (gone_shard, gone_first, gone_last)))
        return step_table(out)

    return merge


def merge_parts(found: DataFrame, n_shards: int, size: int, hot_shards: int) -> DataFrame:
    """``found`` merged by bucket, its rows of kind 2 by bucket and slice of ``hot_shards`` shards.  An anchor
    is hot in all shards or in none, so the two sorts of windows need not meet.  Rows of kind 1 that
    come out are the slices' earliest copies, which remain to be merged by bucket."""
    slices = -(-n_shards // hot_shards)
    dealt = F.when(F.col("kind") == 2, F.pmod(F.xxhash64("shard"), F.lit(slices))).otherwise(F.lit(-1))
    cold, hot = merge_bucket(size), merge_slice(size)

    def merge(group: pa.Table) -> pa.Table:
        return hot(group) if group.column("kind")[0].as_py() == 2 else cold(group)

    return found.groupBy("bucket", dealt).applyInArrow(merge, STEP)


RESULT = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,stop:long>>, kept binary"


def cut_shard(size: int):
    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left):
            return empty()
        r = left.to_pylist()[0]
        shard = Shard(r["doc_ids"], r["sizes"], r["bytes"])
        depth = np.zeros(len(shard.text) + 1, np.int64)
        for x in right.to_pylist():
            np.add.at(depth, np.frombuffer(x["a"], np.int64), 1)
            np.add.at(depth, np.frombuffer(x["b"], np.int64) + size, -1)
        gone = np.cumsum(depth)[:-1] > 0
        spans, kept, removed = [], [], []
        for a, n in zip(shard.begins.tolist(), shard.sizes.tolist()):
            mine = gone[a : a + n]
            removed.append(int(np.count_nonzero(mine)))
            kept.append(shard.text[a : a + n][~mine].tobytes())
            edges = np.flatnonzero(np.diff(np.concatenate(([0], mine.view(np.int8), [0]))))
            spans.append([{"start": x, "stop": y} for x, y in edges.reshape(-1, 2).tolist()])
        return pa.table(
            {
                "doc_id": pa.array([None if i == NO_ID else i for i in shard.doc_ids.tolist()], pa.int64()),
                "n_bytes": pa.array(shard.sizes),
                "n_removed": pa.array(removed, pa.int64()),
                "spans": pa.array(spans, SPANS),
                "kept": pa.array(kept, pa.binary()),
            }
        )

    return cut


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def empty() -> pa.Table:
    return pa.table({"doc_id": pa.array([], pa.int64()), "n_bytes": pa.array([], pa.int64()),
                     "n_removed": pa.array([], pa.int64()), "spans": pa.array([], SPANS),
                     "kept": pa.array([], pa.binary())})


def remove_repeats(
    docs: DataFrame,
    size: int = 100,
    shard_bytes: int = 4 << 20,
    buckets: int | None = None,
    hot_shards: int = 4096,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_removed``, the removed ``spans`` (start, stop
    in bytes) and the ``kept`` bytes.  ``buckets`` is by default one for each 8 MB of text."""
    if size < GRAM:
        raise ValueError(f"windows of {GRAM} bytes or more")
    shards = make_shards(docs, shard_bytes)
    n_shards = shards.count()
    if buckets is None:
        buckets = max(16, -(-n_shards * shard_bytes // (8 << 20)))
    answers = repeated_anchors(shards, size, buckets)
    found = shards.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(search_shard(size, buckets, hot_shards), STEP)
    removed = merge_parts(found, n_shards, size, hot_shards)
    if n_shards > hot_shards:  # with fewer shards no anchor is hot
        removed = removed.groupBy("bucket").applyInArrow(merge_bucket(size), STEP)
    return shards.groupBy("shard").cogroup(removed.groupBy("shard")).applyInArrow(cut_shard(size), RESULT)
