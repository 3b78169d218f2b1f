"""Vector codes by product quantisation, with distances from per-dimension value dictionaries.

Components become integers and vectors are cut into parts; each part has a codebook that is
fitted by Lloyd's rounds on all rows, in whole numbers.  Rows are coded once, in blocks: of each
dimension a block keeps its distinct integers (the dictionary) and every row's place among
them.  To assign a block, the squared difference of every distinct integer to all entries is tabulated,
and the distance of a part is the sum of one gather from these tables for each of its
dimensions, so squares are made per distinct value, not per row.

A round is one pass: each task adds up its blocks' counts and sums per entry, and the driver gets one row for
each part, entry and dimension.

Defined results: rows with a null vector or a null or non-finite component are dropped; a
scaled component beyond 2^26 in size counts as 2^26, so that every distance fits a long; the
dimension is the most frequent length (the longer of two as frequent), and a vector of another
length keeps its row with a null code and error; where the parts cannot be equal, the first
ones are one longer; the smallest ids come first, null ids last, and rows of equal id in the order of their
integers; with fewer rows than entries the codebooks are that much smaller; repeated rows
each count; a sum of errors beyond a long is null; an empty table gives an empty result.  Other columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import freeze, join_spread

BLOCK = 4096  # rows: a place in a dictionary fits 16 bits
LIMIT = 1 << 26
WHOLE = "__vc_whole"


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are numbers."""
    return vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))


def whole_numbers(vector: Column, scale: int, limit: int) -> Column:
    return F.transform(
        vector, lambda c: F.floor(F.least(F.greatest(c.cast("double") * scale, F.lit(float(-limit))), F.lit(float(limit)))).cast("long")
    )


def usual_length(rows: DataFrame, column: str) -> int:
    top = rows.groupBy(F.size(column).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return top[0]["d"] if top else 0


def matrix(column: pa.Array, width: int, kind=np.int64) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), width)


class Block:
    """Distinct integers of each dimension, and each row's place among them."""

    def __init__(self, values: list[np.ndarray], places: list[np.ndarray]):
        self.values, self.places = values, places

    @classmethod
    def of(cls, whole: np.ndarray) -> Block:
        pairs = [np.unique(whole[:, j], return_inverse=True) for j in range(whole.shape[1])]
        return cls([v for v, _ in pairs], [p.astype(np.uint16) for _, p in pairs])

    def packed(self) -> tuple[bytes, bytes, bytes]:
        sizes = np.array([len(v) for v in self.values], np.int32)
        return sizes.tobytes(), b"".join(v.tobytes() for v in self.values), b"".join(p.tobytes() for p in self.places)

    @classmethod
    def unpacked(cls, sizes: bytes, values: bytes, places: bytes) -> Block:
        bounds = np.cumsum(np.frombuffer(sizes, np.int32))
        return cls(np.split(np.frombuffer(values, np.int64), bounds)[:-1], list(np.frombuffer(places, np.uint16).reshape(len(bounds), -1)))

    def nearest(self, entries: np.ndarray, dims: range) -> tuple[np.ndarray, np.ndarray]:
        """Of one part, each row's nearest entry (the lowest of equally near ones) and squared distance."""
        total = np.zeros((len(self.places[0]), len(entries)), np.int64)
        for at, j in enumerate(dims):
            table = (self.values[j][:, None] - entries[None, :, at]) ** 2
            total += table[self.places[j]]
        best = total.argmin(1)
        return best, total[np.arange(len(best)), best]


def part_dims(width: int, parts: int) -> list[range]:
    return [range(int(x[0]), int(x[-1]) + 1) if len(x) else range(0) for x in np.array_split(np.arange(width), parts)]


def code_blocks(rows: DataFrame, width: int) -> DataFrame:
    """One row per block of ``rows`` (``vec_id``, ``label`` and the integers ``WHOLE``)."""
    carried = T.StructType([T.StructField(f.name, T.ArrayType(f.dataType)) for f in rows.select("vec_id", "label").schema])
    schema = T.StructType([*carried, *(T.StructField(c, T.BinaryType()) for c in ("sizes", "numbers", "places"))])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), BLOCK):
                cut = batch.slice(a, BLOCK)
                block = Block.of(matrix(cut.column(WHOLE), width)).packed()
                lists = [pa.ListArray.from_arrays([0, len(cut)], cut.column(c)) for c in ("vec_id", "label")]
                yield pa.RecordBatch.from_arrays([*lists, *(pa.array([b], pa.binary()) for b in block)], schema.names)

    return freeze(rows.select("vec_id", "label", WHOLE).mapInArrow(code, schema), "vector-blocks")


def blocks_in(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Block]]:
    for batch in batches:
        for i in range(len(batch)):
            row = batch.slice(i, 1)
            yield row, Block.unpacked(*(row.column(c)[0].as_py() for c in ("sizes", "numbers", "places")))


def next_codebooks(blocks: DataFrame, books: list[np.ndarray], dims: list[range]) -> list[np.ndarray]:
    """One round: every entry becomes the floor of the mean of its parts, unused ones stay."""
    names = ["part", "entry", "dim", "n", "total"]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(b.shape, np.int64) for b in books]
        sums = [np.zeros(b.shape, np.int64) for b in books]
        for _, block in blocks_in(batches):
            for p, entries in enumerate(books):
                best, _ = block.nearest(entries, dims[p])
                counts[p] += np.bincount(best, minlength=len(entries))[:, None]
                for at, j in enumerate(dims[p]):
                    # a block's sums stay below 2^53, where doubles are exact
                    sums[p][:, at] += np.bincount(best, block.values[j][block.places[j]], len(entries)).astype(np.int64)
        for p, n in enumerate(counts):
            entry, dim = (x.ravel() for x in np.indices(n.shape))
            columns = [np.full(n.size, p), entry, dim, n.ravel(), sums[p].ravel()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    read = blocks.select("sizes", "numbers", "places").mapInArrow(add_up, ", ".join(f"{c} long" for c in names))
    out = [b.copy() for b in books]
    for r in read.groupBy("part", "entry", "dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        if r["n"]:
            out[r["part"]][r["entry"], r["dim"]] = r["total"] // r["n"]
    return out


def assign(blocks: DataFrame, books: list[np.ndarray], dims: list[range]) -> DataFrame:
    """``vec_id, label, code, error`` of every row."""
    kinds = [T.StructField(c, blocks.schema[c].dataType.elementType) for c in ("vec_id", "label")]
    schema = T.StructType([*kinds, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, block in blocks_in(batches):
            found = [block.nearest(entries, dims[p]) for p, entries in enumerate(books)]
            text = np.stack([best for best, _ in found], 1).astype(np.uint8).tobytes().hex()
            step = 2 * len(books)
            yield pa.RecordBatch.from_arrays(
                [
                    row.column("vec_id").flatten(),
                    row.column("label").flatten(),
                    pa.array([text[i : i + step] for i in range(0, len(text), step)], pa.string()),
                    pa.array(sum(error for _, error in found), pa.int64()),
                ],
                schema.names,
            )

    return blocks.mapInArrow(code, schema)


def digest(books: list[np.ndarray]) -> str:
    numbers = ",".join(str(x) for b in books for x in b.ravel().tolist())
    return hashlib.sha256(numbers.encode()).hexdigest()


def compress(rows: DataFrame, vector: str = "embedding", parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> tuple[DataFrame, list[np.ndarray]]:
    """``vec_id, label, code, error, label_error`` for every row whose vector is whole, and the
    codebooks (one array of integers a part)."""
    kept = rows.filter(finite(F.col(vector))).select("vec_id", "label", whole_numbers(F.col(vector), scale, LIMIT).alias(WHOLE))
    width = usual_length(kept, WHOLE)
    usual = kept.filter(F.size(WHOLE) == width)
    dims = part_dims(width, parts)
    first = np.array([r[WHOLE] for r in usual.orderBy(F.asc_nulls_last("vec_id"), WHOLE).limit(entries).collect()], np.int64)
    books = [first.reshape(len(first), width)[:, d.start : d.stop] for d in dims]
    blocks = code_blocks(usual, width)
    if len(first):
        for _ in range(rounds):
            books = next_codebooks(blocks, books, dims)
    coded = freeze(assign(blocks, books, dims), "vector-codes")
    odd = kept.filter(F.size(WHOLE) != width).select(
        "vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")
    )
    coded = coded.unionByName(odd)
    name = F.coalesce(F.concat(F.lit("s"), F.col("label").cast("string")), F.lit("t")).alias("__vc_label")
    named = coded.select("*", name, F.xxhash64("vec_id", "code").alias("__vc_spread"))
    total = F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long")
    of_label = named.groupBy("__vc_label").agg(F.count(F.lit(1)).alias("n"), total.alias("label_error"))
    whole = join_spread(named, of_label, "__vc_label", ["__vc_spread"])
    return whole.select("vec_id", "label", "code", "error", "label_error"), books
