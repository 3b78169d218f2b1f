"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into two 32-bit segments.  Two fingerprints at three or
fewer differing bits agree in one of the segments up to a single bit, so
looking up every key of the radius-1 Hamming ball around each segment finds all
of them; the full distance of each match is then verified.  Of two segments that
differ in one bit exactly one has that bit clear, so a fingerprint probes only
the keys that set one of its clear bits, beside the segment itself.

Defined results: null and blank texts have fingerprint zero and link like any
other; repeated rows share a fingerprint; an empty table gives an empty result;
only ``doc_id`` and ``text`` are read, other columns may have any name but, in
``keep_one``, ``__sh_row``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import freeze, join_spread
from .components import components

CHUNK = 1 << 16  # shingles whose bits are counted at once


def fingerprint(text: bytes | None, words: int = 3, seed: int = 42) -> int:
    """The signed 64-bit SimHash of one text."""
    tokens = (text or b"").lower().split()  # bytes: A-Z only; ASCII white space only
    if not tokens:
        return 0
    if len(tokens) <= words:
        shingles = [b" ".join(tokens)]
    else:
        line = b" ".join(tokens)
        ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1)
        starts = [0, *ends[:-words].tolist()]
        shingles = [line[a:b] for a, b in zip(starts, (ends[words - 1 :] - 1).tolist())]
    n, digest = len(shingles), xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        part = shingles[at : at + CHUNK]
        h = np.fromiter((digest(s, seed) for s in part), np.uint64, len(part))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprint_column(text: Column, words: int = 3) -> Column:
    @F.arrow_udf("long")
    def simhash(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array((fingerprint(t.as_py(), words) for t in batch), pa.int64())

    return simhash(text.cast("binary"))


def as_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def ball(key: Column, bits: int) -> Column:
    """The keys of ``bits`` bits at one differing bit or none from ``key``."""
    return F.array(key, *[key.bitwiseXOR(F.lit(1 << b)) for b in range(bits)])


def link_fingerprints(prints: DataFrame, most_bits: int = 3, most_in_key: int = 1024) -> DataFrame:
    """Pairs ``(u, v)``, u < v, of distinct fingerprints ``prints(fp)`` at
    ``most_bits`` (3 or fewer) differing bits; a pair may come twice.

    A segment's key that more than ``most_in_key`` fingerprints share (a family of
    one template) is not met pair by pair.  Fingerprints that agree in a segment up to
    one bit differ in at most three bits of the other, so they agree in one of its two
    16-bit halves up to a single bit: such a key's matches are looked up by a half's
    ball too.  Then at most 65,536 fingerprints are left under one key.  The limit
    grows with the input past 2^27 fingerprints, so that at most 2^18 keys are listed."""
    if not 0 <= most_bits <= 3:
        raise ValueError("two segments with balls of one bit cover distances up to 3")
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned("fp", 32)
    halves = F.array(F.struct(low.alias("key"), high.alias("rest")), F.struct(high.alias("key"), low.alias("rest")))
    keys = prints.select("fp", F.posexplode(halves).alias("segment", "k")).select("fp", "segment", "k.key", "k.rest")
    table = keys.select("segment", F.col("key").alias("probe"), "rest", F.col("fp").alias("found"))
    clear = F.expr(
        "concat(array(key), transform(filter(sequence(0, 31), b -> shiftright(key, b) & 1L = 0L),"
        " b -> key | shiftleft(1L, b)))"
    )
    probes = keys.select("segment", "fp", "key", "rest", F.explode(clear).alias("probe"))
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("found"))) <= most_bits
    # an exact key meets from both sides, a ball's key from one
    once = (F.col("probe") != F.col("key")) | (F.col("fp") < F.col("found"))

    spot = ["segment", "probe"]
    sizes = table.groupBy(*spot).agg(F.count(F.lit(1)).alias("n"))
    limit = max(most_in_key, 2 * prints.count() >> 18)
    full = F.broadcast(sizes.filter(F.col("n") > limit).select(*spot))
    plain = probes.join(full, spot, "left_anti").join(table.join(full, spot, "left_anti").drop("rest"), spot)

    half = [F.col("rest").bitwiseAND(F.lit(0xFFFF)), F.shiftright("rest", 16)]
    parts = table.join(full, spot, "left_semi").select(
        *spot, "found", F.posexplode(F.array(*half)).alias("half", "part")
    )
    asked = probes.join(full, spot, "left_semi").select(
        *spot, "fp", "key", F.posexplode(F.array(*[ball(h, 16) for h in half])).alias("half", "parts")
    )
    finer = asked.withColumn("part", F.explode("parts")).join(parts, [*spot, "half", "part"])

    def pairs(hits: DataFrame) -> DataFrame:
        return hits.filter(near & once).select(F.least("fp", "found").alias("u"), F.greatest("fp", "found").alias("v"))

    return pairs(plain).unionByName(pairs(finer))


def near_duplicates(docs: DataFrame, words: int = 3, most_bits: int = 3, row_id: str | None = None) -> DataFrame:
    """One row per document: ``doc_id, fp, component_id`` (the smallest doc_id
    reachable by links, its own included; null where a component has none), and
    ``row_id`` if such a column is named."""
    extra = [row_id] if row_id else []
    fps = freeze(docs.select("doc_id", *extra, fingerprint_column(F.col("text"), words).alias("fp")), "simhash")
    found = fps.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
    distinct = freeze(found, "simhash-distinct")
    roots = components(link_fingerprints(distinct.select("fp"), most_bits))
    # a linked fingerprint is mapped to its component's smallest id, any other to its own
    rooted = distinct.join(roots.withColumnRenamed("u", "fp"), "fp", "left").select(
        "fp", "least", "n", F.coalesce("root", "fp").alias("root")
    )
    smallest = freeze(
        rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("n")), "simhash-roots"
    )
    named = join_spread(rooted.withColumnRenamed("n", "copies"), smallest, "root", ["fp"])
    by_print = freeze(named.select("fp", F.col("copies").alias("n"), "component_id"), "simhash-groups")
    return join_spread(fps, by_print, "fp", ["doc_id", *extra]).select("doc_id", *extra, "fp", "component_id")


def keep_one(docs: DataFrame, words: int = 3, most_bits: int = 3) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row with
    the smallest doc_id stays, of rows that share it the first one."""
    row = "__sh_row"
    docs = freeze(docs.withColumn(row, F.monotonically_increasing_id()), "simhash-input")
    groups = near_duplicates(docs, words, most_bits, row_id=row)
    # the component is named by its smallest id; rows without any id share one name per fingerprint
    stays = groups.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("own")).agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row)).alias("first")
    )
    return docs.join(stays.select(F.col(f"first.{row}").alias(row)), row, "left_semi").drop(row)
