"""Uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

Rows are numbered within the blocks (input partitions) they are read in.  For each
block the exact number of rows that go to each shard is drawn from the multivariate
hypergeometric law over the shards' remaining room, so the matrix has the blocks'
sizes as row sums and the shards' sizes as column sums.  Each block permutes its rows
and deals them out by its matrix row; after the exchange each shard is permuted
again and its rows get slots from 0.

Every random draw comes from ``seed``, so a repeated task draws the same.  The matrix
has one row for each block and is drawn on the driver, in work that follows the blocks, not
their rows; the rows of the table never pass through it.  A shard is permuted in parts of about ``part_rows`` rows: its
rows are dealt to parts by a random key, so one shard may exceed a task.

Law of sizes: ``rows`` (shard sizes differ by one at most).  Defined results: texts
play no part, so nulls, equal texts and repeated rows are placed like any other row;
with fewer rows than shards some shards are empty; an empty table gives an empty
result; all columns are carried (names that begin with ``__sd_`` are taken).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import freeze

BLOCK, KEY, PART = "__sd_block", "__sd_key", "__sd_part"


def shard_sizes(rows: int, shards: int) -> np.ndarray:
    """Sizes at most one apart, the larger ones first."""
    return rows // shards + (np.arange(shards) < rows % shards)


def communication_matrix(blocks: np.ndarray, sizes: np.ndarray, seed: int) -> np.ndarray:
    """Rows that go from each block to each shard: a uniform random table with the
    given row and column sums.  The blocks are halved again and again; what each first half gets of each
    shard is multivariate hypergeometric, and all halves of a level are drawn together."""
    random = np.random.default_rng(seed)
    upto = np.concatenate(([0], np.cumsum(np.asarray(blocks, np.int64))))
    out = np.zeros((len(blocks), len(sizes)), np.int64)
    low, high = np.array([0]), np.array([len(blocks)])
    room = np.asarray(sizes, np.int64)[None, :]
    while len(low):
        one = high - low == 1
        out[low[one]] = room[one]
        low, high, room = low[high - low > 1], high[high - low > 1], room[high - low > 1]
        half = (low + high) // 2
        left = upto[half] - upto[low]
        others = room.sum(1)
        first = np.zeros_like(room)
        for j in range(room.shape[1]):
            # colour by colour: each draw is hypergeometric given what is left
            others = others - room[:, j]
            first[:, j] = hypergeometric(random, room[:, j], others, left)
            left = left - first[:, j]
        low, high, room = np.concatenate((low, half)), np.concatenate((half, high)), np.concatenate((first, room - first))
    return out


def hypergeometric(random: np.random.Generator, good: np.ndarray, bad: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """One draw for each row; numpy takes fewer than 10^9 of either colour, larger urns are drawn one by one."""
    out = np.zeros(len(good), np.int64)
    small = (good < 10**9) & (bad < 10**9)
    out[small] = random.hypergeometric(good[small], bad[small], draws[small])
    for i in np.flatnonzero(~small):
        out[i] = large_hypergeometric(random, int(good[i]), int(bad[i]), int(draws[i]))
    return out


def large_hypergeometric(random: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """One draw by inversion over twelve standard deviations around the mode (beyond them lies less
    than a double can tell from nothing); the work is a few standard deviations, not the draws."""
    least, most = max(0, draws - bad), min(good, draws)
    if least == most:
        return least
    total = good + bad
    mode = min(most, max(least, (draws + 1) * (good + 1) // (total + 2)))
    deviation = (draws * (good / total) * (bad / total) * ((total - draws) / max(1, total - 1))) ** 0.5
    reach = int(12 * deviation) + 40
    x = np.arange(max(least, mode - reach), min(most, mode + reach) + 1, dtype=np.int64)
    step = x[:-1].astype(np.float64)  # from x to x + 1
    ratio = np.log(good - step) + np.log(draws - step) - np.log(step + 1) - np.log(bad - draws + step + 1)
    height = np.concatenate(([0.0], np.cumsum(ratio)))
    weight = np.cumsum(np.exp(height - height.max()))
    return int(x[np.searchsorted(weight, random.random() * weight[-1], side="right")])


def shuffle_into_shards(docs: DataFrame, shards: int = 16, seed: int = 7, part_rows: int = 1 << 18) -> DataFrame:
    """``docs`` with ``shard`` (from 0) and ``slot`` (gapless from 0 in each shard)."""
    spark = docs.sparkSession
    row = "__sd_row"
    numbered = freeze(
        docs.withColumns({BLOCK: F.spark_partition_id(), row: F.monotonically_increasing_id()}), "sharding-rows"
    )
    sizes = sorted((r[BLOCK], r["count"]) for r in numbered.groupBy(BLOCK).count().collect())  # one row a block
    blocks = np.array([n for _, n in sizes], np.int64)
    room = shard_sizes(int(blocks.sum()), shards)
    matrix = communication_matrix(blocks, room, seed)

    # first permutation: a block's rows in random order are cut by its matrix row
    cuts = spark.createDataFrame(
        [(b, np.cumsum(line).tolist()) for (b, _), line in zip(sizes, matrix)], f"{BLOCK} int, cuts array<bigint>"
    )
    # a row's number holds its block, so its random key is the row's own; (key, row) has no ties
    within = F.row_number().over(Window.partitionBy(BLOCK).orderBy(F.xxhash64(F.lit(seed), row), row))
    dealt = numbered.withColumn("__sd_at", within).join(cuts, BLOCK)
    shard = F.size(F.filter("cuts", lambda c: c < F.col("__sd_at"))).cast("int")
    # second permutation: parts of a shard by the high bits of a fresh key, then the key
    key = F.xxhash64(F.lit(seed), F.lit("slot"), row)
    parts = max(1, -(-int(room.max(initial=0)) // part_rows))
    placed = dealt.withColumns({"shard": shard, KEY: key, PART: F.pmod(key, F.lit(parts)).cast("int")}).drop(
        "cuts", "__sd_at", BLOCK
    )
    placed = freeze(placed, "sharding-placed")
    counts = sorted((r["shard"], r[PART], r["count"]) for r in placed.groupBy("shard", PART).count().collect())
    before, offsets = {}, []
    for s, p, n in counts:  # one row a part
        offsets.append((s, p, before.get(s, 0)))
        before[s] = before.get(s, 0) + n
    base = spark.createDataFrame(offsets, f"shard int, {PART} int, __sd_base bigint")
    order = F.row_number().over(Window.partitionBy("shard", PART).orderBy(KEY, row))
    slots = placed.withColumn("__sd_order", order).join(base, ["shard", PART])
    slots = slots.withColumn("slot", F.col("__sd_base") + F.col("__sd_order") - 1)
    return slots.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("shard", "slot")], "shard", "slot")


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """The shuffled table as files, one folder for each shard; rows are in the order
    of their slots within each file."""
    placed = shuffle_into_shards(docs, **options)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
