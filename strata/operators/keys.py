"""Surrogate keys.

* ``hash_key_joined`` (K1): ``xxhash64(concat_ws('||', cols...))``.
* ``hash_key_columns`` (K2): ``xxhash64(c1, c2, ...)`` - a different value from K1
  on the same inputs, so both forms exist.
* ``sequential_key`` (K3): dense ``1..n`` in key order without funnelling every
  row through one task (what ``row_number().over(Window.orderBy(k))`` does).
* ``period_key`` (K4): ``year * 100 + quarter``.

Hash keys are stable across reloads; sequential keys are renumbered on every
full rebuild, exactly like the window form they replace.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import as_col, ident

KEY_SEPARATOR = "||"


def hash_key_joined(cols: Sequence[str | Column], sep: str = KEY_SEPARATOR) -> Column:
    return F.xxhash64(F.concat_ws(sep, *[as_col(c) for c in cols]))


def hash_key_columns(cols: Sequence[str | Column]) -> Column:
    return F.xxhash64(*[as_col(c) for c in cols])


def period_key(year: str | Column, quarter: str | Column) -> Column:
    # widened first: a value out of range gives NULL, not an error
    year, quarter = (as_col(c).try_cast("decimal(20,0)") for c in (year, quarter))
    return (year * 100 + quarter).try_cast("int")


_RANGE, _TIE, _COPIES, _OFFSET, _CHUNK = "_sk_range", "_sk_tie", "_sk_copies", "_sk_offset", "_sk_chunk"
SAMPLE_PER_RANGE = 64
MOST_RANGES = 1 << 14  # bounds the sample (a million places) and the split points
COPIES_PER_CHUNK = 100_000


def _tie_columns(df: DataFrame, order_by: Sequence[str], tiebreak: Sequence[str] | None) -> list[str]:
    if tiebreak is not None:
        return list(tiebreak)
    # every other column that Spark can order (maps cannot be sorted)
    return [f.name for f in df.schema.fields if f.name not in order_by and "map<" not in f.dataType.simpleString()]


def range_tagged(
    df: DataFrame,
    order_by: Sequence[str],
    *,
    tiebreak: Sequence[str] | None = None,
    num_ranges: int | None = None,
) -> DataFrame:
    """``df`` with ``_sk_range`` (range of the row's place in the order, from 0) and ``_sk_tie``
    (a hash of the row).  Rows are in the order of the key columns (NULLS FIRST), then of the hash, then of
    ``tiebreak``, so one key value with many rows spreads over several ranges.

    The split points come from a mergeable sketch of the order: of every hash bucket of rows the row of
    least hash, i.e. one row drawn evenly from each of ``SAMPLE_PER_RANGE`` buckets a range, whatever the
    number of rows.  They depend on the rows alone, not on how these are partitioned, and are a scalar
    subquery of the plan: nothing runs when this function is called.
    """
    order_by = list(order_by)
    ranges = min(MOST_RANGES, num_ranges or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    steps = max(1, (ranges - 1).bit_length())  # of the binary search among 2 ** steps - 1 split points
    ranges = 1 << steps
    tied = df.withColumn(_TIE, F.xxhash64(*order_by, *_tie_columns(df, order_by, tiebreak)))
    place = F.struct(*order_by, _TIE)

    bucket = F.pmod(F.xxhash64(F.lit(1), _TIE), F.lit(ranges * SAMPLE_PER_RANGE))
    drawn = tied.groupBy(bucket.alias("b")).agg(F.min(F.struct(F.xxhash64(F.lit(2), _TIE).alias("h"), place.alias("p"))).alias("m"))
    points = F.expr(
        f"transform(sequence(1, {ranges - 1}), i -> element_at(s, cast(1 + (size(s) - 1) * i div {ranges} as int)))"
    )
    splits = drawn.agg(F.sort_array(F.collect_list("m.p")).alias("s")).filter("size(s) > 0").select(points).scalar()

    # binary search, a step an alias, so that the compiled expressions stay small
    steps_down = list(reversed(range(steps)))
    search = [f"0 AS _sk_at{steps}"] + [
        f"_sk_at{i + 1} + IF(_sk_place > element_at(_sk_splits, _sk_at{i + 1} + {1 << i}), {1 << i}, 0) AS _sk_at{i}" for i in steps_down
    ]
    found = tied.select("*", splits.alias("_sk_splits"), place.alias("_sk_place")).selectExpr("*", *search)
    return found.select(*[F.col(ident(c)) for c in tied.columns], F.col("_sk_at0").alias(_RANGE))


def sequential_key(
    df: DataFrame,
    order_by: Sequence[str],
    key_name: str,
    *,
    tiebreak: Sequence[str] | None = None,
    num_ranges: int | None = None,
    repeated_rows: bool = False,
) -> DataFrame:
    """Append ``key_name`` BIGINT = position of the row in ``order_by`` order (ASC,
    NULLS FIRST), numbered ``1..n`` with no gaps.

    One lazy plan of DataFrame operators; no row passes through a single task:

    1. rows are tagged with the range of their key values (``range_tagged``);
    2. rows per range are counted from the order columns alone, and a running sum over
       the counts (one row per range, so bounded and broadcast) gives each range's offset;
    3. each range is sorted and numbered in its own task, after the one shuffle that
       moves whole rows: key = offset + number within the range.

    The range of a row follows from its values and the split points, never from a partition
    id, so counting and numbering agree however adaptive execution regroups partitions and
    whichever tasks are repeated.  The input is read three times (split points, counts, rows).

    Ranges: ``num_ranges``, rounded up to a power of two, or four for each shuffle partition.
    Rows that are equal in every order and tie column share a range.  Where one row may be repeated very
    often, ``repeated_rows=True`` first counts equal rows, numbers the distinct ones by a running sum of
    their counts and unfolds them last, in chunks that are dealt over tasks.
    """
    rows = df
    if repeated_rows:
        rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(_COPIES))
        tiebreak = [c for c in _tie_columns(df, list(order_by), tiebreak)]
    ranged = range_tagged(rows, order_by, tiebreak=tiebreak, num_ranges=num_ranges)
    size = F.sum(_COPIES) if repeated_rows else F.count(F.lit(1))
    per_range = ranged.groupBy(_RANGE).agg(size.alias("_n"))
    before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(_RANGE, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(_OFFSET))

    ties = [c for c in _tie_columns(df, list(order_by), tiebreak)]
    within = Window.partitionBy(_RANGE).orderBy(*[F.col(c).asc_nulls_first() for c in [*order_by, _TIE, *ties]])
    placed = ranged.join(F.broadcast(offsets), _RANGE)
    if not repeated_rows:
        key = F.col(_OFFSET) + F.row_number().over(within)
        return placed.withColumn(key_name, key.cast("long")).drop(_RANGE, _TIE, _OFFSET)
    upto = F.sum(_COPIES).over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    first = placed.withColumn(_OFFSET, F.col(_OFFSET) + upto - F.col(_COPIES)).drop(_RANGE, _TIE)
    chunks = first.withColumn(_CHUNK, F.explode(F.expr(f"sequence(0L, ({_COPIES} - 1) div {COPIES_PER_CHUNK})")))
    chunks = chunks.repartition(_OFFSET, _CHUNK)
    number = F.expr(
        f"sequence({_OFFSET} + {_CHUNK} * {COPIES_PER_CHUNK} + 1,"
        f" {_OFFSET} + least({_COPIES}, ({_CHUNK} + 1) * {COPIES_PER_CHUNK}))"
    )
    return chunks.withColumn(key_name, F.explode(number)).drop(_OFFSET, _CHUNK, _COPIES)
