"""Equi-joins that stay safe under key skew.

Default: a plain join.  Catalyst/AQE pick the strategy from sizes measured at
run time (a side that is the output of a shuffle is broadcast only when its
actual size is below ``spark.sql.adaptive.autoBroadcastJoinThreshold``) and the
adaptive skew-join rule splits an oversized partition of one side into several
tasks, replicating the matching partition of the other side.

``hot_key_fraction``: an explicit split for when the skew must be handled
regardless of adaptive settings.  Keys holding more than that fraction of either
side's rows are "hot": at most ``2 / fraction`` keys (the counts of a side sum to
its row total), which bounds the list that is read to the driver and broadcast.
A hot key with L left and R right rows becomes a grid of ``ceil(L / rows_per_task)``
times ``ceil(R / rows_per_task)`` cells: a left row goes to one grid row and is
replicated along it, a right row to one grid column and is replicated along that,
so each pair meets in exactly one cell.  All other rows join normally and the two
results are unioned, so inner and left joins keep their exact results.  A left join
splits the left side only, since a left row without a partner in one cell of several
would give a row too many.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ROWS = "_jk_rows"
_COLS = "_jk_cols"


def _condition(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]):
    cond = None
    for lk, rk in pairs:
        c = left[lk] == right[rk]
        cond = c if cond is None else cond & c
    return cond


def equi_join(
    left: DataFrame,
    right: DataFrame,
    pairs: Sequence[tuple[str, str]],
    how: str = "inner",
    hot_key_fraction: float | None = None,
    rows_per_task: int = 1_000_000,
    strategy: str | None = None,
) -> DataFrame:
    """Join ``left`` and ``right`` on ``left[lk] == right[rk]`` for each pair.

    Both sides must have disjoint column names (rename first).  ``how`` is
    ``inner`` or ``left`` when ``hot_key_fraction`` is given.

    ``strategy="merge"`` pins a sort-merge join: for two sides that both grow
    with the data neither may be broadcast on a planner *estimate*, and
    sort-merge spills instead of holding a partition's hash table in memory.
    """
    def hinted(df: DataFrame) -> DataFrame:
        return df.hint(strategy) if strategy else df

    if not hot_key_fraction:
        return left.join(hinted(right), _condition(left, right, pairs), how)
    if how not in ("inner", "left"):
        raise ValueError("hot-key splitting supports inner and left joins")
    lkeys = [lk for lk, _ in pairs]
    keys = [f"_jk_{i}" for i in range(len(pairs))]

    def rows_per_key(df: DataFrame, names: Sequence[str], as_: str) -> DataFrame:
        # NULL keys never match, so they are not split even when frequent
        named = df.select(*[F.col(c).alias(k) for c, k in zip(names, keys)]).dropna()
        return named.groupBy(*keys).agg(F.count(F.lit(1)).alias(as_))

    counts = rows_per_key(left, lkeys, "_jk_l").join(
        rows_per_key(right, [rk for _, rk in pairs], "_jk_r"), keys, "full"
    )
    totals = counts.agg(F.sum("_jk_l"), F.sum("_jk_r")).first()
    most = [max(1, math.floor((n or 0) * hot_key_fraction)) for n in totals]
    hot_rows = counts.filter((F.col("_jk_l") > most[0]) | (F.col("_jk_r") > most[1])).collect()
    cells = [
        (*(r[k] for k in keys), math.ceil((r["_jk_l"] or 1) / rows_per_task),
         1 if how == "left" else math.ceil((r["_jk_r"] or 1) / rows_per_task))
        for r in hot_rows
    ]
    kinds = T.StructType([*counts.select(*keys).schema, T.StructField(_ROWS, T.IntegerType()),
                          T.StructField(_COLS, T.IntegerType())])
    hot = F.broadcast(left.sparkSession.createDataFrame(cells, kinds))

    def cold_rows(df: DataFrame, names: Sequence[str]) -> DataFrame:
        return df.join(hot, [F.col(c) == F.col(k) for c, k in zip(names, keys)], "left_anti")

    def in_grid(df: DataFrame, names: Sequence[str], own: str, other: str, at: Sequence[str]) -> DataFrame:
        # the place comes from the row's content, so a recomputed task gives the same one
        place = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.col(own)).cast("int")
        along = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        found = df.join(hot, [F.col(c) == F.col(k) for c, k in zip(names, keys)], "inner")
        return found.select(*df.columns, place.alias(at[0]), along.alias(at[1]))

    rkeys = [rk for _, rk in pairs]
    left_cold, right_cold = cold_rows(left, lkeys), cold_rows(right, rkeys)
    cold = left_cold.join(hinted(right_cold), _condition(left_cold, right_cold, pairs), how)
    left_hot = in_grid(left, lkeys, _ROWS, _COLS, ("_jk_la", "_jk_lb"))
    right_hot = in_grid(right, rkeys, _COLS, _ROWS, ("_jk_rb", "_jk_ra"))
    met = _condition(left_hot, right_hot, [*pairs, ("_jk_la", "_jk_ra"), ("_jk_lb", "_jk_rb")])
    hot_out = left_hot.join(hinted(right_hot), met, how).select(*left.columns, *right.columns)
    return cold.unionByName(hot_out)
