"""Relational building blocks: deterministic dedup, distinct-with-ratio, typed
projection, size-checked joins."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import ident


def dedup_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the lowest row in ``order_by`` order (ASC, NULLS FIRST;
    default: every non-key column in frame order).  NULL keys form one group.

    ``dropDuplicates`` keeps an arbitrary row; this keeps a reproducible one.
    Written as ``min(struct(...))`` per key, i.e. an aggregate, so Spark
    pre-aggregates in every map task before the shuffle: a key that holds a
    third of all rows is reduced to one row per task before it moves.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = list(order_by) if order_by is not None else rest
    carry = order + [c for c in rest if c not in order]
    if not carry:
        return df.select(*keys).distinct()
    best = F.min(F.struct(*[F.col(c).alias(c) for c in carry])).alias("_best")
    out = df.groupBy(*keys).agg(best)
    return out.select(*keys, *[F.col("_best").getField(c).alias(c) for c in carry]).select(*df.columns)


def rename_columns(df: DataFrame, mapping: dict[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """``select`` that keeps ``keep`` and the renamed columns, dropping the rest."""
    return df.select(*[F.col(c) for c in keep], *[F.col(src).alias(dst) for src, dst in mapping.items()])


@dataclass(frozen=True)
class Measure:
    name: str
    source: str
    sql_type: str  # "int" | "decimal(10,2)" | ...


def typed_measures(measures: Sequence[Measure]) -> list[Column]:
    """Columns that cast each source to its declared type; bad or overflowing
    input becomes NULL whether or not ANSI mode is on."""
    return [F.expr(f"try_cast({ident(m.source)} AS {m.sql_type}) AS {ident(m.name)}") for m in measures]


def distinct_with_ratio(df: DataFrame) -> DataFrame:
    """One row: input rows, distinct rows and their ratio (input / distinct),
    computed in one job; the distinct count comes from a two-level aggregate
    (per-row-group count, then count of groups) so it pre-aggregates."""
    cols = df.columns
    grouped = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    return grouped.agg(
        F.sum("_n").cast("long").alias("input_rows"),
        F.count(F.lit(1)).cast("long").alias("distinct_rows"),
    ).withColumn(
        "dedup_ratio",
        F.when(F.col("distinct_rows") > 0, F.round(F.col("input_rows") / F.col("distinct_rows"), 6)),
    )
