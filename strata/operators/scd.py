"""Slowly changing dimension, type 1: update attributes in place, keep keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keys import sequential_key
from .relational import dedup_by_key

CHANGE = "_scd_change"


def _attributes(current: DataFrame, incoming: DataFrame, natural_key: Sequence[str], surrogate_key: str) -> list[str]:
    # the stored dimension defines the attributes; incoming must provide them all
    attrs = [c for c in current.columns if c not in natural_key and c != surrogate_key]
    missing = [c for c in [*natural_key, *attrs] if c not in incoming.columns]
    if missing:
        raise ValueError(f"incoming rows lack dimension columns: {missing}")
    return attrs


def scd1_classify(current: DataFrame, incoming: DataFrame, natural_key: Sequence[str], surrogate_key: str) -> DataFrame:
    """One null-safe full outer join of the stored dimension (with ``surrogate_key``) and the incoming
    members, which puts each member into one class, column ``_scd_change``:

    * ``matched``: in both; incoming attributes, the current key;
    * ``kept``: only in current; unchanged;
    * ``new``: only incoming; its key is NULL.

    Incoming rows that share a natural key are reduced to one by the deterministic dedup; a
    current table that repeats a natural key stops the job.
    """
    natural_key = list(natural_key)
    attrs = _attributes(current, incoming, natural_key, surrogate_key)
    members = dedup_by_key(incoming.select(*natural_key, *attrs), natural_key)
    old = current.groupBy(*natural_key).agg(
        F.count(F.lit(1)).alias("_o_n"), F.min(F.struct(surrogate_key, *attrs)).alias("_o")
    )
    repeated = F.raise_error(F.lit(f"current rows repeat the natural key {natural_key}"))
    old = old.select(
        *[F.col(k).alias(f"_o_{k}") for k in natural_key], F.when(F.col("_o_n") > 1, repeated).otherwise(F.col("_o")).alias("_o")
    )
    new = members.withColumn("_i", F.lit(True))
    same: Column = reduce(lambda a, b: a & b, [new[k].eqNullSafe(old[f"_o_{k}"]) for k in natural_key])
    both = new.join(old, same, "full")
    arrived, stored = F.col("_i").isNotNull(), F.col("_o").isNotNull()
    change = F.when(arrived & stored, "matched").when(stored, "kept").otherwise("new")
    return both.select(
        F.col(f"_o.{surrogate_key}").alias(surrogate_key),
        *[F.when(arrived, F.col(k)).otherwise(F.col(f"_o_{k}")).alias(k) for k in natural_key],
        *[F.when(arrived, F.col(c)).otherwise(F.col(f"_o.{c}")).alias(c) for c in attrs],
        change.alias(CHANGE),
    )


def scd1_number(classified: DataFrame, natural_key: Sequence[str], surrogate_key: str) -> DataFrame:
    """Give the new members of a classified table keys after the largest one, in natural-key
    order.  The table is read more than once: write it first where it is expensive."""
    known = classified.filter(F.col(CHANGE) != "new")
    top = classified.agg(F.coalesce(F.max(surrogate_key), F.lit(0)).cast("long")).scalar()
    columns = [c for c in classified.columns if c != CHANGE]
    new = classified.filter(F.col(CHANGE) == "new").drop(surrogate_key, CHANGE)
    numbered = sequential_key(new, list(natural_key), "_new_rank")
    keyed = numbered.withColumn(surrogate_key, F.col("_new_rank") + top)
    return known.select(*columns).unionByName(keyed.select(*columns))


def scd1_upsert(
    current: DataFrame,
    incoming: DataFrame,
    natural_key: Sequence[str],
    surrogate_key: str,
) -> DataFrame:
    """``scd1_classify`` and ``scd1_number`` as one lazy plan.  Keys of existing members never
    change, unlike in a full rebuild."""
    classified = scd1_classify(current, incoming, natural_key, surrogate_key)
    return scd1_number(classified, natural_key, surrogate_key).select(*current.columns)
