"""Stable surrogate keys from an append-only key registry.

The registry is a table of natural key, surrogate key and the run that allocated it.  A
run looks its members up, numbers those that the registry lacks after the largest key, in
natural-key order, and appends them in one write job.  Keys are never changed or given
twice: a member that leaves and returns gets its former key, and a run that is repeated finds
what it allocated before and adds nothing.

One run allocates at a time; the registry has no lock of its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .keys import sequential_key


def registry_schema(members: T.StructType, natural_key: Sequence[str], surrogate_key: str) -> T.StructType:
    """Columns of a registry for the natural key as ``members`` types it."""
    return T.StructType(
        [
            *[T.StructField(k, members[k].dataType, True, {"comment": "Natural key"}) for k in natural_key],
            T.StructField(surrogate_key, T.LongType(), True, {"comment": "Key, given once"}),
            T.StructField("run_id", T.StringType(), True, {"comment": "Run that gave the key"}),
        ]
    )


def _matches(left: DataFrame, right: DataFrame, natural_key: Sequence[str]):
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_r_{k}"]) for k in natural_key])


def _renamed(registry: DataFrame, natural_key: Sequence[str], *extra: str) -> DataFrame:
    return registry.select(*[F.col(k).alias(f"_r_{k}") for k in natural_key], *extra)


def allocate(members: DataFrame, table: str, natural_key: Sequence[str], surrogate_key: str, run_id: str) -> int:
    """Append keys for the members that the registry ``table`` lacks; returns how many."""
    spark, natural_key = members.sparkSession, list(natural_key)
    registry = spark.table(table)
    distinct = members.select(*natural_key).distinct()
    known = _renamed(registry, natural_key)
    path = scratch_path(spark, "registry-new")
    distinct.join(known, _matches(distinct, known, natural_key), "left_anti").write.parquet(path)
    new = spark.read.schema(distinct.schema).parquet(path)  # read from here on: the registry is about to change
    top = registry.agg(F.max(surrogate_key)).first()[0] or 0  # one scalar
    numbered = sequential_key(new, natural_key, "_rank", tiebreak=[])
    rows = numbered.select(*natural_key, (F.col("_rank") + F.lit(int(top))).alias(surrogate_key), F.lit(run_id).alias("run_id"))
    n = new.count()
    if n:
        rows.write.insertInto(table)
        spark.catalog.refreshTable(table)
    return n


def with_registered_key(members: DataFrame, registry: DataFrame, natural_key: Sequence[str], surrogate_key: str) -> DataFrame:
    """``members`` with the key that the registry holds for them (NULL where it holds none)."""
    known = _renamed(registry, natural_key, surrogate_key)
    joined = members.join(known, _matches(members, known, natural_key), "left")
    return joined.select(surrogate_key, *members.columns)
