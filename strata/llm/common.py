"""Helpers shared by the training-data operators."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder name in the shared scratch space, removed when the
    application ends."""
    path = scratch_path(spark, label)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def freeze(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch space and read it back: later stages
    start from the files, also after executors are lost."""
    path = scratch(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def mod_crc(n: int) -> Column:
    """``crc32(doc_id as text) mod n``, the fold rule of the contracts; a null
    id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % F.lit(n)


ROWS_PER_PART = 1_000_000


def join_spread(
    rows: DataFrame, groups: DataFrame, key: str, spread_by: list[str], total: int | None = None
) -> DataFrame:
    """``rows`` joined to the one row that their ``key`` has in ``groups``, whose column
    ``n`` counts the rows of the key.  A key with more than a part's rows is dealt over as
    many parts as its rows fill, by the columns ``spread_by``, and its group's row is repeated
    in each.  A part takes ``ROWS_PER_PART`` rows, on small tables a 1024th of all rows;
    it never takes less than a 65,536th, which bounds the broadcast list of dealt keys.
    ``total`` is the number of rows or more, where it is known."""
    if total is None:
        total = groups.agg(F.sum("n").alias("n")).first()["n"] or 0
    size = max(1, total >> 16, min(ROWS_PER_PART, total >> 10))
    parts = F.ceil(F.col("n") / size).cast("int")
    listed = groups.filter(F.col("n") > size).select(key, parts.alias("__parts"))
    part = F.coalesce(F.pmod(F.xxhash64(*spread_by), F.col("__parts")).cast("int"), F.lit(0))
    dealt = rows.join(F.broadcast(listed), key, "left").withColumn("__part", part).drop("__parts")
    each = F.when(F.col("n") > size, F.sequence(F.lit(0), parts - 1)).otherwise(F.array(F.lit(0)))
    repeated = groups.withColumn("__part", F.explode(each))
    return dealt.join(repeated, [key, "__part"]).drop("__part")
