"""Table writes that keep the declared table.

``saveAsTable(mode='overwrite')`` on a declared external table replaces the
declaration with the DataFrame's schema (types, comments, location, external
flag).  The writes here cast the frame to the declared schema and match columns
by name, so the table keeps its types (BIGINT keys), comments and external flag:

* ``overwrite_table`` replaces all rows in place;
* ``overwrite_partitions`` replaces the partitions that the frame holds and leaves
  the files of all others untouched;
* ``publish_table`` writes a new version beside the current one, checks it, and only
  then moves the table's location, so readers see the old rows or the new ones.

Each is one write job; row counts and other metrics are observed in that job.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager, nullcontext
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import catalog

RESCUED = "rescued_values"


def align_to(df: DataFrame, schema, keep_undeclared: bool = False, rescued: str | None = None) -> DataFrame:
    """Project ``df`` onto ``schema``: declared order, declared types (``try_cast``),
    matched by name case-insensitively; a declared column ``df`` lacks is a typed
    NULL; field metadata (comments) is kept.  ``keep_undeclared`` appends the
    columns that the schema does not name, as they are.

    ``rescued`` names a map column that is added last: the text of every value that its
    declared type rejects, by column name (NULL where all values fit)."""
    have = {c.lower(): c for c in df.columns}
    cols, entries, rejects = [], [], []
    for f in schema.fields:
        src = have.get(f.name.lower())
        if src is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name, metadata=f.metadata))
            continue
        raw = F.col(f"`{src}`")
        typed = raw.try_cast(f.dataType)
        cols.append(typed.alias(f.name, metadata=f.metadata))
        if rescued and not isinstance(f.dataType, T.StringType):
            rejects.append(raw.isNotNull() & typed.isNull())
            entries.append(F.struct(F.lit(f.name).alias("key"), F.when(rejects[-1], raw.cast("string")).alias("value")))
    declared = {f.name.lower() for f in schema.fields}
    if keep_undeclared:
        cols += [F.col(f"`{c}`") for c in df.columns if c.lower() not in declared]
    if rescued:
        found = F.lit(None).cast("map<string,string>")
        if entries:  # the map is made for the rows that need one
            found = F.when(reduce(or_, rejects), F.map_from_entries(F.filter(F.array(*entries), lambda e: e["value"].isNotNull())))
        cols.append(found.alias(rescued))
    return df.select(*cols)


def rejected_counts(schema, rescued: str = RESCUED) -> dict[str, Column]:
    """Per typed column of ``schema`` the aggregate that counts its rejected values, for ``observed``."""
    typed = [f.name for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    return {f"rejected.{c}": F.count_if(F.element_at(rescued, c).isNotNull()) for c in typed}


_numbers = itertools.count()


def observed(df: DataFrame, metrics: Mapping[str, Column] | None = None) -> tuple[DataFrame, Callable[[], dict]]:
    """``df`` with its row count (``rows``) and ``metrics`` observed in whatever job runs it, and a
    function that gives their values after that job."""
    obs = Observation(f"write_{next(_numbers)}")
    named = {"rows": F.count(F.lit(1)), **(metrics or {})}
    # metric names may hold any character, names of an observation's fields may not
    fields = {f"m{i}": name for i, name in enumerate(named)}
    out = df.observe(obs, *[named[name].alias(f) for f, name in fields.items()])
    return out, lambda: {name: obs.get[f] for f, name in fields.items()}


# partitions that a task writes side by side before it sorts the rest of its rows
OPEN_PARTITIONS = 16


@contextmanager
def _session_option(spark: SparkSession, option: str, value: Callable[[int], int]):
    before = spark.conf.get(option)
    spark.conf.set(option, value(int(before)))
    try:
        yield
    finally:
        spark.conf.set(option, before)


def open_partitions(spark: SparkSession):
    """Within the block a task keeps one file open for each of a few partitions, in place of sorting all
    its rows by partition: its memory then does not grow with the rows that it writes."""
    return _session_option(spark, "spark.sql.maxConcurrentOutputFileWriters", lambda n: max(OPEN_PARTITIONS, n))


# bytes of a method that the JVM still compiles
LARGEST_COMPILED = 8000


def compiled_methods(spark: SparkSession):
    """Within the block a step whose rules make a longer method runs as several short ones; the JVM
    interprets the long one, row by row, at half the speed or less."""
    return _session_option(spark, "spark.sql.codegen.hugeMethodLimit", lambda n: min(LARGEST_COMPILED, n))


def overwrite_table(df: DataFrame, table: str, metrics: Mapping[str, Column] | None = None, evolve: bool = False) -> dict:
    """Full rebuild of a declared table in one write job; returns the metrics observed in
    that job, the row count as ``rows``.  ``evolve`` first adds the columns that the table lacks."""
    spark = df.sparkSession
    if evolve:
        catalog.add_columns(spark, table, df.schema)
    aligned, values = observed(align_to(df, spark.table(table).schema), metrics)
    with open_partitions(spark) if catalog.partition_columns(spark, table) else nullcontext():
        aligned.write.insertInto(table, overwrite=True)
    spark.catalog.refreshTable(table)
    return values()


def overwrite_partitions(df: DataFrame, table: str, metrics: Mapping[str, Column] | None = None) -> dict:
    """Replace those partitions of a declared table that ``df`` has rows of."""
    spark = df.sparkSession
    by = catalog.partition_columns(spark, table)
    if not by:
        raise ValueError(f"{table} is not partitioned")
    aligned, values = observed(align_to(df, spark.table(table).schema), metrics)
    writer = aligned.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by)
    with open_partitions(spark):
        writer.parquet(catalog.location(spark, table))
    spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)
    return values()


VERSIONS = ".versions"


def publish_table(
    df: DataFrame,
    table: str,
    check: Callable[[DataFrame, dict], Sequence[str]] | None = None,
    metrics: Mapping[str, Column] | None = None,
) -> dict:
    """Write, audit, publish: ``df`` becomes a new version of a declared table.  ``check`` gets
    the written rows and the observed metrics and returns what is wrong with them; if that is
    anything, ``PublishError`` is raised and the table stays as it was.  The version before the current
    one is kept for readers that still hold it, older ones are removed."""
    spark = df.sparkSession
    declared = spark.table(table).schema
    current = catalog.location(spark, table)
    root = current.split(f"{VERSIONS}/")[0].removesuffix("/").removesuffix(VERSIONS)
    made = f"{root}{VERSIONS}/{uuid.uuid4().hex}"
    aligned, values = observed(align_to(df, declared), metrics)
    aligned.write.parquet(made)
    found = values()
    wrong = list(check(spark.read.schema(declared).parquet(made), found)) if check else []
    if wrong:
        _remove(spark, made)
        raise PublishError(f"{table} not published: {'; '.join(wrong)}")
    catalog.set_location(spark, table, made)
    for old in _folders(spark, f"{root}{VERSIONS}"):
        if old.rsplit("/", 1)[-1] not in (made.rsplit("/", 1)[-1], current.rsplit("/", 1)[-1]):
            _remove(spark, old)
    return found


def folder_bytes(spark: SparkSession, name: str) -> int:
    """Bytes of a file or of all files in a folder; 0 where there is none."""
    path, fs = _path(spark, name)
    return fs.getContentSummary(path).getLength() if fs.exists(path) else 0


class PublishError(RuntimeError):
    pass


def _path(spark: SparkSession, name: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _folders(spark: SparkSession, name: str) -> list[str]:
    path, fs = _path(spark, name)
    return [str(s.getPath()) for s in fs.listStatus(path)] if fs.exists(path) else []


def _remove(spark: SparkSession, name: str) -> None:
    path, fs = _path(spark, name)
    fs.delete(path, True)
