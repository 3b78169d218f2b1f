"""Catalog: databases, declared tables over existing files, refresh, dictionary.

Everything goes through the session catalog API (``spark.catalog``) and is
idempotent: creating what exists is a no-op, like ``IF NOT EXISTS``.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.rules import ident, sql_lit


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS``."""
    if spark.catalog.databaseExists(name):
        return
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")


def use_database(spark: SparkSession, name: str) -> None:
    """Unqualified table names resolve in ``name`` from now on."""
    spark.catalog.setCurrentDatabase(name)


@contextmanager
def current_database(spark: SparkSession, name: str):
    """S11 for a block: switch, then restore the caller's current database."""
    previous = spark.catalog.currentDatabase()
    use_database(spark, name)
    try:
        yield
    finally:
        use_database(spark, previous)


def _column(f: T.StructField) -> str:
    comment = f.metadata.get("comment")
    return f"{ident(f.name)} {f.dataType.simpleString()}" + (f" COMMENT {sql_lit(comment)}" if comment else "")


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    location: str | None,
    comment: str | None = None,
    source: str = "parquet",
    partition_by: Sequence[str] = (),
    bucket_by: tuple[str, int] | None = None,
) -> bool:
    """A table with a declared schema (column comments from field
    metadata) over files at ``location``; returns False if it already existed.
    ``partition_by`` columns are folders; ``bucket_by`` is a column, by which rows are
    hashed and sorted, and a number of buckets."""
    if spark.catalog.tableExists(name):
        return False
    if not partition_by and not bucket_by:
        spark.catalog.createTable(name, path=location, source=source, schema=schema, description=comment or "")
        return True
    parts = [f"CREATE TABLE {name} ({', '.join(_column(f) for f in schema.fields)}) USING {source}"]
    if partition_by:
        parts.append(f"PARTITIONED BY ({', '.join(ident(c) for c in partition_by)})")
    if bucket_by:
        key = ident(bucket_by[0])
        parts.append(f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {int(bucket_by[1])} BUCKETS")
    if location:  # else the table is managed
        parts.append(f"LOCATION {sql_lit(location)}")
    if comment:
        parts.append(f"COMMENT {sql_lit(comment)}")
    spark.sql(" ".join(parts))
    return True


def add_columns(spark: SparkSession, name: str, schema: T.StructType) -> list[str]:
    """Add to a table the columns of ``schema`` that it lacks (rows written before read NULL
    there); returns their names.  Types of columns that exist are not changed."""
    have = {c.lower() for c in spark.table(name).columns}
    new = [f for f in schema.fields if f.name.lower() not in have]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(_column(f) for f in new)})")
        spark.catalog.refreshTable(name)
    return [f.name for f in new]


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    return {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}


def location(spark: SparkSession, name: str) -> str:
    return _described(spark, name)["Location"]


def bucket_count(spark: SparkSession, name: str) -> int | None:
    """The number of buckets of a declared table; None without such a table or buckets."""
    found = _described(spark, name).get("Num Buckets") if spark.catalog.tableExists(name) else None
    return int(found) if found else None


def set_location(spark: SparkSession, name: str, path: str) -> None:
    spark.sql(f"ALTER TABLE {name} SET LOCATION {sql_lit(path)}")
    spark.catalog.refreshTable(name)


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def refresh(spark: SparkSession, name: str) -> None:
    """Make files rewritten outside the catalog visible."""
    spark.catalog.refreshTable(name)


def table_info(spark: SparkSession, database: str) -> list[tuple[str, str, str | None]]:
    """``(table_name, table_type, location)`` for every table of ``database``; views have no location."""
    out = []
    for t in spark.catalog.listTables(database):
        loc = None if t.isTemporary or t.tableType == "VIEW" else _described(spark, f"`{database}`.`{t.name}`").get("Location")
        out.append((t.name, t.tableType, loc))
    return out


def data_dictionary(spark: SparkSession, database: str, tables: list[str] | None = None) -> DataFrame:
    """``(table_name, column_name, data_type, comment)`` from the catalog.

    Metadata only (bounded by the number of declared columns), assembled on the
    driver from ``listColumns`` and returned as a small DataFrame.
    """
    names = tables or [t.name for t in spark.catalog.listTables(database)]
    rows = []
    for t in names:
        for c in spark.catalog.listColumns(f"{database}.{t}"):
            rows.append((t, c.name, c.dataType, c.description))
    schema = "table_name string, column_name string, data_type string, comment string"
    return spark.createDataFrame(rows, schema)
