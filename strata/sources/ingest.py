"""Bronze ingestion: delimited files -> typed Parquet with lineage columns.

One pass per file: the file is read with every column as text, columns are
matched to the declared schema by name (case-insensitive, a declared column
missing from the file is NULL) and converted with ``try_cast``, so there is no
separate schema-inference scan and a bad value becomes NULL instead of failing
the load; its text is kept in a map column and counted per column.  Schema inference stays available (``infer_schema=True``) for files
without a declared schema.  Row and reject counts are collected with ``observe`` during
the write, so the file is not scanned a second time to count it.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sinks import RESCUED, align_to, observed, overwrite_table, rejected_counts


@dataclass(frozen=True)
class SourceFile:
    file: str  # file (or folder) name under the source folder
    table: str  # bronze table name


# The five source files of the bronze layer and their tables.
DEFAULT_SOURCES = (
    SourceFile("Telco_customer_churn_demographics.csv", "demographics"),
    SourceFile("Telco_customer_churn_location.csv", "location"),
    SourceFile("Telco_customer_churn_population.csv", "population"),
    SourceFile("Telco_customer_churn_services.csv", "services"),
    SourceFile("Telco_customer_churn_status.csv", "status"),
)


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    *,
    infer_schema: bool = False,
    header: bool = True,
    sep: str = ",",
    rescued: str | None = None,
) -> DataFrame:
    """Read a delimited file with a header.

    With ``schema``: text read, then projected onto the schema by column name
    with ``try_cast`` (absent columns are NULL); columns of the file that the
    schema does not name follow as text, so the raw layer loses none; ``rescued`` names a map
    column for the text of values that their declared type rejects.
    Without: every column as text, or inferred types when ``infer_schema``.
    """
    reader = spark.read.option("header", str(header).lower()).option("sep", sep).option("mode", "PERMISSIVE")
    if schema is None:
        return reader.option("inferSchema", str(infer_schema).lower()).csv(path)
    return align_to(reader.option("inferSchema", "false").csv(path), schema, keep_undeclared=True, rescued=rescued)


def with_lineage(df: DataFrame, source_file: str, loaded_at: datetime | None = None) -> DataFrame:
    """Load timestamp and the constant source file name.  A run passes one
    ``loaded_at`` to all its tables; without it the query's own start counts."""
    stamp = F.current_timestamp() if loaded_at is None else F.lit(loaded_at)
    return df.withColumns({"ingestion_timestamp": stamp, "source_file": F.lit(source_file)})


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "snappy") -> None:
    """S3: full load - replaces everything at ``path``."""
    df.write.mode(mode).option("compression", compression).parquet(path)


def write_observed(df: DataFrame, path: str, metrics: Mapping[str, Column] | None = None, **kw) -> dict:
    """Write and return the number of rows written (``rows``) and the metrics, measured in the same job."""
    out, values = observed(df, metrics)
    write_parquet(out, path, **kw)
    return values()


def bronze_path(base: str, table: str) -> str:
    return f"{base.rstrip('/')}/{table}/parquet"


@dataclass(frozen=True)
class IngestResult:
    table: str
    source_file: str
    path: str
    rows: int
    rejected: Mapping[str, int] = field(default_factory=dict)  # values that failed their declared type, by column


def ingest_file(
    spark: SparkSession,
    source_dir: str,
    source: SourceFile,
    target_base: str,
    schema: T.StructType | None = None,
    infer_schema: bool = False,
    rebalance: bool = False,
    loaded_at: datetime | None = None,
    rescue: bool = True,
    table: str | None = None,
    bucket_by: tuple[str, int] | None = None,
) -> IngestResult:
    """S1+S2+S3 for one file: read, add lineage, write Parquet, count in the same job.

    With a declared schema and ``rescue``, the text of values that fail their declared type is
    kept in the column ``rescued_values`` and counted per column.  The files go to the table's
    folder; with ``bucket_by`` (column, number) they go through the declared ``table``, one file a bucket.

    ``rebalance=True`` adds a rebalancing shuffle before the write (adaptive
    execution splits oversized partitions and merges tiny ones): for sources
    that cannot be split on read (e.g. one large gzip file) so that encoding and
    writing do not run in a single task.  Splittable sources need no shuffle.
    """
    rescued = RESCUED if rescue and schema is not None else None
    path = f"{source_dir.rstrip('/')}/{source.file}"
    df = read_delimited(spark, path, schema, infer_schema=infer_schema, rescued=rescued)
    if rebalance:
        df = df.hint("rebalance")
    df = with_lineage(df, source.file, loaded_at)
    metrics = rejected_counts(schema) if rescued else {}
    target = bronze_path(target_base, source.table)
    if bucket_by:
        found = overwrite_table(df.repartition(bucket_by[1], bucket_by[0]), table, metrics, evolve=True)
    else:
        found = write_observed(df, target, metrics)
    rejected = {name.split(".", 1)[1]: n for name, n in found.items() if name != "rows" and n}
    return IngestResult(source.table, source.file, target, found["rows"], rejected)


def stage_delimited(df: DataFrame, path: str) -> None:
    """Write ``df`` as a header-first CSV folder exactly as given (no whitespace
    trimming, NULL as an empty field, '' as ``""``).  Used to produce source
    files from tables for tests and the registered ingest queries."""
    (
        df.write.mode("overwrite")
        .option("header", "true")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )
