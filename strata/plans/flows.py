"""Layer flows: bronze ingest -> gate, silver builds -> gate, load audit.

One Spark application, one session: each table is one lazy plan written by
one job.  What a run must know about its rows (counts, rejected values, NULLs)
is observed in that job; the measure profile and the checks that need a shuffle read columns of the written
table again.  Audit and
quality report are tables partitioned by run and layer: a run that is repeated under its id
replaces its rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import quality, registry, scd
from ..session import scratch_path
from ..sources import catalog, ingest, sinks
from . import dimensions as dims
from . import facts
from .schemas import BRONZE, FACTS_KEYED, RESCUED, SILVER, bronze_file_schema

# Minimum accepted rows per bronze table.
MIN_ROWS = {"demographics": 7000, "location": 7000, "population": 1600, "services": 7000, "status": 7000}

SILVER_COMMENTS = {
    "dim_customer": "Who the customers are: one member per customer id, standardized demographics.",
    "dim_service_package": "Distinct combinations of booked services, contract and payment, keyed by their hash.",
    "dim_location": "Where customers live: one member per ZIP with city, coordinates and population.",
    "dim_churn_status": "Distinct combinations of customer status and churn reasons, keyed by their hash.",
    "dim_quarter": "Quarters found in the sources, with the business year and half-year.",
    "dim_promotion": "Distinct combinations of offer and referral, keyed by their hash.",
    "facts_base": "Typed measures of each customer and quarter.",
}


@dataclass
class WarehouseConfig:
    source_dir: str  # folder holding the delimited source files
    bronze_base: str  # bronze Parquet root: {bronze_base}/{table}/parquet
    silver_base: str  # silver table root: {silver_base}/{table}
    # fixed values: the layer databases' default names
    bronze_db: str = "bronze_telco"
    silver_db: str = "silver_telco"
    # database folders (managed tables such as the audit table live there);
    # None = the session's warehouse folder
    bronze_db_location: str | None = None
    silver_db_location: str | None = None
    sources: tuple = ingest.DEFAULT_SOURCES
    min_rows: Mapping[str, int] = field(default_factory=lambda: dict(MIN_ROWS))
    business_year: int = dims.BUSINESS_YEAR
    # T4: False = as coded (a YES flag wins); True = a recognised connection type wins
    prefer_internet_type: bool = False
    facts_join_on: tuple = ("customer_id",)
    # explicit hot-customer split for the fact join (None: adaptive skew join only)
    facts_hot_key_fraction: float | None = None
    # rebalance unsplittable source files before writing them (see ingest.ingest_file)
    rebalance_sources: bool = False
    audit_table: str | None = None  # e.g. "silver_telco.load_audit"
    # long-form quality reports of the runs, ``quality_report`` in the layer's database; False: none
    quality_reports: bool = True
    report_table: str | None = None  # another name for the silver report
    # keep the text of bronze values that fail their declared type (column rescued_values)
    rescue_values: bool = True
    # status, services and facts hashed and sorted by customer into this many buckets, or more where the source
    # files are large (BUCKET_BYTES): the fact join and the duplicate check then need no shuffle
    customer_buckets: int | None = None
    # facts in one folder per quarter; ``rebuild_quarters`` replaces single ones
    facts_by_quarter: bool = False
    # location as SCD type 1: members keep their keys, a new version is checked before it is published
    location_scd1: bool = False
    # stable customer keys from this registry table, e.g. "silver_telco.customer_registry"
    customer_registry: str | None = None
    # also write facts_keyed: facts with the keys of their dimensions (grain-safe join)
    keyed_facts: bool = False
    # paperless billing as an attribute of the service package
    paperless_billing: bool = False
    # independent tables/files are submitted from this many driver threads, so
    # small jobs fill the slots big ones leave idle (the scheduler interleaves them)
    parallel_jobs: int = 4


def run_all(tasks: Mapping[str, Callable[[], object]], parallel: int) -> dict[str, object]:
    """Run independent Spark jobs, ``parallel`` at a time; results by name, in order."""
    if parallel <= 1 or len(tasks) <= 1:
        return {k: fn() for k, fn in tasks.items()}
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        futures = {k: pool.submit(fn) for k, fn in tasks.items()}
        return {k: f.result() for k, f in futures.items()}


AUDIT_SCHEMA = (
    "table_name string, row_count bigint, rejected_values bigint, unparsable_quarters bigint, status string, "
    "loaded_at timestamp, run_id string, layer string"
)
REPORT_SCHEMA = "check_name string, table_name string, column_name string, value double, run_id string, layer string"
BY_RUN = ("run_id", "layer")


def _audit_rows(
    spark: SparkSession,
    run_id: str,
    layer: str,
    counts: Mapping[str, int],
    status: str,
    rejected: Mapping[str, int] | None = None,
    unparsable: Mapping[str, int] | None = None,
) -> DataFrame:
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    known = lambda found, t: int((found or {}).get(t, 0))
    rows = [(t, int(n), known(rejected, t), known(unparsable, t), status, now, run_id, layer) for t, n in counts.items()]
    return spark.createDataFrame(rows, AUDIT_SCHEMA)


def write_run(rows: DataFrame, table: str, cfg: WarehouseConfig) -> None:
    """Write one run's rows to a table partitioned by run and layer (created on first use, in the
    folder configured for its database); rows of the same run and layer are replaced."""
    spark = rows.sparkSession
    if "." in table:
        db = table.rsplit(".", 1)[0]
        locations = {cfg.bronze_db: cfg.bronze_db_location, cfg.silver_db: cfg.silver_db_location}
        catalog.create_database(spark, db, locations.get(db))
    catalog.create_table(spark, table, rows.schema, None, partition_by=BY_RUN)
    sinks.overwrite_partitions(rows.coalesce(1), table)


def record_audit(spark: SparkSession, audit: DataFrame, cfg: WarehouseConfig) -> None:
    """O3: the run's rows in the audit table."""
    if cfg.audit_table:
        write_run(audit, cfg.audit_table, cfg)


def _report_rows(spark: SparkSession, rows: list[tuple], run_id: str, layer: str) -> DataFrame:
    return spark.createDataFrame([(*r, run_id, layer) for r in rows], REPORT_SCHEMA)


# ---------------------------------------------------------------- bronze
# bronze tables that are joined by customer, and the columns whose NULLs are counted
JOINED_BY_CUSTOMER = ("status", "services")
BRONZE_KEYS = {
    "demographics": ("customer_id",), "location": ("customer_id", "zip_code"), "population": ("zip_code",),
    "services": ("customer_id", "quarter"), "status": ("customer_id", "quarter"),
}


# Bytes of source text a bucket at most, of status and services each.  A bucket is sorted by one task when it is
# written, and the fact join multiplies its rows: some 100,000 rows a bucket and side.
BUCKET_BYTES = 16 << 20


def _bucket_number(spark: SparkSession, cfg: WarehouseConfig) -> int:
    """Buckets of the tables hashed by customer: that of a table that exists, so that all of them agree, or
    ``customer_buckets`` doubled until the larger source file has at most ``BUCKET_BYTES`` a bucket."""
    for t in JOINED_BY_CUSTOMER:
        if n := catalog.bucket_count(spark, f"{cfg.bronze_db}.{t}"):
            return n
    files = [f"{cfg.source_dir.rstrip('/')}/{s.file}" for s in cfg.sources if cfg.source_dir and s.table in JOINED_BY_CUSTOMER]
    largest = max((sinks.folder_bytes(spark, f) for f in files), default=0)
    n = cfg.customer_buckets
    while n * BUCKET_BYTES < largest:
        n *= 2
    return n


def _buckets(spark: SparkSession, cfg: WarehouseConfig, table: str) -> tuple[str, int] | None:
    by_customer = table in JOINED_BY_CUSTOMER or table == "facts_base" and not cfg.facts_by_quarter
    return ("customer_id", _bucket_number(spark, cfg)) if cfg.customer_buckets and by_customer else None


def create_bronze_tables(spark: SparkSession, cfg: WarehouseConfig) -> None:
    """Database plus one declared external table per source file."""
    catalog.create_database(spark, cfg.bronze_db, cfg.bronze_db_location)
    for s in cfg.sources:
        name = f"{cfg.bronze_db}.{s.table}"
        schema = T.StructType([*BRONZE[s.table].fields, *([RESCUED] if cfg.rescue_values else [])])
        path = ingest.bronze_path(cfg.bronze_base, s.table)
        if not catalog.create_table(spark, name, schema, path, bucket_by=_buckets(spark, cfg, s.table)):
            catalog.add_columns(spark, name, schema)
        catalog.refresh(spark, name)


def bronze_tables(spark: SparkSession, cfg: WarehouseConfig) -> dict[str, DataFrame]:
    return {s.table: spark.table(f"{cfg.bronze_db}.{s.table}") for s in cfg.sources}


def bronze_report(tables: Mapping[str, DataFrame], rejected: Mapping[str, Mapping[str, int]]) -> list[tuple]:
    """Checks of a bronze load in long form: rejected values per column (counted while writing), NULLs in
    the key columns and references to customers and ZIPs that the other files lack."""
    rows = [("rejected_values", t, c, float(n)) for t, columns in rejected.items() for c, n in sorted(columns.items())]
    for t, columns in BRONZE_KEYS.items():
        found = quality.null_counts(tables[t], columns).first()
        rows += [("null_count", t, c, float(found[c] or 0)) for c in columns]
    trimmed = {t: tables[t].select(F.trim("customer_id").alias("k")) for t in ("demographics", *JOINED_BY_CUSTOMER)}
    zips = {"location": dims.clean_location(tables["location"]), "population": dims.parse_population(tables["population"])}
    links = quality.referential_integrity(
        {
            "status": (trimmed["status"], "k", trimmed["demographics"], "k"),
            "services": (trimmed["services"], "k", trimmed["demographics"], "k"),
            "location": (zips["location"], "zip_code", zips["population"], "zip_code"),
        }
    )
    column = {"status": "customer_id", "services": "customer_id", "location": "zip_code"}
    return rows + [("orphan_rows", r["check_name"], column[r["check_name"]], float(r["orphan_rows"])) for r in links.collect()]


def run_bronze(spark: SparkSession, cfg: WarehouseConfig, enforce: bool = True, run_id: str | None = None) -> DataFrame:
    """O1: declare tables, ingest every file, refresh, report, then the minimum-row gate
    (on the row counts measured while writing; raises once, naming every table
    below its minimum).  Returns the audit rows of the run (also in ``cfg.audit_table``, where a load
    that raises leaves rows too)."""
    run_id = run_id or uuid.uuid4().hex
    create_bronze_tables(spark, cfg)
    loaded_at = datetime.now(timezone.utc)  # one timestamp for the five tables
    tasks = {
        s.table: (lambda s=s: ingest.ingest_file(
            spark, cfg.source_dir, s, cfg.bronze_base, bronze_file_schema(s.table), rebalance=cfg.rebalance_sources,
            loaded_at=loaded_at, rescue=cfg.rescue_values, table=f"{cfg.bronze_db}.{s.table}",
            bucket_by=_buckets(spark, cfg, s.table)))
        for s in cfg.sources
    }
    try:
        with sinks.compiled_methods(spark):
            results = run_all(tasks, cfg.parallel_jobs)
        for s in cfg.sources:
            catalog.refresh(spark, f"{cfg.bronze_db}.{s.table}")
        rejected = {t: r.rejected for t, r in results.items()}
        if cfg.quality_reports:
            report = bronze_report(bronze_tables(spark, cfg), rejected)
            write_run(_report_rows(spark, report, run_id, "bronze"), f"{cfg.bronze_db}.quality_report", cfg)
    except Exception:
        # a load that raises leaves a record too; -1 rows: not known
        record_audit(spark, _audit_rows(spark, run_id, "bronze", dict.fromkeys(tasks, -1), "failed"), cfg)
        raise
    counts = {t: r.rows for t, r in results.items()}
    failed = {t for t, n in counts.items() if n < cfg.min_rows.get(t, 0)}
    sums = {t: sum(columns.values()) for t, columns in rejected.items()}
    audit = _audit_rows(spark, run_id, "bronze", counts, "failed" if failed else "success", sums)
    record_audit(spark, audit, cfg)
    if enforce and failed:  # counts were measured in the write jobs: no re-count
        details = "; ".join(f"{t}: {counts[t]} < {cfg.min_rows[t]}" for t in sorted(failed))
        raise quality.DataQualityError(f"bronze minimum rows failed: {details}")
    return audit


# ---------------------------------------------------------------- silver
def silver_builders(cfg: WarehouseConfig) -> dict[str, Callable[[Mapping[str, DataFrame]], DataFrame]]:
    """Seven independent lazy builders over the bronze frames (no order among them)."""
    return {
        "dim_customer": lambda b: dims.dim_customer(b["demographics"]),
        "dim_location": lambda b: dims.dim_location(b["location"], b["population"]),
        "dim_service_package": lambda b: dims.dim_service_package(
            b["services"], cfg.prefer_internet_type, cfg.paperless_billing),
        "dim_churn_status": lambda b: dims.dim_churn_status(b["status"]),
        "dim_quarter": lambda b: dims.dim_quarter(b["status"], cfg.business_year),
        "dim_promotion": lambda b: dims.dim_promotion(b["services"]),
        "facts_base": lambda b: facts.facts_base(b["status"], b["services"], cfg.facts_join_on,
                                                 cfg.facts_hot_key_fraction),
    }


def create_silver_tables(spark: SparkSession, cfg: WarehouseConfig) -> None:
    """Database plus the seven declared tables with their comments; a table that exists
    gains the declared columns that it lacks."""
    catalog.create_database(spark, cfg.silver_db, cfg.silver_db_location)
    for t, schema in SILVER.items():
        by = ("quarter",) if t == "facts_base" and cfg.facts_by_quarter else ()
        name, path = f"{cfg.silver_db}.{t}", f"{cfg.silver_base.rstrip('/')}/{t}"
        if not catalog.create_table(spark, name, schema, path, SILVER_COMMENTS[t], partition_by=by, bucket_by=_buckets(spark, cfg, t)):
            catalog.add_columns(spark, name, schema)


def _null(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def observed_checks(table: str) -> dict[str, Column]:
    """V4, V5 and the unparsable quarters (T3) as aggregates that the write job of ``table`` observes."""
    if table == "facts_base":
        return {f"null.{c}": _null(c) for c in facts.GRAIN}
    if table == "dim_location":
        return {f"null.{c}": _null(c) for c in LOCATION_KEY_COLUMNS}
    return {"unparsable": _null("quarter_key")} if table == "dim_quarter" else {}


def profile_checks(table: str) -> dict[str, Column]:
    """V6 as aggregates of one pass over the written ``table``.  Observed aggregates are interpreted row by
    row, which costs the write job of the facts more than this pass over their measures."""
    if table != "facts_base":
        return {}
    return {f"{stat}.{c}": column for c in PROFILED for stat, column in quality.profile_stats(c).items()}


def _publish_location(spark: SparkSession, cfg: WarehouseConfig, bronze: Mapping[str, DataFrame]) -> dict:
    """SCD type 1: one join classifies stored and incoming members and is staged, the staged rows
    are numbered, and the result is checked before it replaces the table's current version."""
    name = f"{cfg.silver_db}.dim_location"
    incoming = dims.location_members(bronze["location"], bronze["population"])
    staged = scratch_path(spark, "location-classified")
    classified = scd.scd1_classify(spark.table(name), incoming, ["zip_code"], "location_key")
    classified.write.parquet(staged)
    numbered = scd.scd1_number(spark.read.schema(classified.schema).parquet(staged), ["zip_code"], "location_key")

    def check(rows: DataFrame, metrics: dict) -> list[str]:
        wrong = [] if metrics["rows"] else ["no rows"]
        for column in ("location_key", "zip_code"):
            if n := quality.grain_duplicates(rows, [column]).first()[0]:
                wrong.append(f"{n} repeated values of {column}")
        return wrong

    return sinks.publish_table(dims.conform(numbered, "dim_location"), name, check, observed_checks("dim_location"))


def _registered_customers(spark: SparkSession, cfg: WarehouseConfig, bronze: Mapping[str, DataFrame], run_id: str) -> DataFrame:
    members = dims.clean_demographics(bronze["demographics"])
    schema = registry.registry_schema(members.schema, ["customer_id"], "customer_key")
    path = f"{cfg.silver_base.rstrip('/')}/{cfg.customer_registry.rsplit('.', 1)[-1]}"
    catalog.create_table(spark, cfg.customer_registry, schema, path, "Keys of all customers ever seen, given once.")
    registry.allocate(members, cfg.customer_registry, ["customer_id"], "customer_key", run_id)
    return dims.dim_customer_registered(bronze["demographics"], spark.table(cfg.customer_registry))


def run_silver(
    spark: SparkSession,
    cfg: WarehouseConfig,
    bronze: Mapping[str, DataFrame] | None = None,
    enforce: bool = True,
    run_id: str | None = None,
    only: tuple[str, ...] | None = None,
) -> DataFrame:
    """O2: build and write the seven tables (one job each, counts and checks observed
    in that job), then the non-empty gate over what was written.  ``only``
    rebuilds a subset (e.g. one dimension), like running a single table job."""
    run_id = run_id or uuid.uuid4().hex
    create_silver_tables(spark, cfg)
    bronze = bronze or bronze_tables(spark, cfg)
    builders = {t: b for t, b in silver_builders(cfg).items() if not only or t in only}

    def write(t: str, build: Callable) -> dict:
        if t == "dim_location" and cfg.location_scd1:
            return _publish_location(spark, cfg, bronze)
        df = _registered_customers(spark, cfg, bronze, run_id) if t == "dim_customer" and cfg.customer_registry else build(bronze)
        return sinks.overwrite_table(df, f"{cfg.silver_db}.{t}", observed_checks(t), evolve=True)

    tasks = {t: (lambda t=t, build=build: write(t, build)) for t, build in builders.items()}
    try:
        with sinks.compiled_methods(spark):
            found = run_all(tasks, cfg.parallel_jobs)
            if cfg.keyed_facts and not only:
                found["facts_keyed"] = _write_keyed_facts(spark, cfg, bronze)
        if cfg.quality_reports:
            report = silver_report(spark, cfg, {t: m for t, m in found.items() if t in ("facts_base", "dim_location")})
            table = cfg.report_table or f"{cfg.silver_db}.quality_report"
            if report:
                write_run(_report_rows(spark, report, run_id, "silver"), table, cfg)
    except Exception:
        # a build that raises leaves a record too; -1 rows: not known
        record_audit(spark, _audit_rows(spark, run_id, "silver", dict.fromkeys(tasks, -1), "failed"), cfg)
        raise
    counts = {t: m["rows"] for t, m in found.items()}
    empty = [t for t, n in counts.items() if n == 0]
    unparsable = {t: m.get("unparsable", 0) for t, m in found.items()}
    audit = _audit_rows(spark, run_id, "silver", counts, "failed" if empty else "success", unparsable=unparsable)
    record_audit(spark, audit, cfg)
    if enforce and empty:  # counts were measured in the write jobs: no re-count
        raise quality.DataQualityError(f"silver non-empty failed: {', '.join(sorted(empty))} empty")
    return audit


def _write_keyed_facts(spark: SparkSession, cfg: WarehouseConfig, bronze: Mapping[str, DataFrame]) -> dict:
    name = f"{cfg.silver_db}.facts_keyed"
    comment = "Typed measures of each customer and quarter with the keys of their dimensions."
    catalog.create_table(spark, name, FACTS_KEYED, f"{cfg.silver_base.rstrip('/')}/facts_keyed", comment)
    keyed = facts.facts_keyed(bronze["status"], bronze["services"], spark.table(f"{cfg.silver_db}.dim_customer"),
                              business_year=cfg.business_year, hot_key_fraction=cfg.facts_hot_key_fraction)
    return sinks.overwrite_table(keyed, name)


def rebuild_quarters(
    spark: SparkSession, cfg: WarehouseConfig, quarters: tuple[str, ...], bronze: Mapping[str, DataFrame] | None = None
) -> dict:
    """Rebuild the facts of single quarters (``facts_by_quarter``): the folders of all other
    quarters are neither read nor written.  A quarter is named as the facts hold it (trimmed)."""
    bronze = bronze or bronze_tables(spark, cfg)
    status = bronze["status"].filter(F.trim("quarter").isin(*quarters))
    rows = facts.facts_base(status, bronze["services"], cfg.facts_join_on, cfg.facts_hot_key_fraction)
    return sinks.overwrite_partitions(rows, f"{cfg.silver_db}.facts_base")


# The measures profiled after each fact build, and the location
# columns whose NULLs are counted.
PROFILED = ("tenure_months", "monthly_charges", "total_revenue", "cltv")
LOCATION_KEY_COLUMNS = ("location_key", "city", "zip_code", "latitude", "longitude")


STATS = ("count", "mean", "stddev", "min", "max")


def report_rows(table: str, metrics: Mapping[str, object]) -> list[tuple]:
    """V4-V6 of one table from its observed metrics: ``(check, table, column, value)``."""
    number = lambda x: None if x is None else float(x)
    nulls = [("null_count", table, k.split(".", 1)[1], number(v)) for k, v in metrics.items() if k.startswith("null.")]
    stats = [k.split(".", 1) for k in metrics if k.split(".", 1)[0] in STATS]
    return nulls + [(f"profile_{stat}", table, c, number(metrics[f"{stat}.{c}"])) for stat, c in stats]


def silver_report(spark: SparkSession, cfg: WarehouseConfig, found: Mapping[str, Mapping[str, object]]) -> list[tuple]:
    """V3-V6 in long form, 28 rows for a full run: what the write jobs observed, and the profile and the
    duplicate check, which read the measures and the grain columns of the written facts."""
    rows = []
    for t, metrics in found.items():
        if stats := profile_checks(t):
            written = spark.table(f"{cfg.silver_db}.{t}")
            values = written.agg(*[column.alias(f"m{i}") for i, column in enumerate(stats.values())]).first()
            metrics = {**metrics, **dict(zip(stats, values))}
        rows += report_rows(t, metrics)
    if "facts_base" in found:
        repeated = quality.grain_duplicates(spark.table(f"{cfg.silver_db}.facts_base"), facts.GRAIN).first()[0]
        rows.append(("grain_duplicates", "facts_base", ",".join(facts.GRAIN), float(repeated)))
    return rows


def quality_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The rows of ``silver_report`` for any frames of ``facts_base`` and ``dim_location``, as one
    aggregate pass each, ``(check_name, table_name, column_name, value)``."""
    parts = []
    for t, df in tables.items():
        metrics = observed_checks(t) | profile_checks(t)
        wide = df.agg(*[column.cast("double").alias(f"m{i}") for i, column in enumerate(metrics.values())])
        labels = report_rows(t, dict.fromkeys(metrics))
        order = [f"null.{c}" if check == "null_count" else f"{check.removeprefix('profile_')}.{c}" for check, _, c, _ in labels]
        at = {name: f"m{i}" for i, name in enumerate(metrics)}
        entries = [F.struct(F.lit(check).alias("check_name"), F.lit(t).alias("table_name"), F.lit(c).alias("column_name"),
                            F.col(at[name]).alias("value")) for (check, _, c, _), name in zip(labels, order)]
        parts.append(wide.select(F.inline(F.array(*entries))))
        if t == "facts_base":
            parts.append(quality.grain_duplicates(df, facts.GRAIN).select(
                F.lit("grain_duplicates").alias("check_name"), F.lit(t).alias("table_name"),
                F.lit(",".join(facts.GRAIN)).alias("column_name"), F.col("duplicate_groups").cast("double").alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def audit_view(audit: DataFrame) -> DataFrame:
    """Audit rows without the run-specific columns (for comparisons)."""
    return audit.select("layer", "table_name", "row_count", "rejected_values", "unparsable_quarters", "status")


__all__ = [
    "WarehouseConfig",
    "MIN_ROWS",
    "run_bronze",
    "run_silver",
    "rebuild_quarters",
    "create_bronze_tables",
    "create_silver_tables",
    "silver_builders",
    "record_audit",
    "audit_view",
]
