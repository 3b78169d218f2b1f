"""The registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the driver tables through the raw views (so its work grows
with the scale factor) and runs library operators over whole tables.  Queries
that exercise writes (ingest, catalog, sinks, flows) write under a fresh
folder inside the session's checkpoint folder on every call.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import standard as std
from ..operators import quality
from ..operators.keys import sequential_key
from ..operators.relational import dedup_by_key, distinct_with_ratio, rename_columns, typed_measures
from ..session import scratch_path
from ..sources import catalog, ingest, sinks
from ..sources.raw_views import SUBJECTS, raw_view
from . import dimensions as dims
from . import facts, flows
from .schemas import SILVER, bronze_file_schema

Query = Callable[[SparkSession, str], DataFrame]

POPULATION_FILE = "Telco_customer_churn_population.csv"


def _raw(spark: SparkSession, sf: str, *subjects: str) -> list[DataFrame]:
    return [raw_view(spark, sf, s) for s in subjects]


def _silver_rows(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The rows of the silver tables for counting: numbering cannot change a
    count, so the two dimensions with a sequential key stay unnumbered."""
    raw = {s: raw_view(spark, sf, s) for s in SUBJECTS}
    unnumbered = {
        "dim_customer": lambda b: dims.clean_demographics(b["demographics"]),
        "dim_location": lambda b: dims.location_with_population(b["location"], b["population"]),
    }
    builders = flows.silver_builders(flows.WarehouseConfig("", "", "")) | unnumbered
    return {t: build(raw) for t, build in builders.items()}


# ================================================================ tables
def q_dim_customer(spark, sf):
    (d,) = _raw(spark, sf, "demographics")
    return dims.dim_customer(d)


def q_dim_location(spark, sf):
    loc, pop = _raw(spark, sf, "location", "population")
    return dims.dim_location(loc, pop)


def q_dim_location_scd1(spark, sf):
    """Yesterday's dimension covers ZIPs 50 higher and knows no population: today's build
    fills members of both in place (same keys), keeps those only yesterday had, and
    numbers new ones after the largest key."""
    loc, pop = _raw(spark, sf, "location", "population")
    higher = F.lpad((F.col("zip_code").try_cast("int") + 50).cast("string"), 5, "0")
    stale = dims.dim_location(loc, pop).withColumns(
        {"zip_code": higher, "population": F.lit(None).cast("int"), "population_density": F.lit("Rural")}
    )
    return dims.dim_location_scd1(stale, loc, pop)


def q_dim_service_package(spark, sf):
    (s,) = _raw(spark, sf, "services")
    return dims.dim_service_package(s)


def q_dim_churn_status(spark, sf):
    (s,) = _raw(spark, sf, "status")
    return dims.dim_churn_status(s)


def q_dim_promotion(spark, sf):
    (s,) = _raw(spark, sf, "services")
    return dims.dim_promotion(s)


def q_dim_quarter(spark, sf):
    (s,) = _raw(spark, sf, "status")
    return dims.dim_quarter(s)


def q_facts_base(spark, sf):
    st, sv = _raw(spark, sf, "status", "services")
    return facts.facts_base(st, sv)


def q_facts_base_hot_split(spark, sf):
    """``facts_base`` with the explicit split: every customer above the fraction on
    either side is joined in a grid of cells."""
    st, sv = _raw(spark, sf, "status", "services")
    return facts.facts_base(st, sv, hot_key_fraction=0.001)


def q_facts_base_grain_safe(spark, sf):
    st, sv = _raw(spark, sf, "status", "services")
    return facts.facts_base_grain_safe(st, sv)


def _facts_keyed(spark, sf):
    d, st, sv = _raw(spark, sf, "demographics", "status", "services")
    return facts.facts_keyed(st, sv, dims.dim_customer(d))


def q_facts_keyed(spark, sf):
    return _facts_keyed(spark, sf)


def q_dq_fact_dimension_keys(spark, sf):
    path = scratch_path(spark, "facts-keyed")
    ingest.write_parquet(_facts_keyed(spark, sf), path)  # the fact table is written, then checked
    fk = spark.read.parquet(path)
    d, st, sv = _raw(spark, sf, "demographics", "status", "services")
    dimensions = {
        "customer_key": dims.dim_customer(d),
        "quarter_key": dims.dim_quarter(st),
        "service_package_key": dims.dim_service_package(sv),
        "promotion_key": dims.dim_promotion(sv),
        "churn_status_key": dims.dim_churn_status(st),
    }
    return quality.referential_integrity({k: (fk, k, dim, k) for k, dim in dimensions.items()})


# ================================================================ rules
def q_standardize_flags(spark, sf):
    (s,) = _raw(spark, sf, "services")
    cols = {
        "phone_service": std.PHONE_SERVICE.apply("phone_service"),
        "multiple_lines": std.MULTIPLE_LINES.apply("multiple_lines"),
        **{out: std.ADD_ON.apply(src) for out, src in std.ADD_ON_COLUMNS},
        "referred_a_friend": std.REFERRED_A_FRIEND.apply("referred_a_friend"),
    }
    return s.select("customer_id", "quarter", *[c.alias(n) for n, c in cols.items()])


def q_standardize_membership(spark, sf):
    (d,) = _raw(spark, sf, "demographics")
    return dims.clean_demographics(d).select("customer_id", "gender", "marital_status")


def q_standardize_substring(spark, sf):
    (s,) = _raw(spark, sf, "services")
    return s.select(
        "customer_id",
        "quarter",
        std.CONTRACT.apply("contract").alias("contract"),
        std.PAYMENT_METHOD.apply("payment_method").alias("payment_method"),
        std.OFFER.apply("offer").alias("offer"),
    )


def q_standardize_internet(spark, sf):
    (s,) = _raw(spark, sf, "services")
    return s.select(
        "customer_id",
        "quarter",
        std.internet_service("internet_service", "internet_type").alias("internet_service"),
        std.internet_service("internet_service", "internet_type", prefer_type=True).alias("internet_service_by_type"),
    )


def q_bucket_age(spark, sf):
    (d,) = _raw(spark, sf, "demographics")
    return dims.clean_demographics(d).select("customer_id", "age", "age_group")


def q_bucket_density(spark, sf):
    (p,) = _raw(spark, sf, "population")
    return dims.clean_population(p).withColumn("population_density", std.population_density("population"))


def _package_rows(spark, sf):
    (s,) = _raw(spark, sf, "services")
    return dims.derive_package(dims.standardize_services(s, keep=("customer_id", "quarter")))


def q_bucket_service_tier(spark, sf):
    return _package_rows(spark, sf).select("customer_id", "quarter", "total_services", "service_tier")


def q_derive_bundle_type(spark, sf):
    return _package_rows(spark, sf).select("customer_id", "quarter", "phone_service", "internet_service", "bundle_type")


def q_derive_total_services(spark, sf):
    return _package_rows(spark, sf).select("customer_id", "quarter", *std.ADD_ONS, "total_services")


def q_derive_family_size(spark, sf):
    (d,) = _raw(spark, sf, "demographics")
    return dims.clean_demographics(d).select("customer_id", "marital_status", "number_of_dependents", "family_size")


def q_clean_location(spark, sf):
    (loc,) = _raw(spark, sf, "location")
    return dims.clean_location(loc, keep=("customer_id",))


def q_clean_population(spark, sf):
    (p,) = _raw(spark, sf, "population")
    return dims.parse_population(p, keep=("id",))


# ================================================================ relational
def q_project_rename(spark, sf):
    (s,) = _raw(spark, sf, "services")
    return rename_columns(s, {"tenure_in_months": "tenure_months", "monthly_charge": "monthly_charges"},
                          keep=("customer_id", "quarter"))


def q_cast_measures(spark, sf):
    (s,) = _raw(spark, sf, "services")
    service_measures = [m for m in facts.MEASURES if m.name not in facts.STATUS_MEASURES]
    return s.select("customer_id", "quarter", *typed_measures(service_measures))


def q_filter_valid_coordinates(spark, sf):
    (loc,) = _raw(spark, sf, "location")
    return dims.valid_coordinates(dims.clean_location(loc, keep=("customer_id",)))


def q_location_population_join(spark, sf):
    loc, pop = _raw(spark, sf, "location", "population")
    return dims.location_with_population(loc, pop)


def q_dedup_by_key(spark, sf):
    (loc,) = _raw(spark, sf, "location")
    return dedup_by_key(loc, ["zip_code"])


def q_dedup_ratio(spark, sf):
    (s,) = _raw(spark, sf, "services")
    return distinct_with_ratio(dims.standardize_services(s))


# ================================================================ keys
def q_seq_key_customer(spark, sf):
    (d,) = _raw(spark, sf, "demographics")
    return sequential_key(dims.clean_demographics(d), ["customer_id"], "customer_key").select(
        "customer_key", "customer_id"
    )


def q_seq_key_location(spark, sf):
    loc, pop = _raw(spark, sf, "location", "population")
    return sequential_key(dims.location_with_population(loc, pop), ["zip_code"], "location_key").select(
        "location_key", "zip_code"
    )


def q_hash_key_service_package(spark, sf):
    (s,) = _raw(spark, sf, "services")
    return dims.dim_service_package(s)


def q_hash_key_churn_status(spark, sf):
    (s,) = _raw(spark, sf, "status")
    return dims.dim_churn_status(s)


def q_hash_key_promotion(spark, sf):
    (s,) = _raw(spark, sf, "services")
    return dims.dim_promotion(s)


# ================================================================ quality
def q_dq_min_rows(spark, sf):
    raw = {s: raw_view(spark, sf, s) for s in SUBJECTS}
    return quality.min_rows(raw, flows.MIN_ROWS)


def q_dq_non_empty(spark, sf):
    return quality.non_empty(_silver_rows(spark, sf))


def q_dq_grain_duplicates(spark, sf):
    return quality.grain_duplicates(q_facts_base(spark, sf), facts.GRAIN)


def q_dq_null_counts(spark, sf):
    return quality.null_counts(q_facts_base(spark, sf), list(facts.GRAIN))


def q_dq_location_null_keys(spark, sf):
    loc, pop = _raw(spark, sf, "location", "population")
    return quality.null_counts(
        dims.dim_location(loc, pop),
        ["location_key", "city", "zip_code", "latitude", "longitude"],
        ["null_keys", "null_cities", "null_zips", "null_lat", "null_long"],
    )


def q_dq_key_unique(spark, sf):
    st, sv = _raw(spark, sf, "status", "services")
    return quality.key_uniqueness(
        {
            "dim_service_package": (dims.dim_service_package(sv), "service_package_key"),
            "dim_churn_status": (dims.dim_churn_status(st), "churn_status_key"),
            "dim_promotion": (dims.dim_promotion(sv), "promotion_key"),
        }
    )


def q_dq_referential_integrity(spark, sf):
    d, st, sv, loc, pop = _raw(spark, sf, "demographics", "status", "services", "location", "population")
    customers = d.select(F.trim("customer_id").alias("customer_id"))
    return quality.referential_integrity(
        {
            "status_customer": (st.select(F.trim("customer_id").alias("k")), "k", customers, "customer_id"),
            "services_customer": (sv.select(F.trim("customer_id").alias("k")), "k", customers, "customer_id"),
            "location_zip": (dims.clean_location(loc), "zip_code", dims.parse_population(pop), "zip_code"),
        }
    )


def q_dq_type_consistency(spark, sf):
    (p,) = _raw(spark, sf, "population")
    src = scratch_path(spark, "sources")
    ingest.stage_delimited(p, f"{src}/{POPULATION_FILE}")
    text = ingest.read_delimited(spark, f"{src}/{POPULATION_FILE}")  # every column as text
    return quality.type_consistency(text, {"id": "int", "zip_code": "int", "population": "int"})


PROFILED = flows.PROFILED


def q_profile_measures(spark, sf):
    return quality.profile(q_facts_base(spark, sf), PROFILED)


def q_layer_row_counts(spark, sf):
    raw = {s: raw_view(spark, sf, s) for s in SUBJECTS}
    bronze = quality.row_counts(raw).withColumn("layer", F.lit("bronze"))
    silver = quality.row_counts(_silver_rows(spark, sf)).withColumn("layer", F.lit("silver"))
    return bronze.unionByName(silver).select("layer", "table_name", "row_count")


# ================================================================ bronze, catalog, flows
# Values that their declared type rejects, put into the source files: table -> column, the rows that get one, the text
DIRT = {
    "demographics": ("age", "number_of_dependents = 3", "unknown"),
    "services": ("total_charges", "tenure_in_months = 7", "12,50"),
    "status": ("cltv", "satisfaction_score = 5", "99999999999"),
}


def _stage_sources(spark, sf, dirty: bool = False) -> str:
    """Write each raw subject as its delimited source file into a fresh folder, side by side."""
    folder = scratch_path(spark, "sources")

    def stage(s: ingest.SourceFile) -> None:
        rows = raw_view(spark, sf, s.table)
        if dirty and s.table in DIRT:
            column, where, text = DIRT[s.table]
            rows = rows.withColumn(column, F.when(F.expr(where), text).otherwise(F.col(column).cast("string")))
        ingest.stage_delimited(rows, f"{folder}/{s.file}")

    flows.run_all({s.table: (lambda s=s: stage(s)) for s in ingest.DEFAULT_SOURCES}, len(ingest.DEFAULT_SOURCES))
    return folder


def _config(spark, sf, stage: bool = True, dirty: bool = False, **options) -> flows.WarehouseConfig:
    root = scratch_path(spark, "warehouse")
    tag = root.rsplit("-", 1)[-1]
    return flows.WarehouseConfig(
        source_dir=_stage_sources(spark, sf, dirty) if stage else "",
        bronze_base=f"{root}/bronze",
        silver_base=f"{root}/silver",
        bronze_db=f"bronze_{tag}",
        silver_db=f"silver_{tag}",
        bronze_db_location=f"{root}/bronze_db",
        silver_db_location=f"{root}/silver_db",
        audit_table=f"silver_{tag}.load_audit",
        **options,
    )


def _digests(tables: dict[str, DataFrame], left_out: tuple[str, ...] = ()) -> DataFrame:
    parts = [
        df.agg(quality.content_digest(df, [c for c in df.columns if c not in left_out]).alias("content_digest"))
        .select(F.lit(t).alias("table_name"), "content_digest")
        for t, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_bronze_lineage_columns(spark, sf):
    (p,) = _raw(spark, sf, "population")
    return ingest.with_lineage(p, POPULATION_FILE).drop("ingestion_timestamp")


def q_bronze_roundtrip(spark, sf):
    (s,) = _raw(spark, sf, "services")
    path = scratch_path(spark, "bronze-services")
    ingest.write_parquet(ingest.with_lineage(s, "Telco_customer_churn_services.csv"), path)
    return spark.read.parquet(path).drop("ingestion_timestamp")


def q_bronze_ingest_population(spark, sf):
    (p,) = _raw(spark, sf, "population")
    src = scratch_path(spark, "sources")
    ingest.stage_delimited(p, f"{src}/{POPULATION_FILE}")
    target = scratch_path(spark, "bronze")
    res = ingest.ingest_file(
        spark, src, ingest.SourceFile(POPULATION_FILE, "population"), target, bronze_file_schema("population")
    )
    return spark.read.parquet(res.path).drop("ingestion_timestamp", "rescued_values")


def q_bronze_ingest_all(spark, sf):
    """All five files loaded, some with values that their type rejects: the minimum-row report, a digest of
    the loaded rows and the number of rejected values of each table."""
    cfg = _config(spark, sf, dirty=True)
    audit = flows.run_bronze(spark, cfg, enforce=False)
    loaded = {}
    for t, df in flows.bronze_tables(spark, cfg).items():
        kept = [c for c in raw_view(spark, sf, t).columns]
        rescued = F.coalesce(F.array_join(F.map_values("rescued_values"), ","), F.lit("")).alias("rescued")
        loaded[t] = df.select(*kept, "source_file", rescued)
    rejected = audit.select("table_name", "rejected_values")
    report = quality.min_rows(loaded, cfg.min_rows)
    return report.join(_digests(loaded), "table_name").join(rejected, "table_name")


def q_bronze_quality_report(spark, sf):
    """The report that a bronze run writes: rejected values, NULL keys, references that lead nowhere."""
    cfg = _config(spark, sf, dirty=True)
    flows.run_bronze(spark, cfg, enforce=False)
    return spark.table(f"{cfg.bronze_db}.quality_report").drop("run_id", "layer")


def q_catalog_tables(spark, sf):
    cfg = _config(spark, sf, quality_reports=False)
    flows.run_bronze(spark, cfg, enforce=False)
    info = catalog.table_info(spark, cfg.bronze_db)
    with catalog.current_database(spark, cfg.bronze_db):  # unqualified names resolve in the bronze database
        tables = {name: spark.table(name) for name, _, _ in info}
    counts = quality.row_counts(tables)
    kinds = spark.createDataFrame([(n, k) for n, k, _ in info], "table_name string, table_type string")
    return counts.join(F.broadcast(kinds), "table_name").select("table_name", "table_type", "row_count")


def q_catalog_data_dictionary(spark, sf):
    cfg = _config(spark, sf, stage=False)
    flows.run_silver(spark, cfg, bronze={s: raw_view(spark, sf, s) for s in SUBJECTS}, enforce=False)
    dictionary = catalog.data_dictionary(spark, cfg.silver_db, list(SILVER))
    filled = []
    for t, schema in SILVER.items():
        df = spark.table(f"{cfg.silver_db}.{t}")
        wide = df.agg(*[F.count(F.col(f.name)).cast("long").alias(f.name) for f in schema.fields])
        filled.append(
            wide.select(
                F.explode(
                    F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.col(f.name).alias("non_null_count"))
                              for f in schema.fields])
                ).alias("c")
            ).select(F.lit(t).alias("table_name"), "c.*")
        )
    counts = filled[0]
    for f_ in filled[1:]:
        counts = counts.unionByName(f_)
    return dictionary.join(counts, ["table_name", "column_name"]).select(
        "table_name", "column_name", "data_type", "comment", "non_null_count"
    )


def q_silver_write_keeps_schema(spark, sf):
    cfg = _config(spark, sf, stage=False)
    catalog.create_database(spark, cfg.silver_db, cfg.silver_db_location)
    name = f"{cfg.silver_db}.dim_customer"
    catalog.create_table(spark, name, SILVER["dim_customer"], f"{cfg.silver_base}/dim_customer")
    (d,) = _raw(spark, sf, "demographics")
    sinks.overwrite_table(dims.dim_customer(d), name)
    written = spark.table(name)
    declared = [(f.name, f.dataType, f.metadata.get("comment")) for f in SILVER["dim_customer"].fields]
    got = [(f.name, f.dataType, f.metadata.get("comment")) for f in written.schema.fields]
    if got != declared:
        raise AssertionError(f"declared schema not kept: {got}")
    return written


HASH_KEYS = ("service_package_key", "promotion_key", "churn_status_key")


def q_silver_build_all(spark, sf):
    cfg = _config(spark, sf, stage=False)
    audit = flows.run_silver(spark, cfg, bronze={s: raw_view(spark, sf, s) for s in SUBJECTS}, enforce=True)
    return audit.select("table_name", "row_count", "status")


def q_silver_build_content(spark, sf):
    """Digests of the rows of the seven tables as the silver flow wrote them."""
    cfg = _config(spark, sf, stage=False)
    flows.run_silver(spark, cfg, bronze={s: raw_view(spark, sf, s) for s in SUBJECTS}, enforce=True)
    return _digests({t: spark.table(f"{cfg.silver_db}.{t}") for t in SILVER}, HASH_KEYS)


def q_silver_quality_report(spark, sf):
    """The silver flow's quality report, read back from the report table."""
    cfg = _config(spark, sf, stage=False)
    flows.run_silver(spark, cfg, bronze={s: raw_view(spark, sf, s) for s in SUBJECTS}, enforce=False)
    return spark.table(f"{cfg.silver_db}.quality_report").drop("run_id", "layer")


def q_load_audit(spark, sf):
    """Both layers run, the second time under the same run ids: the audit holds one set of rows."""
    cfg = _config(spark, sf, dirty=True)
    for _ in range(2):
        flows.run_bronze(spark, cfg, enforce=False, run_id="b")
        flows.run_silver(spark, cfg, enforce=False, run_id="s")
    return flows.audit_view(spark.table(cfg.audit_table))


def q_silver_location_scd1(spark, sf):
    """Two silver runs with location as SCD type 1.  In the first one all ZIPs are 50 higher and no population is
    known; the second one fills members of both in place, keeps the others and numbers new ones."""
    cfg = _config(spark, sf, stage=False, location_scd1=True)
    loc, pop = _raw(spark, sf, "location", "population")
    before = {"location": loc.withColumn("zip_code", F.col("zip_code") + 50), "population": pop.withColumn("zip_code", F.lit(None).cast("int"))}
    for bronze in (before, {"location": loc, "population": pop}):
        flows.run_silver(spark, cfg, bronze=bronze, only=("dim_location",))
    return spark.table(f"{cfg.silver_db}.dim_location")


def q_dim_customer_registry(spark, sf):
    """Customers with stable keys over two silver runs.  In the first one all customer numbers are 50 higher: of
    today's customers those known keep their keys, the others get keys after the largest."""
    cfg = _config(spark, sf, stage=False)
    cfg.customer_registry = f"{cfg.silver_db}.customer_registry"
    (d,) = _raw(spark, sf, "demographics")
    number = F.regexp_extract("customer_id", r"(\d+)", 1).cast("long") + 50
    before = d.withColumn("customer_id", F.concat(F.lit("Customer#"), F.lpad(number.cast("string"), 9, "0")))
    for demographics in (before, d):
        flows.run_silver(spark, cfg, bronze={"demographics": demographics}, only=("dim_customer",))
    return spark.table(f"{cfg.silver_db}.dim_customer")


def q_facts_by_quarter(spark, sf):
    """Facts in one folder per quarter, of which one quarter is rebuilt on its own."""
    cfg = _config(spark, sf, stage=False, facts_by_quarter=True)
    bronze = {s: raw_view(spark, sf, s) for s in ("status", "services")}
    flows.run_silver(spark, cfg, bronze=bronze, only=("facts_base",))
    flows.rebuild_quarters(spark, cfg, ("Q3",), bronze)
    return spark.table(f"{cfg.silver_db}.facts_base")


def q_facts_bucketed(spark, sf):
    """Facts from status and services tables that are hashed by customer: joined without a shuffle."""
    cfg = _config(spark, sf, customer_buckets=8)
    flows.run_bronze(spark, cfg, enforce=False)
    flows.run_silver(spark, cfg, only=("facts_base",))
    return spark.table(f"{cfg.silver_db}.facts_base")


def q_silver_keyed_facts(spark, sf):
    """The keyed facts as the silver flow writes them."""
    cfg = _config(spark, sf, stage=False, keyed_facts=True)
    flows.run_silver(spark, cfg, bronze={s: raw_view(spark, sf, s) for s in SUBJECTS}, enforce=False)
    return spark.table(f"{cfg.silver_db}.facts_keyed")


def q_silver_schema_evolution(spark, sf):
    """A package dimension declared and written without paperless billing gains the column with the run that builds
    it.  The raw services have no such column; that of unlimited data stands in for it."""
    cfg = _config(spark, sf, stage=False)
    (sv,) = _raw(spark, sf, "services")
    bronze = {"services": sv.withColumn("paperless_billing", F.col("unlimited_data"))}
    flows.run_silver(spark, cfg, bronze=bronze, only=("dim_service_package",))
    cfg.paperless_billing = True
    flows.run_silver(spark, cfg, bronze=bronze, only=("dim_service_package",))
    return spark.table(f"{cfg.silver_db}.dim_service_package").drop("service_package_key")


QUERIES: dict[str, Query] = {
    # tables
    "dim_customer": q_dim_customer,
    "dim_location": q_dim_location,
    "dim_location_scd1": q_dim_location_scd1,
    "dim_service_package": q_dim_service_package,
    "dim_churn_status": q_dim_churn_status,
    "dim_promotion": q_dim_promotion,
    "dim_quarter": q_dim_quarter,
    "facts_base": q_facts_base,
    "facts_base_hot_split": q_facts_base_hot_split,
    "facts_base_grain_safe": q_facts_base_grain_safe,
    "facts_keyed": q_facts_keyed,
    "facts_by_quarter": q_facts_by_quarter,
    "facts_bucketed": q_facts_bucketed,
    "dim_customer_registry": q_dim_customer_registry,
    # rules
    "standardize_flags": q_standardize_flags,
    "standardize_membership": q_standardize_membership,
    "standardize_substring": q_standardize_substring,
    "standardize_internet": q_standardize_internet,
    "bucket_age": q_bucket_age,
    "bucket_density": q_bucket_density,
    "bucket_service_tier": q_bucket_service_tier,
    "derive_bundle_type": q_derive_bundle_type,
    "derive_family_size": q_derive_family_size,
    "derive_total_services": q_derive_total_services,
    "clean_location": q_clean_location,
    "clean_population": q_clean_population,
    # relational
    "project_rename": q_project_rename,
    "cast_measures": q_cast_measures,
    "filter_valid_coordinates": q_filter_valid_coordinates,
    "location_population_join": q_location_population_join,
    "dedup_by_key": q_dedup_by_key,
    "dedup_ratio": q_dedup_ratio,
    # keys
    "seq_key_customer": q_seq_key_customer,
    "seq_key_location": q_seq_key_location,
    "hash_key_service_package": q_hash_key_service_package,
    "hash_key_churn_status": q_hash_key_churn_status,
    "hash_key_promotion": q_hash_key_promotion,
    # quality
    "dq_min_rows": q_dq_min_rows,
    "dq_non_empty": q_dq_non_empty,
    "dq_grain_duplicates": q_dq_grain_duplicates,
    "dq_null_counts": q_dq_null_counts,
    "dq_location_null_keys": q_dq_location_null_keys,
    "dq_key_unique": q_dq_key_unique,
    "dq_referential_integrity": q_dq_referential_integrity,
    "dq_type_consistency": q_dq_type_consistency,
    "dq_fact_dimension_keys": q_dq_fact_dimension_keys,
    "profile_measures": q_profile_measures,
    "layer_row_counts": q_layer_row_counts,
    # bronze, catalog, flows
    "bronze_lineage_columns": q_bronze_lineage_columns,
    "bronze_roundtrip": q_bronze_roundtrip,
    "bronze_ingest_population": q_bronze_ingest_population,
    "bronze_ingest_all": q_bronze_ingest_all,
    "catalog_tables": q_catalog_tables,
    "catalog_data_dictionary": q_catalog_data_dictionary,
    "silver_write_keeps_schema": q_silver_write_keeps_schema,
    "silver_build_all": q_silver_build_all,
    "silver_build_content": q_silver_build_content,
    "silver_quality_report": q_silver_quality_report,
    "silver_location_scd1": q_silver_location_scd1,
    "silver_keyed_facts": q_silver_keyed_facts,
    "silver_schema_evolution": q_silver_schema_evolution,
    "bronze_quality_report": q_bronze_quality_report,
    "load_audit": q_load_audit,
}
