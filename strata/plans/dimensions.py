"""Conformed-dimension builders: pure ``DataFrame -> DataFrame`` functions.

Each builder takes bronze-shaped frames and returns the silver table with the
declared column order and types (``schemas.SILVER``).  Nothing is counted,
shown or written here; the flow layer writes each table in one job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import standard as std
from ..functions.rules import ident, norm_title
from ..operators.keys import hash_key_columns, hash_key_joined, period_key, sequential_key
from ..operators.registry import with_registered_key
from ..operators.relational import dedup_by_key
from ..operators.scd import scd1_upsert
from .schemas import SILVER

BUSINESS_YEAR = 2025  # fixed value: year assigned to every source quarter


def conform(df: DataFrame, table: str, *more: str) -> DataFrame:
    """Select the declared columns in declared order, cast to declared types, and then ``more``."""
    declared = [f"CAST({ident(f.name)} AS {f.dataType.simpleString()}) AS {ident(f.name)}" for f in SILVER[table].fields]
    return df.selectExpr(*declared, *map(ident, more))


# ---------------------------------------------------------------- customer
def clean_demographics(demographics: DataFrame) -> DataFrame:
    """Row-level standardization of the demographics subject."""
    d = demographics.select(
        F.trim("customer_id").alias("customer_id"),
        F.col("age").try_cast("int").alias("age"),
        std.gender("gender").alias("gender"),
        std.marital_status("married").alias("marital_status"),
        F.col("number_of_dependents").try_cast("int").alias("number_of_dependents"),
    )
    return d.withColumns(
        {
            "age_group": std.age_group("age"),
            "family_size": std.family_size("marital_status", "number_of_dependents"),
        }
    )


def dim_customer(demographics: DataFrame) -> DataFrame:
    """One row per source customer row, sequential key by ``customer_id``."""
    keyed = sequential_key(clean_demographics(demographics), ["customer_id"], "customer_key")
    return conform(keyed, "dim_customer")


def dim_customer_registered(demographics: DataFrame, registry: DataFrame) -> DataFrame:
    """One row per source customer row with the stable key that the registry holds for its id."""
    return conform(with_registered_key(clean_demographics(demographics), registry, ["customer_id"], "customer_key"), "dim_customer")


# ---------------------------------------------------------------- location
def clean_location(location: DataFrame, keep=()) -> DataFrame:
    """Row-level location cleanup (C9): title-case city, 5-char ZIP, 4-decimal coordinates."""
    return location.select(
        *keep,
        std.title_case("city").alias("city"),
        std.zip5("zip_code").alias("zip_code"),
        std.round_coordinate("latitude").alias("latitude"),
        std.round_coordinate("longitude").alias("longitude"),
    )


def valid_coordinates(df: DataFrame) -> DataFrame:
    """Range check (F1): latitude in [-90, 90], longitude in [-180, 180]; NULL fails."""
    return df.filter(F.col("latitude").between(-90, 90) & F.col("longitude").between(-180, 180))


LOCATION_COLUMNS = ("customer_id", "zip_code", "city", "latitude", "longitude")


def location_by_zip(location: DataFrame) -> DataFrame:
    """Dedup on the raw ZIP, then clean and range-check.

    The surviving row is the lowest by (customer_id, city, latitude, longitude).
    Only those columns enter the dedup aggregate, so the scan is pruned and the
    shuffle does not carry columns the dimension never uses.
    """
    cols = [c for c in LOCATION_COLUMNS if c in location.columns]
    one_per_zip = dedup_by_key(location.select(*cols), ["zip_code"])
    return valid_coordinates(clean_location(one_per_zip))


def parse_population(population: DataFrame, keep=()) -> DataFrame:
    """Row-level population cleanup (C10): pad the ZIP, parse the count."""
    return population.select(
        *keep,
        std.zip5("zip_code").alias("zip_code"),
        std.clean_count("population").alias("population"),
    )


def clean_population(population: DataFrame) -> DataFrame:
    """Population per ZIP: dedup on the raw ZIP (lowest row wins), then parse."""
    return parse_population(dedup_by_key(population.select("zip_code", "population"), ["zip_code"]))


def location_with_population(location: DataFrame, population: DataFrame) -> DataFrame:
    """Left join (J2): every valid location keeps its row; no match gives NULL population.

    The population side is an aggregate (one row per ZIP), so its exact size is
    known at run time; adaptive execution broadcasts it when that size is under
    the broadcast threshold and keeps a shuffle join otherwise.
    """
    return location_by_zip(location).join(clean_population(population), on="zip_code", how="left")


def location_members(location: DataFrame, population: DataFrame) -> DataFrame:
    """The location dimension's rows without a key."""
    return location_with_population(location, population).withColumn(
        "population_density", std.population_density("population")
    )


def dim_location(location: DataFrame, population: DataFrame) -> DataFrame:
    keyed = sequential_key(location_members(location, population), ["zip_code"], "location_key")
    return conform(keyed, "dim_location")


def dim_location_scd1(current: DataFrame, location: DataFrame, population: DataFrame) -> DataFrame:
    """The location dimension maintained as SCD type 1: today's build updates
    the attributes of known ZIPs in place (their keys stay), new ZIPs get new keys."""
    merged = scd1_upsert(current, location_members(location, population), ["zip_code"], "location_key")
    return conform(merged, "dim_location")


# ---------------------------------------------------------------- service package
SERVICE_ATTRIBUTES = (
    "phone_service",
    "multiple_lines",
    "internet_service",
    *std.ADD_ONS,
    "contract",
    "payment_method",
)


PAPERLESS = "paperless_billing"


def standardize_services(
    services: DataFrame, prefer_internet_type: bool = False, keep=(), paperless: bool = False
) -> DataFrame:
    """The 13 package attributes of every services row (C1, C1a, C1b, C3, C3a, C3c), with
    ``paperless`` also that of paperless billing; ``keep`` carries source columns through
    (e.g. the natural key)."""
    cols = {
        "phone_service": std.PHONE_SERVICE.apply("phone_service"),
        "multiple_lines": std.MULTIPLE_LINES.apply("multiple_lines"),
        "internet_service": std.internet_service("internet_service", "internet_type", prefer_internet_type),
    }
    cols.update({out: std.ADD_ON.apply(src) for out, src in std.ADD_ON_COLUMNS})
    cols["contract"] = std.CONTRACT.apply("contract")
    cols["payment_method"] = std.PAYMENT_METHOD.apply("payment_method")
    if paperless:
        cols[PAPERLESS] = std.ADD_ON.apply(PAPERLESS)
    return services.select(*keep, *[c.alias(n) for n, c in cols.items()])


def derive_package(df: DataFrame) -> DataFrame:
    """Derived package attributes."""
    return df.withColumn("total_services", std.total_services()).withColumns(
        {"service_tier": std.service_tier("total_services"), "bundle_type": std.bundle_type()}
    )


def dim_service_package(services: DataFrame, prefer_internet_type: bool = False, paperless: bool = False) -> DataFrame:
    """Distinct attribute combinations, derived after the distinct (one hash aggregate).  With
    ``paperless`` the attribute belongs to the combination and its key, and follows as the last column."""
    packages = standardize_services(services, prefer_internet_type, paperless=paperless).distinct()
    attributes = (*SERVICE_ATTRIBUTES, PAPERLESS) if paperless else SERVICE_ATTRIBUTES
    keyed = derive_package(packages).withColumn("service_package_key", hash_key_joined(attributes))
    return conform(keyed, "dim_service_package", *([PAPERLESS] if paperless else []))


# ---------------------------------------------------------------- churn status
def standardize_status(status: DataFrame, keep=()) -> DataFrame:
    """Status attributes per row (C2b, C7); ``keep`` carries source columns through."""
    st = status.select(
        *keep,
        std.customer_status("customer_status").alias("customer_status"),
        norm_title("churn_category").alias("_category"),
        F.trim("churn_reason").alias("_reason"),
    )
    return st.select(
        *keep,
        "customer_status",
        std.churn_detail("customer_status", "_category").alias("churn_category"),
        std.churn_detail("customer_status", "_reason").alias("churn_reason"),
    )


CHURN_ATTRIBUTES = ("customer_status", "churn_category", "churn_reason")


def dim_churn_status(status: DataFrame) -> DataFrame:
    distinct = standardize_status(status).distinct()
    keyed = distinct.withColumn("churn_status_key", hash_key_columns(CHURN_ATTRIBUTES))
    return conform(keyed, "dim_churn_status")


# ---------------------------------------------------------------- promotion
PROMOTION_ATTRIBUTES = ("offer", "referred_a_friend")


def standardize_promotion(services: DataFrame, keep=()) -> DataFrame:
    return services.select(
        *keep,
        std.OFFER.apply("offer").alias("offer"),
        std.REFERRED_A_FRIEND.apply("referred_a_friend").alias("referred_a_friend"),
    )


def dim_promotion(services: DataFrame) -> DataFrame:
    distinct = standardize_promotion(services).distinct()
    keyed = distinct.withColumn("promotion_key", hash_key_joined(PROMOTION_ATTRIBUTES))
    return conform(keyed, "dim_promotion")


# ---------------------------------------------------------------- quarter
def dim_quarter(status: DataFrame, business_year: int = BUSINESS_YEAR) -> DataFrame:
    """Distinct source quarters with the business year, smart key and halves.

    An unparsable quarter keeps its row with NULL key and quarter number and H2.
    """
    q = status.select("quarter").distinct().withColumn("year", F.lit(business_year).cast("int"))
    q = q.withColumn("quarter_of_year", std.quarter_of_year("quarter"))
    q = q.withColumns(
        {
            "quarter_key": period_key("year", "quarter_of_year"),
            "quarter_name": F.concat(F.col("quarter"), F.lit("-"), F.col("year").cast("string")),
            "half_of_year": std.half_of_year("quarter_of_year"),
        }
    )
    return conform(q, "dim_quarter")
