"""Raw bronze-shaped inputs derived from the driver's TPC-H-style tables.

The warehouse operators consume five raw subjects (demographics, location,
population, status, services).  The test/bench data has none of them, so each
is a portable SQL view over ``customer`` / ``orders`` / ``part`` that adds the
NULLs, padding, mixed case and over-matching text the cleaning rules exist for.
The same text runs in Spark (tables bound as DataFrames through
``spark.sql(..., customer=df)``) and in DuckDB (tables bound by name), so only
the operator under test differs between a query and its oracle.

Every view is row-for-row a projection of a base table: its size grows with
the scale factor, and Catalyst prunes the parquet scan to the columns used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The fixture view texts (FIXTURES.md §4), verbatim apart from the
# ``{table}`` placeholders.
RAW_DEMOGRAPHICS = """
SELECT CASE WHEN c_custkey % 3 = 0 THEN ' ' || c_name || ' ' ELSE c_name END AS customer_id, 1 AS count,
 CASE c_custkey % 8 WHEN 0 THEN 'Male' WHEN 1 THEN 'female' WHEN 2 THEN ' m ' WHEN 3 THEN 'F' WHEN 4 THEN 'woman' WHEN 5 THEN 'MAN' WHEN 6 THEN 'x' END AS gender,
 CASE WHEN c_custkey % 41 <> 0 THEN CAST(15 + c_custkey % 70 AS INT) END AS age,
 CASE c_custkey % 7 WHEN 0 THEN 'Yes' WHEN 1 THEN 'no' WHEN 2 THEN ' y ' WHEN 3 THEN 'N' WHEN 4 THEN 'single' WHEN 5 THEN 'MARRIED' END AS married,
 CASE WHEN c_custkey % 29 <> 0 THEN CAST(c_custkey % 5 AS INT) END AS number_of_dependents FROM {customer}
"""

RAW_LOCATION = """
SELECT c_name AS customer_id, CASE WHEN z % 97 <> 0 THEN CAST(z AS INT) END AS zip_code,
 CASE z % 4 WHEN 0 THEN ' los angeles' WHEN 1 THEN 'SAN JOSE' WHEN 2 THEN 'la jolla  ' ELSE 'o''brien-ville' END AS city,
 CASE WHEN z % 89 <> 0 THEN CAST((z * 37) % 1900 AS DOUBLE) / 10 - 95 END AS latitude, CASE WHEN z % 83 <> 0 THEN CAST((z * 37) % 3700 AS DOUBLE) / 10 - 185 END AS longitude
 FROM (SELECT c_name, 1000 + (c_custkey * 7) % 600 AS z FROM {customer}) t
"""

RAW_POPULATION = """
SELECT CAST(p_partkey AS INT) AS id, CAST(1000 + p_partkey AS INT) AS zip_code,
 CASE p_partkey % 6 WHEN 0 THEN '' WHEN 1 THEN 'N/A' WHEN 2 THEN NULL WHEN 3 THEN '678' WHEN 4 THEN '20000.0' ELSE CAST(p_partkey % 110 AS STRING) || ',250' END AS population FROM {part}
"""

RAW_STATUS = """
SELECT CASE WHEN o_orderkey % 43 = 0 THEN ' ' ELSE '' END || 'Customer#' || lpad(CAST(o_custkey AS STRING), 9, '0') AS customer_id,
 CASE WHEN o_orderkey % 53 = 0 THEN 'Qx' WHEN o_orderkey % 59 = 0 THEN NULL ELSE 'Q' || CAST(quarter(o_orderdate) AS STRING) END AS quarter,
 CAST(1 + o_orderkey % 5 AS INT) AS satisfaction_score, CAST(o_orderkey % 2 AS INT) AS churn_value, CAST(o_orderkey % 101 AS INT) AS churn_score, CAST(2000 + o_orderkey % 4500 AS INT) AS cltv,
 CASE o_orderkey % 9 WHEN 0 THEN 'Stayed' WHEN 1 THEN 'churned' WHEN 2 THEN ' JOINED' WHEN 3 THEN 'Churn' WHEN 4 THEN 'retained' WHEN 5 THEN 'active' WHEN 6 THEN 'new ' WHEN 7 THEN 'zzz' END AS customer_status,
 CASE o_orderkey % 6 WHEN 0 THEN 'competitor' WHEN 1 THEN 'DISSATISFACTION' WHEN 2 THEN ' Price ' WHEN 3 THEN NULL WHEN 4 THEN '' ELSE 'other' END AS churn_category,
 CASE WHEN o_orderkey % 5 <> 0 THEN ' ' || o_orderpriority END AS churn_reason FROM {orders}
"""


def _flag_case(multiplier: int, name: str) -> str:
    return (
        f"CASE (o_orderkey * {multiplier} + o_custkey) % 5 WHEN 0 THEN 'Yes' WHEN 1 THEN ' no' "
        f"WHEN 2 THEN 'YES ' WHEN 3 THEN 'No' END AS {name}"
    )


# Multiplier per yes/no column of the services view.
_SERVICE_FLAGS = [
    (1, "phone_service"),
    (2, "multiple_lines"),
    (3, "online_security"),
    (4, "online_backup"),
    (6, "device_protection_plan"),
    (7, "premium_tech_support"),
    (8, "streaming_tv"),
    (9, "streaming_movies"),
    (11, "streaming_music"),
    (12, "unlimited_data"),
    (13, "referred_a_friend"),
]

RAW_SERVICES = (
    "\nSELECT CASE WHEN o_orderkey % 37 = 0 THEN ' ' ELSE '' END || 'Customer#' || lpad(CAST(o_custkey AS STRING), 9, '0') AS customer_id, "
    "'Q' || CAST(quarter(o_orderdate) AS STRING) AS quarter, "
    + ", ".join(_flag_case(m, n) for m, n in _SERVICE_FLAGS)
    + """,
 CASE o_orderkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' END AS internet_service,
 CASE o_orderkey % 4 WHEN 0 THEN 'DSL' WHEN 1 THEN 'Fiber Optic' WHEN 2 THEN 'fiber-x' ELSE 'Cable' END AS internet_type,
 CASE o_orderkey % 7 WHEN 0 THEN 'Offer A' WHEN 1 THEN 'offer b' WHEN 2 THEN ' OFFER C ' WHEN 3 THEN 'None' WHEN 4 THEN '' WHEN 5 THEN 'Offer Extra' END AS offer,
 CASE o_orderkey % 4 WHEN 0 THEN 'Month-to-Month' WHEN 1 THEN 'one year' WHEN 2 THEN 'Two Year' END AS contract,
 CASE o_orderkey % 5 WHEN 0 THEN 'Bank Withdrawal' WHEN 1 THEN 'credit card' WHEN 2 THEN 'Electronic Check' WHEN 3 THEN 'mailed check' ELSE 'cash' END AS payment_method,
 CAST(o_orderkey % 72 AS INT) AS tenure_in_months, CAST(o_orderkey % 12 AS INT) AS number_of_referrals, CAST(o_orderkey % 85 AS INT) AS avg_monthly_gb_download,
 CAST(o_orderkey % 12000 AS DOUBLE) / 100 AS monthly_charge, CAST(o_orderkey % 5000 AS DOUBLE) / 100 AS avg_monthly_long_distance_charges, o_totalprice AS total_charges,
 CASE WHEN o_orderkey % 61 = 0 THEN 123456789012.0 ELSE CAST(o_orderkey % 4900 AS DOUBLE) / 100 END AS total_refunds, CAST(o_orderkey % 150 AS INT) AS total_extra_data_charges, CAST(o_orderkey % 350000 AS DOUBLE) / 100 AS total_long_distance_charges, o_totalprice * 2 AS total_revenue FROM {orders}
"""
)

RAW_VIEWS: dict[str, tuple[str, str]] = {
    # subject -> (SQL text, base table)
    "demographics": (RAW_DEMOGRAPHICS, "customer"),
    "location": (RAW_LOCATION, "customer"),
    "population": (RAW_POPULATION, "part"),
    "status": (RAW_STATUS, "orders"),
    "services": (RAW_SERVICES, "orders"),
}

SUBJECTS = tuple(RAW_VIEWS)


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_view(spark: SparkSession, sf_dir: str, subject: str) -> DataFrame:
    """One raw subject as a lazy DataFrame over the driver's parquet tables."""
    text, table = RAW_VIEWS[subject]
    return spark.sql(text, **{table: base_table(spark, sf_dir, table)})


def raw_views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {s: raw_view(spark, sf_dir, s) for s in SUBJECTS}


def duckdb_view_sql(subject: str) -> str:
    """The same view text with table placeholders bound to DuckDB view names."""
    text, table = RAW_VIEWS[subject]
    return text.format(**{table: table}).strip()
