"""Independent DuckDB formulations of every registered query (the correctness oracle).

Written directly from the rule semantics in plain SQL - window ``row_number``
for sequential keys, ``ROW_NUMBER() ... = 1`` for dedup, ``CASE`` chains for
rules - over the same raw view texts the Spark side uses.  Hash keys are computed
by ``xxh64_sql`` on the distinct members of their dimension.
"""

from __future__ import annotations

from ..sources.raw_views import duckdb_view_sql
from .xxh64_sql import key_chained, key_joined, signed64


def initcap(x: str) -> str:
    """Spark ``initcap``: lower-case, then upper-case the first letter of each space-separated word."""
    return f"array_to_string(list_transform(string_split(lower({x}), ' '), lambda w: upper(w[1:1]) || w[2:]), ' ')"


def tu(x: str) -> str:
    return f"trim(upper({x}))"


def flag(x: str, default: str) -> str:
    return f"CASE WHEN {tu(x)} = 'YES' THEN 'Yes' WHEN {tu(x)} = 'NO' THEN 'No' ELSE '{default}' END"


def raw(*subjects: str) -> list[str]:
    return [f"raw_{s} AS ({duckdb_view_sql(s)})" for s in subjects]


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


# ---------------------------------------------------------------- customer
CLEAN_DEMOGRAPHICS = f"""clean_demographics AS (
  SELECT customer_id, age, gender, marital_status, number_of_dependents,
    CASE WHEN age < 25 THEN '18-24' WHEN age >= 25 AND age < 35 THEN '25-34'
         WHEN age >= 35 AND age < 45 THEN '35-44' WHEN age >= 45 AND age < 55 THEN '45-54'
         WHEN age >= 55 AND age < 65 THEN '55-64' WHEN age >= 65 THEN '65+' END AS age_group,
    CASE WHEN marital_status = 'Married' THEN number_of_dependents + 2 ELSE number_of_dependents + 1 END AS family_size
  FROM (
    SELECT trim(customer_id) AS customer_id, CAST(age AS INTEGER) AS age,
      CASE WHEN {tu('gender')} IN ('M', 'MALE', 'MAN') THEN 'Male'
           WHEN {tu('gender')} IN ('F', 'FEMALE', 'WOMAN') THEN 'Female' ELSE 'n/a' END AS gender,
      CASE WHEN trim({initcap('married')}) IN ('Yes', 'Y', 'Married') THEN 'Married'
           WHEN trim({initcap('married')}) IN ('No', 'N', 'Single') THEN 'Single' ELSE 'n/a' END AS marital_status,
      CAST(number_of_dependents AS INTEGER) AS number_of_dependents
    FROM raw_demographics) d)"""

DIM_CUSTOMER = with_(
    raw("demographics") + [CLEAN_DEMOGRAPHICS],
    """SELECT CAST(row_number() OVER (ORDER BY customer_id NULLS FIRST) AS BIGINT) AS customer_key,
  customer_id, age, age_group, gender, marital_status, number_of_dependents, family_size
FROM clean_demographics""",
)

# ---------------------------------------------------------------- location
LOCATION_BY_ZIP = f"""location_by_zip AS (
  SELECT * FROM (
    SELECT {initcap('trim(city)')} AS city, lpad(trim(CAST(zip_code AS VARCHAR)), 5, '0') AS zip_code,
      round(latitude, 4) AS latitude, round(longitude, 4) AS longitude
    FROM (SELECT *, row_number() OVER (PARTITION BY zip_code
            ORDER BY customer_id NULLS FIRST, city NULLS FIRST, latitude NULLS FIRST, longitude NULLS FIRST) AS rn
          FROM raw_location) r WHERE rn = 1) c
  WHERE latitude >= -90 AND latitude <= 90 AND longitude >= -180 AND longitude <= 180)"""

CLEAN_POPULATION = """clean_population AS (
  SELECT lpad(trim(CAST(zip_code AS VARCHAR)), 5, '0') AS zip_code,
    CASE WHEN regexp_replace(population, '[^0-9.]', '', 'g') = '' THEN 0
         ELSE TRY_CAST(trunc(TRY_CAST(regexp_replace(population, '[^0-9.]', '', 'g') AS DOUBLE)) AS INTEGER) END AS population
  FROM (SELECT *, row_number() OVER (PARTITION BY zip_code ORDER BY population NULLS FIRST) AS rn
        FROM raw_population) p WHERE rn = 1)"""

LOCATION_JOINED = """location_joined AS (
  SELECT l.city, l.zip_code, l.latitude, l.longitude, p.population,
    CASE WHEN p.population >= 75000 THEN 'Urban' WHEN p.population >= 20000 THEN 'Suburban' ELSE 'Rural' END AS population_density
  FROM location_by_zip l LEFT JOIN clean_population p ON l.zip_code = p.zip_code)"""

DIM_LOCATION_CTES = raw("location", "population") + [LOCATION_BY_ZIP, CLEAN_POPULATION, LOCATION_JOINED]
DIM_LOCATION_BODY = """SELECT CAST(row_number() OVER (ORDER BY zip_code NULLS FIRST) AS BIGINT) AS location_key,
  city, zip_code, latitude, longitude, population, population_density
FROM location_joined"""
DIM_LOCATION = with_(DIM_LOCATION_CTES, DIM_LOCATION_BODY)

# yesterday's dimension has the ZIPs 50 higher and no population
DIM_LOCATION_SCD1 = with_(
    DIM_LOCATION_CTES
    + [f"today AS ({DIM_LOCATION_BODY})",
       """yesterday AS (SELECT * REPLACE (lpad(CAST(CAST(zip_code AS INTEGER) + 50 AS VARCHAR), 5, '0') AS zip_code,
         CAST(NULL AS INTEGER) AS population, 'Rural' AS population_density) FROM today)"""],
    """SELECT t.* REPLACE (CAST(coalesce(y.location_key, (SELECT max(location_key) FROM yesterday)
           + row_number() OVER (PARTITION BY y.location_key IS NULL ORDER BY t.zip_code NULLS FIRST)) AS BIGINT) AS location_key)
       FROM today t LEFT JOIN yesterday y ON t.zip_code IS NOT DISTINCT FROM y.zip_code
       UNION ALL
       SELECT * FROM yesterday y WHERE NOT EXISTS (SELECT 1 FROM today t WHERE t.zip_code IS NOT DISTINCT FROM y.zip_code)""",
)

# ---------------------------------------------------------------- services
ADD_ONS = [
    ("online_security", "online_security"),
    ("online_backup", "online_backup"),
    ("device_protection", "device_protection_plan"),
    ("tech_support", "premium_tech_support"),
    ("streaming_tv", "streaming_tv"),
    ("streaming_movies", "streaming_movies"),
    ("streaming_music", "streaming_music"),
    ("unlimited_data", "unlimited_data"),
]

INTERNET = f"""CASE WHEN {tu('internet_service')} = 'YES' THEN 'Yes' WHEN {tu('internet_service')} = 'NO' THEN 'None'
      WHEN {tu('internet_type')} = 'DSL' THEN 'DSL' WHEN {tu('internet_type')} = 'FIBER OPTIC' THEN 'Fiber optic'
      WHEN {tu('internet_type')} LIKE '%FIBER%' THEN 'Fiber optic' ELSE 'None' END"""

CONTRACT = f"""CASE WHEN {tu('contract')} LIKE '%MONTH%' THEN 'Month-to-month' WHEN {tu('contract')} LIKE '%ONE%' THEN 'One year'
      WHEN {tu('contract')} LIKE '%TWO%' THEN 'Two year' ELSE 'Month-to-month' END"""

PAYMENT = f"""CASE WHEN {tu('payment_method')} LIKE '%BANK%' THEN 'Bank transfer' WHEN {tu('payment_method')} LIKE '%CREDIT%' THEN 'Credit card'
      WHEN {tu('payment_method')} LIKE '%ELECTRONIC%' THEN 'Electronic check' WHEN {tu('payment_method')} LIKE '%MAIL%' THEN 'Mailed check'
      ELSE 'Unknown' END"""

OFFER = f"""CASE WHEN {tu('offer')} LIKE '%OFFER A%' THEN 'Offer A' WHEN {tu('offer')} LIKE '%OFFER B%' THEN 'Offer B'
      WHEN {tu('offer')} LIKE '%OFFER C%' THEN 'Offer C' WHEN {tu('offer')} LIKE '%OFFER D%' THEN 'Offer D'
      WHEN {tu('offer')} LIKE '%OFFER E%' THEN 'Offer E' ELSE 'None' END"""

PACKAGE_COLUMNS = (
    [f"{flag('phone_service', 'n/a')} AS phone_service", f"{flag('multiple_lines', 'No phone service')} AS multiple_lines",
     f"{INTERNET} AS internet_service"]
    + [f"{flag(src, 'Not applicable')} AS {out}" for out, src in ADD_ONS]
    + [f"{CONTRACT} AS contract", f"{PAYMENT} AS payment_method"]
)
PACKAGE_ATTRS = ["phone_service", "multiple_lines", "internet_service"] + [o for o, _ in ADD_ONS] + ["contract", "payment_method"]

STD_SERVICES = "std_services AS (SELECT customer_id, quarter,\n  " + ",\n  ".join(PACKAGE_COLUMNS) + "\nFROM raw_services)"

TOTAL_SERVICES = "CAST(" + " + ".join(f"CASE WHEN {o} = 'Yes' THEN 1 ELSE 0 END" for o, _ in ADD_ONS) + " AS INTEGER)"

DERIVED = """CASE WHEN total_services = 0 THEN 'Basic' WHEN total_services BETWEEN 1 AND 2 THEN 'Standard' ELSE 'Premium' END AS service_tier,
  CASE WHEN phone_service = 'Yes' AND internet_service IN ('DSL', 'Fiber optic') THEN 'Double play'
       WHEN phone_service = 'Yes' AND internet_service = 'None' THEN 'Single service'
       WHEN phone_service = 'No' AND internet_service IN ('DSL', 'Fiber optic') THEN 'Single service'
       ELSE 'No service' END AS bundle_type"""

DIM_SERVICE_PACKAGE_BODY = (
    "SELECT " + ", ".join(PACKAGE_ATTRS) + ", total_services,\n  " + DERIVED
    + "\nFROM (SELECT *, " + TOTAL_SERVICES + " AS total_services FROM (SELECT DISTINCT "
    + ", ".join(PACKAGE_ATTRS) + " FROM std_services) d) t"
)


def with_key(body: str, name: str, key: str) -> str:
    return f"SELECT * EXCLUDE (h), {signed64('h')} AS {name} FROM (SELECT *, {key} AS h FROM ({body}) b) k"


KEYED_SERVICE_PACKAGE = with_key(DIM_SERVICE_PACKAGE_BODY, "service_package_key", key_joined(PACKAGE_ATTRS))
DIM_SERVICE_PACKAGE = with_(raw("services") + [STD_SERVICES], KEYED_SERVICE_PACKAGE)

# ---------------------------------------------------------------- churn status
STD_STATUS = f"""std_status AS (
  SELECT customer_status,
    CASE WHEN customer_status = 'Churned' THEN coalesce(cat, 'n/a') ELSE 'n/a' END AS churn_category,
    CASE WHEN customer_status = 'Churned' THEN coalesce(reason, 'n/a') ELSE 'n/a' END AS churn_reason
  FROM (SELECT
      CASE WHEN trim({initcap('customer_status')}) IN ('Churned', 'Churn') THEN 'Churned'
           WHEN trim({initcap('customer_status')}) IN ('Stayed', 'Stay', 'Active', 'Retained') THEN 'Active'
           WHEN trim({initcap('customer_status')}) IN ('Joined', 'New') THEN 'New' ELSE 'n/a' END AS customer_status,
      trim({initcap('churn_category')}) AS cat, trim(churn_reason) AS reason
    FROM raw_status) s)"""

CHURN_ATTRS = ["customer_status", "churn_category", "churn_reason"]
DIM_CHURN_STATUS_BODY = "SELECT DISTINCT customer_status, churn_category, churn_reason FROM std_status"
KEYED_CHURN_STATUS = with_key(DIM_CHURN_STATUS_BODY, "churn_status_key", key_chained(CHURN_ATTRS))
DIM_CHURN_STATUS = with_(raw("status") + [STD_STATUS], KEYED_CHURN_STATUS)

# ---------------------------------------------------------------- promotion
STD_PROMOTION = f"std_promotion AS (SELECT {OFFER} AS offer, {flag('referred_a_friend', 'No')} AS referred_a_friend FROM raw_services)"
DIM_PROMOTION_BODY = "SELECT DISTINCT offer, referred_a_friend FROM std_promotion"
KEYED_PROMOTION = with_key(DIM_PROMOTION_BODY, "promotion_key", key_joined(["offer", "referred_a_friend"]))
DIM_PROMOTION = with_(raw("services") + [STD_PROMOTION], KEYED_PROMOTION)

# ---------------------------------------------------------------- facts
FACT_SELECT = """trim(s.customer_id) AS customer_id, trim(s.quarter) AS "quarter",
  CAST(v.tenure_in_months AS INTEGER) AS tenure_months, CAST(s.satisfaction_score AS INTEGER) AS satisfaction_score,
  CAST(s.churn_value AS INTEGER) AS churn_value, CAST(s.churn_score AS INTEGER) AS churn_score, CAST(s.cltv AS INTEGER) AS cltv,
  CAST(v.monthly_charge AS DECIMAL(10,2)) AS monthly_charges,
  CAST(v.avg_monthly_long_distance_charges AS DECIMAL(10,2)) AS avg_monthly_long_distance_charges,
  CAST(v.total_charges AS DECIMAL(10,2)) AS total_charges, CAST(v.total_revenue AS DECIMAL(10,2)) AS total_revenue,
  TRY_CAST(v.total_refunds AS DECIMAL(10,2)) AS total_refunds, CAST(v.total_extra_data_charges AS DECIMAL(10,2)) AS total_extra_data_charges,
  CAST(v.total_long_distance_charges AS DECIMAL(10,2)) AS total_long_distance_charges,
  CAST(v.avg_monthly_gb_download AS INTEGER) AS avg_monthly_gb_download, CAST(v.number_of_referrals AS INTEGER) AS number_of_referrals"""

FACTS_BASE_CTE = f"facts AS (SELECT {FACT_SELECT}\n  FROM raw_status s JOIN raw_services v ON s.customer_id = v.customer_id)"
FACTS_SAFE_CTE = (
    f"facts AS (SELECT {FACT_SELECT}\n  FROM raw_status s JOIN raw_services v "
    "ON s.customer_id = v.customer_id AND s.quarter = v.quarter)"
)
FACTS_BASE = with_(raw("status", "services") + [FACTS_BASE_CTE], "SELECT * FROM facts")
FACTS_BASE_GRAIN_SAFE = with_(raw("status", "services") + [FACTS_SAFE_CTE], "SELECT * FROM facts")


# ---------------------------------------------------------------- silver tables as CTEs
DIM_CUSTOMER_BODY = """SELECT CAST(row_number() OVER (ORDER BY customer_id NULLS FIRST) AS BIGINT) AS customer_key,
  customer_id, age, age_group, gender, marital_status, number_of_dependents, family_size
FROM clean_demographics"""

DIM_QUARTER_BODY = r"""SELECT CAST(2025 * 100 + q AS INTEGER) AS quarter_key, "quarter" || '-' || '2025' AS quarter_name,
  CAST(2025 AS INTEGER) AS "year", q AS quarter_of_year, CASE WHEN q <= 2 THEN 'H1' ELSE 'H2' END AS half_of_year
FROM (SELECT "quarter", TRY_CAST(regexp_extract("quarter", 'Q(\d)', 1) AS INTEGER) AS q
      FROM (SELECT DISTINCT "quarter" FROM raw_status) d) t"""

DIM_QUARTER = with_(raw("status"), DIM_QUARTER_BODY)

SILVER_BODIES = {
    "dim_customer": DIM_CUSTOMER_BODY,
    "dim_location": DIM_LOCATION_BODY,
    "dim_service_package": DIM_SERVICE_PACKAGE_BODY,
    "dim_churn_status": DIM_CHURN_STATUS_BODY,
    "dim_quarter": DIM_QUARTER_BODY,
    "dim_promotion": DIM_PROMOTION_BODY,
    "facts_base": "SELECT * FROM facts",
}

ALL_CTES = (
    raw("demographics", "location", "population", "status", "services")
    + [CLEAN_DEMOGRAPHICS, LOCATION_BY_ZIP, CLEAN_POPULATION, LOCATION_JOINED, STD_SERVICES, STD_STATUS, STD_PROMOTION,
       FACTS_BASE_CTE]
    + [f"silver_{t} AS ({b})" for t, b in SILVER_BODIES.items()]
)

SUBJECTS = ("demographics", "location", "population", "status", "services")
MIN_ROWS = {"demographics": 7000, "location": 7000, "population": 1600, "services": 7000, "status": 7000}


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def count_rows(name: str, source: str, extra: str = "") -> str:
    return f"SELECT '{name}' AS table_name{extra}, CAST(count(*) AS BIGINT) AS row_count FROM {source}"


# ---------------------------------------------------------------- rules
SERVICE_FLAGS = (
    [f"{flag('phone_service', 'n/a')} AS phone_service", f"{flag('multiple_lines', 'No phone service')} AS multiple_lines"]
    + [f"{flag(src, 'Not applicable')} AS {out}" for out, src in ADD_ONS]
    + [f"{flag('referred_a_friend', 'No')} AS referred_a_friend"]
)
STANDARDIZE_FLAGS = with_(raw("services"), 'SELECT customer_id, "quarter", ' + ", ".join(SERVICE_FLAGS) + " FROM raw_services")

STANDARDIZE_MEMBERSHIP = with_(raw("demographics") + [CLEAN_DEMOGRAPHICS],
                               "SELECT customer_id, gender, marital_status FROM clean_demographics")

STANDARDIZE_SUBSTRING = with_(
    raw("services"),
    f'SELECT customer_id, "quarter", {CONTRACT} AS contract, {PAYMENT} AS payment_method, {OFFER} AS offer FROM raw_services',
)

INTERNET_BY_TYPE = f"""CASE WHEN {tu('internet_type')} = 'DSL' THEN 'DSL' WHEN {tu('internet_type')} LIKE '%FIBER%' THEN 'Fiber optic'
      WHEN {tu('internet_service')} = 'YES' THEN 'Yes' WHEN {tu('internet_service')} = 'NO' THEN 'None' ELSE 'None' END"""
STANDARDIZE_INTERNET = with_(
    raw("services"),
    f'SELECT customer_id, "quarter", {INTERNET} AS internet_service, {INTERNET_BY_TYPE} AS internet_service_by_type FROM raw_services',
)

BUCKET_AGE = with_(raw("demographics") + [CLEAN_DEMOGRAPHICS], "SELECT customer_id, age, age_group FROM clean_demographics")

BUCKET_DENSITY = with_(
    raw("population") + [CLEAN_POPULATION],
    """SELECT zip_code, population,
  CASE WHEN population >= 75000 THEN 'Urban' WHEN population >= 20000 THEN 'Suburban' ELSE 'Rural' END AS population_density
FROM clean_population""",
)

PACKAGE_ROWS = f"package_rows AS (SELECT *, {DERIVED} FROM (SELECT *, {TOTAL_SERVICES} AS total_services FROM std_services) t)"
_PKG = raw("services") + [STD_SERVICES, PACKAGE_ROWS]
BUCKET_SERVICE_TIER = with_(_PKG, 'SELECT customer_id, "quarter", total_services, service_tier FROM package_rows')
DERIVE_BUNDLE_TYPE = with_(_PKG, 'SELECT customer_id, "quarter", phone_service, internet_service, bundle_type FROM package_rows')
DERIVE_TOTAL_SERVICES = with_(
    _PKG, 'SELECT customer_id, "quarter", ' + ", ".join(o for o, _ in ADD_ONS) + ", total_services FROM package_rows"
)
DERIVE_FAMILY_SIZE = with_(raw("demographics") + [CLEAN_DEMOGRAPHICS],
                           "SELECT customer_id, marital_status, number_of_dependents, family_size FROM clean_demographics")

CLEAN_LOCATION_ROWS = f"""clean_location_rows AS (
  SELECT customer_id, {initcap('trim(city)')} AS city, lpad(trim(CAST(zip_code AS VARCHAR)), 5, '0') AS zip_code,
    round(latitude, 4) AS latitude, round(longitude, 4) AS longitude
  FROM raw_location)"""
CLEAN_LOCATION = with_(raw("location") + [CLEAN_LOCATION_ROWS], "SELECT * FROM clean_location_rows")

CLEAN_POPULATION_ROWS = with_(
    raw("population"),
    """SELECT id, lpad(trim(CAST(zip_code AS VARCHAR)), 5, '0') AS zip_code,
  CASE WHEN regexp_replace(population, '[^0-9.]', '', 'g') = '' THEN 0
       ELSE TRY_CAST(trunc(TRY_CAST(regexp_replace(population, '[^0-9.]', '', 'g') AS DOUBLE)) AS INTEGER) END AS population
FROM raw_population""",
)

# ---------------------------------------------------------------- relational
PROJECT_RENAME = with_(
    raw("services"),
    'SELECT customer_id, "quarter", tenure_in_months AS tenure_months, monthly_charge AS monthly_charges FROM raw_services',
)

CAST_MEASURES = with_(
    raw("services"),
    """SELECT customer_id, "quarter", CAST(tenure_in_months AS INTEGER) AS tenure_months,
  CAST(monthly_charge AS DECIMAL(10,2)) AS monthly_charges,
  CAST(avg_monthly_long_distance_charges AS DECIMAL(10,2)) AS avg_monthly_long_distance_charges,
  CAST(total_charges AS DECIMAL(10,2)) AS total_charges, CAST(total_revenue AS DECIMAL(10,2)) AS total_revenue,
  TRY_CAST(total_refunds AS DECIMAL(10,2)) AS total_refunds, CAST(total_extra_data_charges AS DECIMAL(10,2)) AS total_extra_data_charges,
  CAST(total_long_distance_charges AS DECIMAL(10,2)) AS total_long_distance_charges,
  CAST(avg_monthly_gb_download AS INTEGER) AS avg_monthly_gb_download, CAST(number_of_referrals AS INTEGER) AS number_of_referrals
FROM raw_services""",
)

FILTER_VALID_COORDINATES = with_(
    raw("location") + [CLEAN_LOCATION_ROWS],
    "SELECT * FROM clean_location_rows WHERE latitude >= -90 AND latitude <= 90 AND longitude >= -180 AND longitude <= 180",
)

LOCATION_POPULATION_JOIN = with_(
    DIM_LOCATION_CTES, "SELECT zip_code, city, latitude, longitude, population FROM location_joined"
)

DEDUP_BY_KEY = with_(
    raw("location"),
    """SELECT customer_id, zip_code, city, latitude, longitude FROM (
  SELECT *, row_number() OVER (PARTITION BY zip_code
    ORDER BY customer_id NULLS FIRST, city NULLS FIRST, latitude NULLS FIRST, longitude NULLS FIRST) AS rn
  FROM raw_location) r WHERE rn = 1""",
)

DEDUP_RATIO = with_(
    raw("services") + [STD_SERVICES],
    "SELECT CAST(sum(n) AS BIGINT) AS input_rows, CAST(count(*) AS BIGINT) AS distinct_rows,\n"
    "  CASE WHEN count(*) > 0 THEN round(CAST(sum(n) AS DOUBLE) / count(*), 6) END AS dedup_ratio\n"
    "FROM (SELECT " + ", ".join(PACKAGE_ATTRS) + ", count(*) AS n FROM std_services GROUP BY ALL) g",
)

# ---------------------------------------------------------------- keys
SEQ_KEY_CUSTOMER = with_(
    raw("demographics") + [CLEAN_DEMOGRAPHICS],
    "SELECT CAST(row_number() OVER (ORDER BY customer_id NULLS FIRST) AS BIGINT) AS customer_key, customer_id FROM clean_demographics",
)
SEQ_KEY_LOCATION = with_(
    DIM_LOCATION_CTES,
    "SELECT CAST(row_number() OVER (ORDER BY zip_code NULLS FIRST) AS BIGINT) AS location_key, zip_code FROM location_joined",
)

# ---------------------------------------------------------------- quality
DQ_MIN_ROWS = with_(
    raw(*SUBJECTS),
    union([f"SELECT '{t}' AS table_name, CAST({m} AS BIGINT) AS min_rows, CAST(count(*) AS BIGINT) AS actual_rows, "
           f"count(*) >= {m} AS passed FROM raw_{t}" for t, m in MIN_ROWS.items()]),
)

DQ_NON_EMPTY = with_(
    ALL_CTES,
    union([f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count, count(*) > 0 AS passed FROM silver_{t}"
           for t in SILVER_BODIES]),
)

_FACTS = raw("status", "services") + [FACTS_BASE_CTE]
DQ_GRAIN_DUPLICATES = with_(
    _FACTS,
    'SELECT CAST(count(*) AS BIGINT) AS duplicate_groups FROM (SELECT customer_id, "quarter" FROM facts '
    'GROUP BY customer_id, "quarter" HAVING count(*) > 1) g',
)
DQ_NULL_COUNTS = with_(
    _FACTS,
    'SELECT CAST(sum(CASE WHEN customer_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS customer_id, '
    'CAST(sum(CASE WHEN "quarter" IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS "quarter" FROM facts',
)
DQ_LOCATION_NULL_KEYS = with_(
    DIM_LOCATION_CTES + [f"silver_dim_location AS ({DIM_LOCATION_BODY})"],
    ", ".join(
        f"CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS {n}"
        for c, n in [("location_key", "null_keys"), ("city", "null_cities"), ("zip_code", "null_zips"),
                     ("latitude", "null_lat"), ("longitude", "null_long")]
    ).join(["SELECT ", " FROM silver_dim_location"]),
)
DQ_KEY_UNIQUE = with_(
    ALL_CTES,
    union([f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS \"rows\", CAST(count(*) AS BIGINT) AS distinct_keys "
           f"FROM silver_{t}" for t in ("dim_service_package", "dim_churn_status", "dim_promotion")]),
)

def _orphans(name: str, child: str, parent: str) -> str:
    return (
        f"SELECT '{name}' AS check_name, CAST(count(*) AS BIGINT) AS checked_rows, "
        f"CAST(count(*) FILTER (WHERE p.k IS NULL) AS BIGINT) AS orphan_rows, count(*) FILTER (WHERE p.k IS NULL) = 0 AS passed "
        f"FROM (SELECT k FROM ({child}) c0 WHERE k IS NOT NULL) c LEFT JOIN (SELECT DISTINCT k FROM ({parent}) p0) p ON c.k = p.k"
    )


DQ_REFERENTIAL_INTEGRITY = with_(
    raw("demographics", "status", "services") + [CLEAN_DEMOGRAPHICS] + raw("location") + [CLEAN_LOCATION_ROWS]
    + raw("population"),
    union([
        _orphans("status_customer", "SELECT trim(customer_id) AS k FROM raw_status", "SELECT customer_id AS k FROM clean_demographics"),
        _orphans("services_customer", "SELECT trim(customer_id) AS k FROM raw_services", "SELECT customer_id AS k FROM clean_demographics"),
        _orphans("location_zip", "SELECT zip_code AS k FROM clean_location_rows",
                 "SELECT lpad(trim(CAST(zip_code AS VARCHAR)), 5, '0') AS k FROM raw_population"),
    ]),
)


def _unparsable_int(x: str) -> str:
    # try_cast(text AS INT): optional sign and digits only (after trimming), within INT range
    return (f"count(*) FILTER (WHERE {x} IS NOT NULL AND NOT coalesce(regexp_full_match(trim({x}), '[+-]?[0-9]+') "
            f"AND TRY_CAST(trim({x}) AS INTEGER) IS NOT NULL, false))")


DQ_TYPE_CONSISTENCY = with_(
    raw("population"),
    union([
        f"SELECT '{c}' AS column_name, 'int' AS expected_type, CAST(count(v) AS BIGINT) AS non_null_values, "
        f"CAST({_unparsable_int('v')} AS BIGINT) AS unparsable_values "
        f"FROM (SELECT NULLIF(CAST({c} AS VARCHAR), '') AS v FROM raw_population) t"
        for c in ("id", "zip_code", "population")
    ]),
)

PROFILED = ("tenure_months", "monthly_charges", "total_revenue", "cltv")
PROFILE_MEASURES = with_(
    _FACTS,
    union([f"""SELECT '{c}' AS measure, CAST(count({c}) AS BIGINT) AS "count", round(CAST(avg({c}) AS DOUBLE), 6) AS mean,
  round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS stddev, CAST(min({c}) AS DOUBLE) AS "min", CAST(max({c}) AS DOUBLE) AS "max"
FROM facts""" for c in PROFILED]),
)

LAYER_ROW_COUNTS = with_(
    ALL_CTES,
    union([f"SELECT 'bronze' AS layer, '{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM raw_{t}" for t in SUBJECTS]
          + [f"SELECT 'silver' AS layer, '{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM silver_{t}"
             for t in SILVER_BODIES]),
)

# ---------------------------------------------------------------- bronze, catalog, flows
BRONZE_LINEAGE_COLUMNS = with_(raw("population"),
                               "SELECT *, 'Telco_customer_churn_population.csv' AS source_file FROM raw_population")
# A delimited file has no way to tell an empty text from a missing one: with the
# reader's defaults an empty field (quoted or not) loads as NULL.
BRONZE_INGEST_POPULATION = with_(
    raw("population"),
    "SELECT id, zip_code, NULLIF(population, '') AS population, 'Telco_customer_churn_population.csv' AS source_file "
    "FROM raw_population",
)
BRONZE_ROUNDTRIP = with_(raw("services"), "SELECT *, 'Telco_customer_churn_services.csv' AS source_file FROM raw_services")

CATALOG_TABLES = with_(
    raw(*SUBJECTS),
    union([f"SELECT '{t}' AS table_name, 'EXTERNAL' AS table_type, CAST(count(*) AS BIGINT) AS row_count FROM raw_{t}"
           for t in SUBJECTS]),
)



def digest(columns: dict[str, str]) -> str:
    """Sum of the first 40 bits of the rows' MD5; ``columns`` names each column's kind."""
    whole = {c: f'CAST(round("{c}" * 10000) AS BIGINT)' if kind == "double" else f'"{c}"' for c, kind in columns.items()}
    text = ", ".join(f"coalesce(CAST({whole[c]} AS VARCHAR), '~')" for c in sorted(columns))
    return f"CAST(sum(CAST('0x' || md5(concat_ws('|', {text}))[1:10] AS BIGINT)) AS BIGINT)"


# columns of the silver tables as declared, without hash keys: name and kind
SILVER_COLUMNS = {
    "dim_customer": "customer_key customer_id age age_group gender marital_status number_of_dependents family_size",
    "dim_location": "location_key city zip_code latitude:double longitude:double population population_density",
    "dim_service_package": " ".join([*PACKAGE_ATTRS, "total_services", "service_tier", "bundle_type"]),
    "dim_churn_status": " ".join(CHURN_ATTRS),
    "dim_quarter": "quarter_key quarter_name year quarter_of_year half_of_year",
    "dim_promotion": "offer referred_a_friend",
    "facts_base": "customer_id quarter tenure_months satisfaction_score churn_value churn_score cltv monthly_charges "
    "avg_monthly_long_distance_charges total_charges total_revenue total_refunds total_extra_data_charges "
    "total_long_distance_charges avg_monthly_gb_download number_of_referrals",
}


def kinds(columns: str) -> dict[str, str]:
    return {c.split(":")[0]: c.partition(":")[2] for c in columns.split()}


SILVER_BUILD_ALL = with_(
    ALL_CTES,
    union([f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count, 'success' AS status FROM silver_{t}"
           for t in SILVER_BODIES]),
)
SILVER_BUILD_CONTENT = with_(
    ALL_CTES,
    union([f"SELECT '{t}' AS table_name, {digest(kinds(SILVER_COLUMNS[t]))} AS content_digest FROM silver_{t}"
           for t in SILVER_BODIES]),
)

# Text columns of each raw subject: after a round trip through a delimited file
# an empty text loads as NULL (reader defaults), so the flow oracle applies
# NULLIF(col, '') to exactly these.
TEXT_COLUMNS = {
    "demographics": ["customer_id", "gender", "married"],
    "location": ["customer_id", "city"],
    "population": ["population"],
    "status": ["customer_id", "quarter", "customer_status", "churn_category", "churn_reason"],
    "services": ["customer_id", "quarter", "phone_service", "multiple_lines", "online_security", "online_backup",
                 "device_protection_plan", "premium_tech_support", "streaming_tv", "streaming_movies",
                 "streaming_music", "unlimited_data", "referred_a_friend", "internet_service", "internet_type",
                 "offer", "contract", "payment_method"],
}


def loaded(*subjects: str) -> list[str]:
    out = []
    for s in subjects:
        repl = ", ".join(f'NULLIF("{c}", \'\') AS "{c}"' for c in TEXT_COLUMNS[s])
        out.append(f"raw_{s} AS (SELECT * REPLACE ({repl}) FROM ({duckdb_view_sql(s)}) v)")
    return out


# values that the staged files hold in place of a number: table -> column, the rows, the text
DIRT = {
    "demographics": ("age", "number_of_dependents = 3", "unknown"),
    "services": ("total_charges", "tenure_in_months = 7", "12,50"),
    "status": ("cltv", "satisfaction_score = 5", "99999999999"),
}


def dirty(*subjects: str) -> list[str]:
    """The raw subjects as loaded from files with dirt: such a value is NULL."""
    out = []
    for cte, s in zip(loaded(*subjects), subjects):
        if s in DIRT:
            column, where, _ = DIRT[s]
            cte = f"raw_{s} AS (SELECT * REPLACE (CASE WHEN {where} THEN NULL ELSE {column} END AS {column}) FROM ({cte[cte.index('(') + 1 : -1]}) w)"
        out.append(cte)
    return out


def rejected(s: str) -> str:
    """Values of a subject that are rejected."""
    return f"(SELECT CAST(count(*) AS BIGINT) FROM raw_{s} WHERE {DIRT[s][1]})" if s in DIRT else "CAST(0 AS BIGINT)"


ALL_CTES_LOADED = dirty(*SUBJECTS) + ALL_CTES[len(SUBJECTS):]

_BRONZE_OK = " AND ".join(f"(SELECT count(*) FROM raw_{t}) >= {m}" for t, m in MIN_ROWS.items())
LOAD_AUDIT = with_(
    ALL_CTES_LOADED,
    union([f"SELECT 'bronze' AS layer, '{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count, "
           f"{rejected(t)} AS rejected_values, CAST(0 AS BIGINT) AS unparsable_quarters, "
           f"CASE WHEN {_BRONZE_OK} THEN 'success' ELSE 'failed' END AS status FROM raw_{t}" for t in SUBJECTS]
          + [f"SELECT 'silver' AS layer, '{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count, CAST(0 AS BIGINT), "
             + ("CAST(count(*) FILTER (WHERE quarter_key IS NULL) AS BIGINT)" if t == "dim_quarter" else "CAST(0 AS BIGINT)")
             + f", 'success' AS status FROM silver_{t}" for t in SILVER_BODIES]),
)

# columns of the raw subjects: name and kind
RAW_COLUMNS = {
    "demographics": "customer_id count gender age married number_of_dependents",
    "location": "customer_id zip_code city latitude:double longitude:double",
    "population": "id zip_code population",
    "status": "customer_id quarter satisfaction_score churn_value churn_score cltv customer_status churn_category churn_reason",
    "services": "customer_id quarter phone_service multiple_lines online_security online_backup device_protection_plan "
    "premium_tech_support streaming_tv streaming_movies streaming_music unlimited_data referred_a_friend internet_service "
    "internet_type offer contract payment_method tenure_in_months number_of_referrals avg_monthly_gb_download "
    "monthly_charge:double avg_monthly_long_distance_charges:double total_charges:double total_refunds:double "
    "total_extra_data_charges total_long_distance_charges:double total_revenue:double",
}


def _ingested(s: str) -> str:
    rescued = f"CASE WHEN {DIRT[s][1]} THEN '{DIRT[s][2]}' ELSE '' END" if s in DIRT else "''"
    columns = kinds(RAW_COLUMNS[s] + " source_file rescued")
    return (
        f"SELECT '{s}' AS table_name, CAST({MIN_ROWS[s]} AS BIGINT) AS min_rows, CAST(count(*) AS BIGINT) AS actual_rows, "
        f"count(*) >= {MIN_ROWS[s]} AS passed, {digest(columns)} AS content_digest, {rejected(s)} AS rejected_values "
        f"FROM (SELECT *, 'Telco_customer_churn_{s}.csv' AS source_file, {rescued} AS rescued FROM raw_{s}) x"
    )


BRONZE_INGEST_ALL = with_(dirty(*SUBJECTS), union([_ingested(s) for s in SUBJECTS]))


def _bronze_report() -> str:
    parts = [f"SELECT 'rejected_values' AS check_name, '{s}' AS table_name, '{c}' AS column_name, CAST({rejected(s)} AS DOUBLE) AS value "
             f"WHERE {rejected(s)} > 0" for s, (c, _, _) in DIRT.items()]
    for s, columns in (("demographics", ["customer_id"]), ("location", ["customer_id", "zip_code"]), ("population", ["zip_code"]),
                       ("services", ["customer_id", "quarter"]), ("status", ["customer_id", "quarter"])):
        parts += [f"SELECT 'null_count', '{s}', '{c}', CAST(count(*) FILTER (WHERE \"{c}\" IS NULL) AS DOUBLE) FROM raw_{s}"
                  for c in columns]
    zips = "lpad(trim(CAST(zip_code AS VARCHAR)), 5, '0')"
    for s, child, column, parent in (
        ("status", "trim(customer_id)", "customer_id", "SELECT trim(customer_id) AS k FROM raw_demographics"),
        ("services", "trim(customer_id)", "customer_id", "SELECT trim(customer_id) AS k FROM raw_demographics"),
        ("location", zips, "zip_code", f"SELECT {zips} AS k FROM raw_population"),
    ):
        parts.append(f"SELECT 'orphan_rows', '{s}', '{column}', CAST(count(*) AS DOUBLE) FROM (SELECT {child} AS k FROM raw_{s}) c "
                     f"WHERE k IS NOT NULL AND k NOT IN (SELECT k FROM ({parent}) p WHERE k IS NOT NULL)")
    return with_(dirty(*SUBJECTS), union(parts))


BRONZE_QUALITY_REPORT = _bronze_report()

# yesterday's customers have numbers 50 higher
DIM_CUSTOMER_REGISTRY = with_(
    raw("demographics") + [CLEAN_DEMOGRAPHICS, f"today AS ({DIM_CUSTOMER_BODY})",
    """yesterday AS (SELECT customer_key, 'Customer#' || lpad(CAST(CAST(regexp_extract(customer_id, '(\\d+)', 1) AS BIGINT) + 50 AS VARCHAR), 9, '0')
       AS customer_id FROM today)"""],
    """SELECT t.* REPLACE (CAST(coalesce(y.customer_key, (SELECT max(customer_key) FROM yesterday)
         + row_number() OVER (PARTITION BY y.customer_key IS NULL ORDER BY t.customer_id)) AS BIGINT) AS customer_key)
       FROM today t LEFT JOIN yesterday y ON t.customer_id = y.customer_id""",
)

# unlimited data stands in for paperless billing
SILVER_SCHEMA_EVOLUTION = with_(
    raw("services") + [STD_SERVICES.replace("\nFROM raw_services", f", {flag('unlimited_data', 'Not applicable')} AS paperless_billing\nFROM raw_services")],
    "SELECT " + ", ".join(PACKAGE_ATTRS) + ", paperless_billing, total_services, " + DERIVED + "\nFROM (SELECT *, " + TOTAL_SERVICES
    + " AS total_services FROM (SELECT DISTINCT " + ", ".join(PACKAGE_ATTRS) + ", paperless_billing FROM std_services) d) t",
)


# The data dictionary that the silver tables must have, written out: table, column, type, comment
DICTIONARY = """
dim_customer customer_key bigint Surrogate key, sequential by customer_id
dim_customer customer_id string Natural key from the source
dim_customer age int Age in years
dim_customer age_group string 18-24, 25-34, 35-44, 45-54, 55-64, 65+
dim_customer gender string Male / Female / n/a
dim_customer marital_status string Married / Single / n/a
dim_customer number_of_dependents int Number of dependents
dim_customer family_size int Customer + spouse when married + dependents
dim_service_package service_package_key bigint Hash key of the 13 attributes
dim_service_package phone_service string Yes / No / n/a
dim_service_package multiple_lines string Yes / No / No phone service
dim_service_package internet_service string DSL / Fiber optic / None (Yes when only the flag is known)
dim_service_package online_security string Yes / No / Not applicable
dim_service_package online_backup string Yes / No / Not applicable
dim_service_package device_protection string Yes / No / Not applicable
dim_service_package tech_support string Yes / No / Not applicable
dim_service_package streaming_tv string Yes / No / Not applicable
dim_service_package streaming_movies string Yes / No / Not applicable
dim_service_package streaming_music string Yes / No / Not applicable
dim_service_package unlimited_data string Yes / No / Not applicable
dim_service_package contract string Month-to-month / One year / Two year
dim_service_package payment_method string Bank transfer / Credit card / Electronic check / Mailed check / Unknown
dim_service_package total_services int Number of add-on services (0-8)
dim_service_package service_tier string Basic (0) / Standard (1-2) / Premium (3+)
dim_service_package bundle_type string Double play / Single service / No service
dim_location location_key bigint Surrogate key, sequential by zip_code
dim_location city string City, title case
dim_location zip_code string 5-character ZIP
dim_location latitude double Latitude, 4 decimals
dim_location longitude double Longitude, 4 decimals
dim_location population int Population of the ZIP; NULL when unknown
dim_location population_density string Urban / Suburban / Rural
dim_churn_status churn_status_key bigint Hash key of the 3 attributes
dim_churn_status customer_status string Churned / Active / New / n/a
dim_churn_status churn_category string Category when churned, else n/a
dim_churn_status churn_reason string Reason when churned, else n/a
dim_quarter quarter_key int Smart key YYYYQ as year * 100 + quarter
dim_quarter quarter_name string Source quarter and year, e.g. Q3-2025
dim_quarter year int Business year
dim_quarter quarter_of_year int 1-4
dim_quarter half_of_year string H1 / H2
dim_promotion promotion_key bigint Hash key of the 2 attributes
dim_promotion offer string Offer A-E / None
dim_promotion referred_a_friend string Yes / No
facts_base customer_id string Customer natural key
facts_base quarter string Source quarter, e.g. Q3
facts_base tenure_months int Tenure in months
facts_base satisfaction_score int 1-5
facts_base churn_value int 1 when churned
facts_base churn_score int 0-100
facts_base cltv int Customer lifetime value
facts_base monthly_charges decimal(10,2) Monthly charge
facts_base avg_monthly_long_distance_charges decimal(10,2) Average monthly long distance charge
facts_base total_charges decimal(10,2) Total charges
facts_base total_revenue decimal(10,2) Total revenue
facts_base total_refunds decimal(10,2) Total refunds
facts_base total_extra_data_charges decimal(10,2) Total extra data charges
facts_base total_long_distance_charges decimal(10,2) Total long distance charges
facts_base avg_monthly_gb_download int Average monthly download in GB
facts_base number_of_referrals int Number of referrals
"""


def _data_dictionary() -> str:
    hash_keys = {"service_package_key", "churn_status_key", "promotion_key"}
    parts = []
    for line in DICTIONARY.strip().splitlines():
        t, column, kind, comment = line.split(" ", 3)
        counted = "*" if column in hash_keys else f'"{column}"'
        parts.append(
            f"SELECT '{t}' AS table_name, '{column}' AS column_name, '{kind}' AS data_type, "
            f"'{comment.replace("'", "''")}' AS comment, CAST(count({counted}) AS BIGINT) AS non_null_count FROM silver_{t}"
        )
    return with_(ALL_CTES, union(parts))


CATALOG_DATA_DICTIONARY = _data_dictionary()


# ---------------------------------------------------------------- keyed facts
QUARTER_KEY = "CAST(2025 * 100 + TRY_CAST(regexp_extract(s.\"quarter\", 'Q(\\d)', 1) AS INTEGER) AS INTEGER)"

# every services / status row with its standardized attributes (prefixed), so a
# fact row can be matched to its dimension row on attributes
_PKG_FULL = ", ".join(
    [f"{flag('phone_service', 'n/a')} AS pk_phone_service", f"{flag('multiple_lines', 'No phone service')} AS pk_multiple_lines",
     f"{INTERNET} AS pk_internet_service"]
    + [f"{flag(src, 'Not applicable')} AS pk_{out}" for out, src in ADD_ONS]
    + [f"{CONTRACT} AS pk_contract", f"{PAYMENT} AS pk_payment_method",
       f"{OFFER} AS pr_offer", f"{flag('referred_a_friend', 'No')} AS pr_referred_a_friend"]
)
SERVICES_FULL = f"services_full AS (SELECT *, {_PKG_FULL} FROM raw_services)"
STATUS_FULL = f"""status_full AS (
  SELECT *, CASE WHEN st_customer_status = 'Churned' THEN coalesce(cat, 'n/a') ELSE 'n/a' END AS st_churn_category,
    CASE WHEN st_customer_status = 'Churned' THEN coalesce(reason, 'n/a') ELSE 'n/a' END AS st_churn_reason
  FROM (SELECT *,
      CASE WHEN trim({initcap('customer_status')}) IN ('Churned', 'Churn') THEN 'Churned'
           WHEN trim({initcap('customer_status')}) IN ('Stayed', 'Stay', 'Active', 'Retained') THEN 'Active'
           WHEN trim({initcap('customer_status')}) IN ('Joined', 'New') THEN 'New' ELSE 'n/a' END AS st_customer_status,
      trim({initcap('churn_category')}) AS cat, trim(churn_reason) AS reason
    FROM raw_status) x)"""
FK_ROWS = (
    f"fk AS (SELECT trim(s.customer_id) AS customer_id, {QUARTER_KEY} AS quarter_key, s.st_customer_status, "
    "s.st_churn_category, s.st_churn_reason, " + ", ".join(f"v.pk_{a}" for a in PACKAGE_ATTRS)
    + ", v.pr_offer, v.pr_referred_a_friend FROM status_full s JOIN services_full v "
    "ON s.customer_id = v.customer_id AND s.quarter = v.quarter)"
)
FACTS_KEYED_CTE = (
    f"facts_k AS (SELECT {FACT_SELECT}, {QUARTER_KEY} AS quarter_key, s.st_customer_status, s.st_churn_category, "
    "s.st_churn_reason, " + ", ".join(f"v.pk_{a}" for a in PACKAGE_ATTRS)
    + ", v.pr_offer, v.pr_referred_a_friend FROM status_full s JOIN services_full v "
    "ON s.customer_id = v.customer_id AND s.quarter = v.quarter)"
)


def _member(alias: str, prefix: str, columns: list[str]) -> str:
    return " AND ".join(f"f.{prefix}_{c} = {alias}.{c}" for c in columns)


FACTS_KEYED = with_(
    raw("status", "services", "demographics")
    + [CLEAN_DEMOGRAPHICS, STD_SERVICES, STD_STATUS, STD_PROMOTION, SERVICES_FULL, STATUS_FULL, FACTS_KEYED_CTE,
       f"silver_dim_customer AS ({DIM_CUSTOMER_BODY})", f"packages AS MATERIALIZED ({KEYED_SERVICE_PACKAGE})",
       f"statuses AS MATERIALIZED ({KEYED_CHURN_STATUS})", f"promotions AS MATERIALIZED ({KEYED_PROMOTION})"],
    "SELECT c.customer_key, p.service_package_key, o.promotion_key, t.churn_status_key, "
    "f.* EXCLUDE (st_customer_status, st_churn_category, st_churn_reason, pr_offer, pr_referred_a_friend, "
    + ", ".join(f"pk_{a}" for a in PACKAGE_ATTRS)
    + ") FROM facts_k f LEFT JOIN (SELECT customer_id, min(customer_key) AS customer_key "
    "FROM silver_dim_customer GROUP BY customer_id) c ON f.customer_id = c.customer_id\n"
    f"LEFT JOIN packages p ON {_member('p', 'pk', PACKAGE_ATTRS)}\n"
    f"LEFT JOIN promotions o ON {_member('o', 'pr', ['offer', 'referred_a_friend'])}\n"
    f"LEFT JOIN statuses t ON {_member('t', 'st', CHURN_ATTRS)}",
)


def _fk_check(name: str, join: str, present: str, key_not_null: str = "TRUE") -> str:
    return (
        f"SELECT '{name}' AS check_name, CAST(count(*) AS BIGINT) AS checked_rows, "
        f"CAST(count(*) FILTER (WHERE {present} IS NULL) AS BIGINT) AS orphan_rows, "
        f"count(*) FILTER (WHERE {present} IS NULL) = 0 AS passed FROM (SELECT * FROM fk WHERE {key_not_null}) f {join}"
    )


DQ_FACT_DIMENSION_KEYS = with_(
    ALL_CTES + [SERVICES_FULL, STATUS_FULL, FK_ROWS],
    union([
        # the customer key comes from the dimension itself: only rows that found one carry a key
        _fk_check("customer_key", "JOIN silver_dim_customer d ON f.customer_id = d.customer_id", "d.customer_key"),
        _fk_check("quarter_key", "LEFT JOIN silver_dim_quarter d ON f.quarter_key = d.quarter_key", "d.quarter_key",
                  "quarter_key IS NOT NULL"),
        _fk_check("service_package_key", "LEFT JOIN silver_dim_service_package d ON "
                  + " AND ".join(f"f.pk_{a} = d.{a}" for a in PACKAGE_ATTRS), "d.phone_service"),
        _fk_check("promotion_key", "LEFT JOIN silver_dim_promotion d ON f.pr_offer = d.offer "
                  "AND f.pr_referred_a_friend = d.referred_a_friend", "d.offer"),
        _fk_check("churn_status_key", "LEFT JOIN silver_dim_churn_status d ON f.st_customer_status = d.customer_status "
                  "AND f.st_churn_category = d.churn_category AND f.st_churn_reason = d.churn_reason", "d.customer_status"),
    ]),
)


def _silver_report() -> str:
    def f(x):
        return f"CAST({x} AS DOUBLE)"

    parts = [
        "SELECT 'grain_duplicates' AS check_name, 'facts_base' AS table_name, 'customer_id,quarter' AS column_name, "
        f"{f('count(*)')} AS value FROM (SELECT customer_id, \"quarter\" FROM silver_facts_base "
        "GROUP BY customer_id, \"quarter\" HAVING count(*) > 1) g"
    ]
    for t, cols in (("facts_base", ("customer_id", "quarter")),
                    ("dim_location", ("location_key", "city", "zip_code", "latitude", "longitude"))):
        parts += [f"SELECT 'null_count', '{t}', '{c}', {f(f'sum(CASE WHEN \"{c}\" IS NULL THEN 1 ELSE 0 END)')} "
                  f"FROM silver_{t}" for c in cols]
    for c in PROFILED:
        x = f'"{c}"'
        parts += [
            f"SELECT 'profile_count', 'facts_base', '{c}', {f(f'count({x})')} FROM silver_facts_base",
            f"SELECT 'profile_mean', 'facts_base', '{c}', round(CAST(avg({x}) AS DOUBLE), 6) FROM silver_facts_base",
            f"SELECT 'profile_stddev', 'facts_base', '{c}', round(stddev_samp(CAST({x} AS DOUBLE)), 6) FROM silver_facts_base",
            f"SELECT 'profile_min', 'facts_base', '{c}', {f(f'min({x})')} FROM silver_facts_base",
            f"SELECT 'profile_max', 'facts_base', '{c}', {f(f'max({x})')} FROM silver_facts_base",
        ]
    return with_(ALL_CTES, union(parts))


SILVER_QUALITY_REPORT = _silver_report()


ORACLES: dict[str, str] = {
    "dim_customer": DIM_CUSTOMER,
    "dim_location": DIM_LOCATION,
    "dim_location_scd1": DIM_LOCATION_SCD1,
    "dim_service_package": DIM_SERVICE_PACKAGE,
    "dim_churn_status": DIM_CHURN_STATUS,
    "dim_promotion": DIM_PROMOTION,
    "dim_quarter": DIM_QUARTER,
    "facts_base": FACTS_BASE,
    "facts_base_hot_split": FACTS_BASE,
    "facts_base_grain_safe": FACTS_BASE_GRAIN_SAFE,
    "facts_keyed": FACTS_KEYED,
    "standardize_flags": STANDARDIZE_FLAGS,
    "standardize_membership": STANDARDIZE_MEMBERSHIP,
    "standardize_substring": STANDARDIZE_SUBSTRING,
    "standardize_internet": STANDARDIZE_INTERNET,
    "bucket_age": BUCKET_AGE,
    "bucket_density": BUCKET_DENSITY,
    "bucket_service_tier": BUCKET_SERVICE_TIER,
    "derive_bundle_type": DERIVE_BUNDLE_TYPE,
    "derive_family_size": DERIVE_FAMILY_SIZE,
    "derive_total_services": DERIVE_TOTAL_SERVICES,
    "clean_location": CLEAN_LOCATION,
    "clean_population": CLEAN_POPULATION_ROWS,
    "project_rename": PROJECT_RENAME,
    "cast_measures": CAST_MEASURES,
    "filter_valid_coordinates": FILTER_VALID_COORDINATES,
    "location_population_join": LOCATION_POPULATION_JOIN,
    "dedup_by_key": DEDUP_BY_KEY,
    "dedup_ratio": DEDUP_RATIO,
    "seq_key_customer": SEQ_KEY_CUSTOMER,
    "seq_key_location": SEQ_KEY_LOCATION,
    "hash_key_service_package": DIM_SERVICE_PACKAGE,
    "hash_key_churn_status": DIM_CHURN_STATUS,
    "hash_key_promotion": DIM_PROMOTION,
    "dq_min_rows": DQ_MIN_ROWS,
    "dq_non_empty": DQ_NON_EMPTY,
    "dq_grain_duplicates": DQ_GRAIN_DUPLICATES,
    "dq_null_counts": DQ_NULL_COUNTS,
    "dq_location_null_keys": DQ_LOCATION_NULL_KEYS,
    "dq_key_unique": DQ_KEY_UNIQUE,
    "dq_referential_integrity": DQ_REFERENTIAL_INTEGRITY,
    "dq_type_consistency": DQ_TYPE_CONSISTENCY,
    "dq_fact_dimension_keys": DQ_FACT_DIMENSION_KEYS,
    "profile_measures": PROFILE_MEASURES,
    "layer_row_counts": LAYER_ROW_COUNTS,
    "bronze_lineage_columns": BRONZE_LINEAGE_COLUMNS,
    "bronze_roundtrip": BRONZE_ROUNDTRIP,
    "bronze_ingest_population": BRONZE_INGEST_POPULATION,
    "bronze_ingest_all": BRONZE_INGEST_ALL,
    "catalog_tables": CATALOG_TABLES,
    "catalog_data_dictionary": CATALOG_DATA_DICTIONARY,
    "silver_write_keeps_schema": DIM_CUSTOMER,
    "silver_build_all": SILVER_BUILD_ALL,
    "silver_build_content": SILVER_BUILD_CONTENT,
    "silver_quality_report": SILVER_QUALITY_REPORT,
    "silver_location_scd1": DIM_LOCATION_SCD1,
    "silver_keyed_facts": FACTS_KEYED,
    "silver_schema_evolution": SILVER_SCHEMA_EVOLUTION,
    "bronze_quality_report": BRONZE_QUALITY_REPORT,
    "facts_by_quarter": FACTS_BASE,
    "facts_bucketed": FACTS_BASE,
    "dim_customer_registry": DIM_CUSTOMER_REGISTRY,
    "load_audit": LOAD_AUDIT,
}
