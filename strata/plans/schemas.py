"""Declared schemas of the bronze and silver tables, with column comments.

These ``StructType``s are the single source of column order (final ``select``),
types (casts before a write) and the data dictionary (comments in the catalog).
Keys are BIGINT as declared, including the sequential ones.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _f(name: str, dtype: T.DataType, comment: str | None = None) -> T.StructField:
    return T.StructField(name, dtype, True, {"comment": comment} if comment else {})


S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
MONEY = T.DecimalType(10, 2)
TS = T.TimestampType()

LINEAGE = [_f("ingestion_timestamp", TS, "Load time of the run"), _f("source_file", S, "Name of the source file")]

# ---------------------------------------------------------------- bronze
BRONZE: dict[str, T.StructType] = {
    "population": T.StructType([_f("id", I), _f("zip_code", I), _f("population", S), *LINEAGE]),
    "demographics": T.StructType(
        [
            _f("customer_id", S),
            _f("count", I),
            _f("gender", S),
            _f("age", I),
            _f("under_30", S),
            _f("senior_citizen", S),
            _f("married", S),
            _f("dependents", S),
            _f("number_of_dependents", I),
            *LINEAGE,
        ]
    ),
    "status": T.StructType(
        [
            _f("customer_id", S),
            _f("count", I),
            _f("quarter", S),
            _f("satisfaction_score", I),
            _f("customer_status", S),
            _f("churn_label", S),
            _f("churn_value", I),
            _f("churn_score", I),
            _f("cltv", I),
            _f("churn_category", S),
            _f("churn_reason", S),
            *LINEAGE,
        ]
    ),
    "location": T.StructType(
        [
            _f("customer_id", S),
            _f("count", I),
            _f("country", S),
            _f("state", S),
            _f("city", S),
            _f("zip_code", I),
            _f("lat_long", S),
            _f("latitude", D),
            _f("longitude", D),
            *LINEAGE,
        ]
    ),
    "services": T.StructType(
        [
            _f("customer_id", S),
            _f("count", I),
            _f("quarter", S),
            _f("referred_a_friend", S),
            _f("number_of_referrals", I),
            _f("tenure_in_months", I),
            _f("offer", S),
            _f("phone_service", S),
            _f("avg_monthly_long_distance_charges", D),
            _f("multiple_lines", S),
            _f("internet_service", S),
            _f("internet_type", S),
            _f("avg_monthly_gb_download", I),
            _f("online_security", S),
            _f("online_backup", S),
            _f("device_protection_plan", S),
            _f("premium_tech_support", S),
            _f("streaming_tv", S),
            _f("streaming_movies", S),
            _f("streaming_music", S),
            _f("unlimited_data", S),
            _f("contract", S),
            _f("paperless_billing", S),
            _f("payment_method", S),
            _f("monthly_charge", D),
            _f("total_charges", D),
            _f("total_refunds", D),
            _f("total_extra_data_charges", I),
            _f("total_long_distance_charges", D),
            _f("total_revenue", D),
            *LINEAGE,
        ]
    ),
}


def bronze_file_schema(table: str) -> T.StructType:
    """Schema of the delimited file itself (the declared table minus lineage)."""
    lineage = {f.name for f in LINEAGE}
    return T.StructType([f for f in BRONZE[table].fields if f.name not in lineage])


# ---------------------------------------------------------------- silver
_YN = "Yes / No / Not applicable"

SILVER: dict[str, T.StructType] = {
    "dim_customer": T.StructType(
        [
            _f("customer_key", L, "Surrogate key, sequential by customer_id"),
            _f("customer_id", S, "Natural key from the source"),
            _f("age", I, "Age in years"),
            _f("age_group", S, "18-24, 25-34, 35-44, 45-54, 55-64, 65+"),
            _f("gender", S, "Male / Female / n/a"),
            _f("marital_status", S, "Married / Single / n/a"),
            _f("number_of_dependents", I, "Number of dependents"),
            _f("family_size", I, "Customer + spouse when married + dependents"),
        ]
    ),
    "dim_service_package": T.StructType(
        [
            _f("service_package_key", L, "Hash key of the 13 attributes"),
            _f("phone_service", S, "Yes / No / n/a"),
            _f("multiple_lines", S, "Yes / No / No phone service"),
            _f("internet_service", S, "DSL / Fiber optic / None (Yes when only the flag is known)"),
            _f("online_security", S, _YN),
            _f("online_backup", S, _YN),
            _f("device_protection", S, _YN),
            _f("tech_support", S, _YN),
            _f("streaming_tv", S, _YN),
            _f("streaming_movies", S, _YN),
            _f("streaming_music", S, _YN),
            _f("unlimited_data", S, _YN),
            _f("contract", S, "Month-to-month / One year / Two year"),
            _f("payment_method", S, "Bank transfer / Credit card / Electronic check / Mailed check / Unknown"),
            _f("total_services", I, "Number of add-on services (0-8)"),
            _f("service_tier", S, "Basic (0) / Standard (1-2) / Premium (3+)"),
            _f("bundle_type", S, "Double play / Single service / No service"),
        ]
    ),
    "dim_location": T.StructType(
        [
            _f("location_key", L, "Surrogate key, sequential by zip_code"),
            _f("city", S, "City, title case"),
            _f("zip_code", S, "5-character ZIP"),
            _f("latitude", D, "Latitude, 4 decimals"),
            _f("longitude", D, "Longitude, 4 decimals"),
            _f("population", I, "Population of the ZIP; NULL when unknown"),
            _f("population_density", S, "Urban / Suburban / Rural"),
        ]
    ),
    "dim_churn_status": T.StructType(
        [
            _f("churn_status_key", L, "Hash key of the 3 attributes"),
            _f("customer_status", S, "Churned / Active / New / n/a"),
            _f("churn_category", S, "Category when churned, else n/a"),
            _f("churn_reason", S, "Reason when churned, else n/a"),
        ]
    ),
    "dim_quarter": T.StructType(
        [
            _f("quarter_key", I, "Smart key YYYYQ as year * 100 + quarter"),
            _f("quarter_name", S, "Source quarter and year, e.g. Q3-2025"),
            _f("year", I, "Business year"),
            _f("quarter_of_year", I, "1-4"),
            _f("half_of_year", S, "H1 / H2"),
        ]
    ),
    "dim_promotion": T.StructType(
        [
            _f("promotion_key", L, "Hash key of the 2 attributes"),
            _f("offer", S, "Offer A-E / None"),
            _f("referred_a_friend", S, "Yes / No"),
        ]
    ),
    "facts_base": T.StructType(
        [
            _f("customer_id", S, "Customer natural key"),
            _f("quarter", S, "Source quarter, e.g. Q3"),
            _f("tenure_months", I, "Tenure in months"),
            _f("satisfaction_score", I, "1-5"),
            _f("churn_value", I, "1 when churned"),
            _f("churn_score", I, "0-100"),
            _f("cltv", I, "Customer lifetime value"),
            _f("monthly_charges", MONEY, "Monthly charge"),
            _f("avg_monthly_long_distance_charges", MONEY, "Average monthly long distance charge"),
            _f("total_charges", MONEY, "Total charges"),
            _f("total_revenue", MONEY, "Total revenue"),
            _f("total_refunds", MONEY, "Total refunds"),
            _f("total_extra_data_charges", MONEY, "Total extra data charges"),
            _f("total_long_distance_charges", MONEY, "Total long distance charges"),
            _f("avg_monthly_gb_download", I, "Average monthly download in GB"),
            _f("number_of_referrals", I, "Number of referrals"),
        ]
    ),
}

# facts with the keys of their dimensions, as an option of the silver flow
FACTS_KEYED = T.StructType(
    [
        _f("customer_key", L, "Key of the customer"),
        _f("quarter_key", I, "Key of the quarter"),
        _f("service_package_key", L, "Key of the service package"),
        _f("promotion_key", L, "Key of the promotion"),
        _f("churn_status_key", L, "Key of the churn status"),
        *SILVER["facts_base"].fields,
    ]
)
RESCUED = _f("rescued_values", T.MapType(S, S), "Text of values that their declared type rejects, by column")
