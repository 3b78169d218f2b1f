"""Base fact table: status and services joined, measures typed and renamed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import standard as std
from ..operators.joins import equi_join
from ..operators.keys import hash_key_columns, hash_key_joined, period_key
from ..operators.relational import Measure, typed_measures
from . import dimensions as dims
from .dimensions import BUSINESS_YEAR
from .schemas import SILVER

# Measure name, source column, declared type.
MEASURES = (
    Measure("tenure_months", "tenure_in_months", "int"),
    Measure("satisfaction_score", "satisfaction_score", "int"),
    Measure("churn_value", "churn_value", "int"),
    Measure("churn_score", "churn_score", "int"),
    Measure("cltv", "cltv", "int"),
    Measure("monthly_charges", "monthly_charge", "decimal(10,2)"),
    Measure("avg_monthly_long_distance_charges", "avg_monthly_long_distance_charges", "decimal(10,2)"),
    Measure("total_charges", "total_charges", "decimal(10,2)"),
    Measure("total_revenue", "total_revenue", "decimal(10,2)"),
    Measure("total_refunds", "total_refunds", "decimal(10,2)"),
    Measure("total_extra_data_charges", "total_extra_data_charges", "decimal(10,2)"),
    Measure("total_long_distance_charges", "total_long_distance_charges", "decimal(10,2)"),
    Measure("avg_monthly_gb_download", "avg_monthly_gb_download", "int"),
    Measure("number_of_referrals", "number_of_referrals", "int"),
)

STATUS_MEASURES = ("satisfaction_score", "churn_value", "churn_score", "cltv")
GRAIN = ("customer_id", "quarter")


def facts_base(
    status: DataFrame,
    services: DataFrame,
    join_on: Sequence[str] = ("customer_id",),
    hot_key_fraction: float | None = None,
) -> DataFrame:
    """status ⋈ services, keeping the status side's ``customer_id`` and ``quarter``.

    ``join_on=("customer_id",)`` is the table as the source layer builds it: with
    several quarters per customer on both sides it yields every pairing, so the
    claimed (customer, quarter) grain does not hold (``dq_grain_duplicates``
    reports it).  ``join_on=("customer_id", "quarter")`` is the grain-safe form
    (NULL quarters do not match).  Keys are joined untrimmed and trimmed after.

    The join multiplies rows, so every per-row expression (trim, typed casts)
    is evaluated on its input side *before* the join and the join only copies
    values: Catalyst prunes columns below a join but does not move computed
    expressions there.
    """
    join_on = list(join_on)
    by_name = {m.name: m for m in MEASURES}
    status_typed = typed_measures([by_name[n] for n in STATUS_MEASURES])
    service_typed = typed_measures([m for m in MEASURES if m.name not in STATUS_MEASURES])
    left = status.select(
        *[F.col(k).alias(f"_l_{k}") for k in join_on],
        F.trim("customer_id").alias("customer_id"),
        F.trim("quarter").alias("quarter"),
        *status_typed,
    )
    right = services.select(*[F.col(k).alias(f"_r_{k}") for k in join_on], *service_typed)
    joined = equi_join(
        left,
        right,
        [(f"_l_{k}", f"_r_{k}") for k in join_on],
        how="inner",
        hot_key_fraction=hot_key_fraction,
        strategy="merge",  # both sides are fact-sized: no broadcast on an estimate
    )
    return joined.select(*[f.name for f in SILVER["facts_base"].fields])


def facts_base_grain_safe(status: DataFrame, services: DataFrame, hot_key_fraction: float | None = None) -> DataFrame:
    return facts_base(status, services, ("customer_id", "quarter"), hot_key_fraction)


KEYS = ("customer_key", "quarter_key", "service_package_key", "promotion_key", "churn_status_key")


def facts_keyed(
    status: DataFrame,
    services: DataFrame,
    dim_customer: DataFrame,
    join_on: Sequence[str] = ("customer_id", "quarter"),
    business_year: int = BUSINESS_YEAR,
    hot_key_fraction: float | None = None,
) -> DataFrame:
    """Base facts with the star-schema keys of their dimensions attached.

    The hash keys (package, promotion, churn status) and the period key are
    pure functions of a row's standardized attributes, so they are recomputed
    on each input side before the fact join - no lookup join at all.  Only the
    sequential customer key is looked up: a left join of the status rows (before
    the fan-out of the fact join, so the larger fact output is never shuffled
    again) on the trimmed customer id, NULL when the customer has no dimension
    row; its strategy is left to the planner's size checks.
    """
    join_on = list(join_on)
    by_name = {m.name: m for m in MEASURES}
    status_std = dims.standardize_status(status, keep=("customer_id", "quarter", *STATUS_MEASURES))
    left = status_std.select(
        *[F.col(k).alias(f"_l_{k}") for k in join_on],
        F.trim("customer_id").alias("customer_id"),
        F.trim("quarter").alias("quarter"),
        *typed_measures([by_name[n] for n in STATUS_MEASURES]),
        period_key(F.lit(business_year), std.quarter_of_year("quarter")).alias("quarter_key"),
        hash_key_columns(dims.CHURN_ATTRIBUTES).alias("churn_status_key"),
    )
    # customer key looked up on the status rows, below the fan-out of the fact join;
    # one key per customer (the lowest), so a customer repeated in the dimension's
    # source cannot multiply fact rows (pre-aggregated per task, so skew-safe)
    customers = dim_customer.groupBy(F.col("customer_id").alias("_c_customer_id")).agg(
        F.min("customer_key").alias("customer_key"))
    left = left.join(customers, left["customer_id"] == customers["_c_customer_id"], "left").drop("_c_customer_id")
    service_measures = [m for m in MEASURES if m.name not in STATUS_MEASURES]
    packages = dims.standardize_services(services, keep=(*join_on, *(m.source for m in service_measures),
                                                          "offer", "referred_a_friend"))
    promos = packages.withColumns(
        {"_offer": std.OFFER.apply("offer"), "_referred": std.REFERRED_A_FRIEND.apply("referred_a_friend")}
    )
    right = promos.select(
        *[F.col(k).alias(f"_r_{k}") for k in join_on],
        *typed_measures(service_measures),
        hash_key_joined(dims.SERVICE_ATTRIBUTES).alias("service_package_key"),
        hash_key_joined(["_offer", "_referred"]).alias("promotion_key"),
    )
    keyed = equi_join(left, right, [(f"_l_{k}", f"_r_{k}") for k in join_on], how="inner",
                      hot_key_fraction=hot_key_fraction, strategy="merge")
    return keyed.select(*KEYS, *[f.name for f in SILVER["facts_base"].fields])
