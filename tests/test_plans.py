"""Physical-plan properties the scale design relies on."""

import re

from strata.operators.keys import range_tagged
from strata.plans import dimensions as dims
from strata.plans import facts
from strata.plans.registry import QUERIES
from strata.sources.raw_views import raw_view


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_join_is_sort_merge_with_work_below_the_exchange(spark, sf_smoke):
    p = plan(facts.facts_base(raw_view(spark, sf_smoke, "status"), raw_view(spark, sf_smoke, "services")))
    assert "SortMergeJoin" in p and "BroadcastHashJoin" not in p
    # the typed casts are evaluated below the shuffle of the services side
    exchange_at = p.index("Exchange hashpartitioning(_r_customer_id")
    assert "try_cast" in p[exchange_at:]


def test_mini_dimension_pre_aggregates_and_prunes_the_scan(spark, sf_smoke):
    p = plan(QUERIES["dim_promotion"](spark, sf_smoke))
    assert p.count("HashAggregate") >= 2  # partial + final around one exchange
    assert re.search(r"FileScan parquet \[o_orderkey#\d+L,o_custkey#\d+L\]", p)


def test_sequential_key_tagging_has_no_single_partition_exchange(spark, sf_smoke):
    df = dims.location_with_population(raw_view(spark, sf_smoke, "location"), raw_view(spark, sf_smoke, "population"))
    p = plan(range_tagged(df, ["zip_code"]))
    rows_only = p[: p.index("Subquery subquery")]
    assert "SinglePartition" not in rows_only and "rangepartitioning" not in p
    # both dedups are aggregates with a partial step before their shuffle
    assert p.count("SortAggregate") + p.count("HashAggregate") >= 4


def test_profile_is_one_aggregate_pass(spark, sf_smoke):
    p = plan(QUERIES["profile_measures"](spark, sf_smoke))
    assert p.count("SortMergeJoin") == 1
    assert "partial_stddev_samp" in p and "partial_avg" in p


def test_coordinate_filter_stays_above_the_dedup(spark, sf_smoke):
    """Pushing the range filter below the dedup would change which row survives."""
    p = plan(dims.location_by_zip(raw_view(spark, sf_smoke, "location")))
    filter_at = p.index("Filter")
    agg_at = p.index("SortAggregate")
    assert filter_at < agg_at  # printed top-down: the filter is above the aggregate


def test_fact_join_splits_a_hot_customer_at_run_time(spark):
    """A customer holding a third of both sides: adaptive execution splits its
    partition (thresholds lowered to test scale), with no change to the rows."""
    from collections import Counter

    from pyspark.sql import functions as F

    def key(i):
        return ("Customer#HOT" if i % 3 == 0 else f"Customer#{i % 97}", f"Q{i % 4 + 1}")

    def side(n, extra):
        return spark.range(0, n).select(
            F.when(F.col("id") % 3 == 0, F.lit("Customer#HOT")).otherwise(
                F.concat(F.lit("Customer#"), (F.col("id") % 97).cast("string"))).alias("customer_id"),
            F.concat(F.lit("Q"), (F.col("id") % 4 + 1).cast("string")).alias("quarter"),
            *extra,
        )

    status = side(6000, [(F.col("id") % 5).cast("int").alias(c) for c in facts.STATUS_MEASURES])
    service_cols = [m.source for m in facts.MEASURES if m.name not in facts.STATUS_MEASURES]
    services = side(600, [(F.col("id") % 50 / 4).alias(c) for c in service_cols])
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = facts.facts_base_grain_safe(status, services)
        got = len(df.collect())
        final = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in final
    left, right = Counter(key(i) for i in range(6000)), Counter(key(i) for i in range(600))
    assert got == sum(n * right[k] for k, n in left.items())


def test_scd1_joins_are_equi_joins(spark):
    """The null-safe natural-key match plans as an equi-join, never a nested loop."""
    from strata.operators.scd import scd1_upsert

    cur = spark.range(0, 1000).selectExpr("id AS sk", "CAST(id AS STRING) AS k", "'v' AS v")
    inc = spark.range(500, 1500).selectExpr("CAST(id AS STRING) AS k", "'w' AS v")
    out = scd1_upsert(cur, inc, ["k"], "sk")
    p = plan(out)
    assert "NestedLoop" not in p and "Cartesian" not in p
    assert out.count() == 1500 and out.agg({"sk": "max"}).first()[0] == 1499
