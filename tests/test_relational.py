"""Dedup, skew-safe join, quality checks, profile."""

import pytest
from pyspark.sql import functions as F

from strata.operators import quality
from strata.operators.joins import equi_join
from strata.operators.relational import dedup_by_key, distinct_with_ratio

from .conftest import rows


def test_dedup_keeps_lowest_row_and_one_null_key(spark):
    df = spark.createDataFrame(
        [(1, "b", 2.0), (1, "a", 9.0), (1, "a", 1.0), (None, "z", 0.0), (None, "y", 5.0), (2, None, 3.0), (2, "c", 0.0)],
        "k int, s string, d double",
    )
    got = rows(dedup_by_key(df, ["k"]))
    assert got == [(None, "y", 5.0), (1, "a", 1.0), (2, None, 3.0)]


def test_dedup_hot_key_is_pre_aggregated(spark):
    df = spark.range(0, 30000).select((F.col("id") % 3 == 0).cast("int").alias("k"), F.col("id"))
    out = dedup_by_key(df, ["k"])
    assert rows(out) == [(0, 1), (1, 0)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan or "partial" in plan.lower()


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_key_split_join_equals_plain_join(spark, how):
    # key 0 holds a third of the left rows; right side repeats keys too
    left = spark.range(0, 9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 400).alias("lk"), F.col("id").alias("lid"))
    right = spark.range(0, 1200).select((F.col("id") % 450).alias("rk"), F.col("id").alias("rid"))
    plain = equi_join(left, right, [("lk", "rk")], how)
    split = equi_join(left, right, [("lk", "rk")], how, hot_key_fraction=0.05, rows_per_task=500)
    assert split.count() == plain.count()
    assert rows(split, "lid", "rid") == rows(plain, "lid", "rid")


def test_hot_key_split_with_the_hot_key_on_the_right(spark, tmp_path):
    # key 0 is rare on the left and holds a third of the right rows; key 1 is hot on both; NULL keys are frequent
    spark.range(0, 900).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 3 == 1, F.lit(None)).when(F.col("id") < 20, F.lit(0))
        .otherwise(F.col("id") % 90 + 2).cast("int").alias("lk"), F.col("id").alias("lid")).write.parquet(f"{tmp_path}/l")
    spark.range(0, 6000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 9 == 1, F.lit(1)).when(F.col("id") % 9 == 2, F.lit(None))
        .otherwise(F.col("id") % 200 + 2).alias("rk"), F.col("id").alias("rid")).write.parquet(f"{tmp_path}/r")
    left, right = spark.read.parquet(f"{tmp_path}/l"), spark.read.parquet(f"{tmp_path}/r")
    for how in ("inner", "left"):
        plain = equi_join(left, right, [("lk", "rk")], how)
        split = equi_join(left, right, [("lk", "rk")], how, hot_key_fraction=0.05, rows_per_task=100)
        assert split.columns == plain.columns
        assert rows(split, "lid", "rid") == rows(plain, "lid", "rid")
        plan = split._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parquet") <= 4  # the counts are not part of the plan


def test_distinct_with_ratio(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "x string")
    r = distinct_with_ratio(df).first()
    assert (r.input_rows, r.distinct_rows, r.dedup_ratio) == (4, 3, round(4 / 3, 6))


def test_quality_reports_and_enforce(spark):
    a = spark.range(5)
    b = spark.range(0)
    report = quality.min_rows({"a": a, "b": b}, {"a": 3, "b": 1})
    assert rows(report) == [("a", 3, 5, True), ("b", 1, 0, False)]
    with pytest.raises(quality.DataQualityError, match="b"):
        quality.enforce(report)
    quality.enforce(quality.non_empty({"a": a}))
    assert rows(quality.non_empty({"b": b})) == [("b", 0, False)]


def test_null_counts_and_duplicates(spark):
    df = spark.createDataFrame([("c1", "Q1"), ("c1", "Q1"), ("c2", None), (None, None)], "customer_id string, quarter string")
    assert tuple(quality.null_counts(df, ["customer_id", "quarter"]).first()) == (1, 2)
    assert quality.grain_duplicates(df, ["customer_id", "quarter"]).first()[0] == 1
    empty = df.filter("false")
    assert tuple(quality.null_counts(empty, ["customer_id"]).first()) == (None,)


def test_profile_matches_describe(spark):
    df = spark.createDataFrame([(1, 2.5), (3, None), (8, 4.0)], "a int, b double")
    prof = {r.measure: r for r in quality.profile(df, ["a", "b"]).collect()}
    desc = {r.summary: r for r in df.describe("a", "b").collect()}
    for c in ["a", "b"]:
        assert prof[c]["count"] == int(desc["count"][c])
        assert prof[c]["mean"] == pytest.approx(float(desc["mean"][c]))
        assert prof[c]["stddev"] == pytest.approx(float(desc["stddev"][c]))
        assert prof[c]["min"] == float(desc["min"][c]) and prof[c]["max"] == float(desc["max"][c])


def test_facts_hot_customer_split_equals_plain(spark):
    """One customer holds a third of both sides: the explicit hot-key split
    gives exactly the rows of the plain fan-out join."""
    from strata.plans import facts

    def side(n, extra):
        return spark.range(0, n).select(
            F.when(F.col("id") % 3 == 0, F.lit("Customer#HOT")).otherwise(
                F.concat(F.lit("Customer#"), (F.col("id") % 97).cast("string"))).alias("customer_id"),
            F.concat(F.lit("Q"), (F.col("id") % 4 + 1).cast("string")).alias("quarter"),
            *extra,
        )

    status = side(900, [(F.col("id") % 5).cast("int").alias(c) for c in facts.STATUS_MEASURES])
    service_cols = [m.source for m in facts.MEASURES if m.name not in facts.STATUS_MEASURES]
    services = side(600, [(F.col("id") % 50 / 4).alias(c) for c in service_cols])
    plain = facts.facts_base(status, services)
    split = facts.facts_base(status, services, hot_key_fraction=0.1)
    assert split.count() == plain.count() == 300 * 200 + sum(
        1 for i in range(900) for j in range(600) if i % 3 and j % 3 and i % 97 == j % 97)
    assert rows(split) == rows(plain)


def test_referential_integrity_counts_orphans_not_null_keys(spark):
    parent = spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
    # a hot orphan key ('z') holds a third of the child rows
    child = spark.createDataFrame([("a",), ("z",), (None,), ("b",), ("z",), ("z",)] * 2, "c string")
    r = quality.referential_integrity({"c_to_k": (child, "c", parent, "k")}).first()
    assert (r.check_name, r.checked_rows, r.orphan_rows, r.passed) == ("c_to_k", 10, 6, False)
    ok = quality.referential_integrity({"ok": (parent, "k", parent, "k")}).first()
    assert (ok.checked_rows, ok.orphan_rows, ok.passed) == (3, 0, True)


def test_type_consistency(spark):
    df = spark.createDataFrame([("1", "2.5"), (" 7 ", "x"), (None, "20000.0"), ("9999999999", None)], "a string, b string")
    got = {r.column_name: (r.non_null_values, r.unparsable_values)
           for r in quality.type_consistency(df, {"a": "int", "b": "double"}).collect()}
    assert got == {"a": (3, 1), "b": (3, 1)}


def test_scd1_upsert_updates_in_place_and_appends(spark):
    from strata.operators.scd import scd1_upsert

    current = spark.createDataFrame(
        [(1, "a", "old"), (2, "b", "old"), (3, None, "old-null"), (4, "d", "gone?")], "sk long, k string, v string")
    incoming = spark.createDataFrame([("b", "new"), (None, "new-null"), ("c", "new"), ("aa", "new")],
                                     "k string, v string")
    got = rows(scd1_upsert(current, incoming, ["k"], "sk"))
    assert got == [(1, "a", "old"), (2, "b", "new"), (3, None, "new-null"), (4, "d", "gone?"),
                   (5, "aa", "new"), (6, "c", "new")]


def test_hot_key_split_keeps_the_join_strategy(spark):
    left = spark.range(0, 3000).select((F.col("id") % 3 == 0).cast("int").alias("lk"), F.col("id").alias("lid"))
    right = spark.range(0, 300).select((F.col("id") % 2).cast("int").alias("rk"), F.col("id").alias("rid"))
    out = equi_join(left, right, [("lk", "rk")], "inner", hot_key_fraction=0.2, strategy="merge")
    p = out._jdf.queryExecution().executedPlan().toString()
    assert p.count("SortMergeJoin") == 2  # the cold and the salted hot join
    assert out.count() == left.join(right, left.lk == right.rk).count()


def test_scd1_requires_every_dimension_column(spark):
    from strata.operators.scd import scd1_upsert

    current = spark.createDataFrame([(1, "a", "x", "y")], "sk long, k string, v string, w string")
    with pytest.raises(ValueError, match="w"):
        scd1_upsert(current, spark.createDataFrame([("a", "x2")], "k string, v string"), ["k"], "sk")
    extra = spark.createDataFrame([("a", "x2", "y2", "ignored")], "k string, v string, w string, z string")
    assert rows(scd1_upsert(current, extra, ["k"], "sk")) == [(1, "a", "x2", "y2")]


def test_keyed_facts_do_not_multiply_on_a_repeated_customer(spark):
    from strata.plans import facts

    status = spark.createDataFrame(
        [("c1", "Q1", 1, 0, 10, 100, "Stayed", None, None)],
        "customer_id string, quarter string, satisfaction_score int, churn_value int, churn_score int, cltv int, "
        "customer_status string, churn_category string, churn_reason string")
    service_cols = [m.source for m in facts.MEASURES if m.name not in facts.STATUS_MEASURES]
    services = spark.createDataFrame([("c1", "Q1")], "customer_id string, quarter string").selectExpr(
        "*", *[f"CAST(1 AS DOUBLE) AS {c}" for c in service_cols],
        *[f"'Yes' AS {c}" for c in ["phone_service", "multiple_lines", "internet_service", "internet_type",
                                     "online_security", "online_backup", "device_protection_plan",
                                     "premium_tech_support", "streaming_tv", "streaming_movies", "streaming_music",
                                     "unlimited_data", "contract", "payment_method", "offer", "referred_a_friend"]])
    dim_customer = spark.createDataFrame([(1, "c1"), (2, "c1")], "customer_key long, customer_id string")
    out = facts.facts_keyed(status, services, dim_customer).collect()
    assert len(out) == 1 and out[0].customer_key == 1


def test_quality_report_long_form(spark):
    from strata.plans import flows
    from strata.plans.schemas import SILVER

    fact_cols = [f.name for f in SILVER["facts_base"].fields]
    base = {c: None for c in fact_cols}
    rows_ = []
    for cid, q, t in [("c1", "Q1", 10), ("c1", "Q1", 20), ("c2", None, 30)]:
        r = dict(base, customer_id=cid, quarter=q, tenure_months=t, cltv=t * 10)
        rows_.append(tuple(r[c] for c in fact_cols))
    f = spark.createDataFrame(rows_, SILVER["facts_base"])
    loc = spark.createDataFrame([(1, None, "00001", 1.0, None)],
                                "location_key long, city string, zip_code string, latitude double, longitude double")
    got = {(r.check_name, r.table_name, r.column_name): r.value
           for r in flows.quality_report({"facts_base": f, "dim_location": loc}).collect()}
    assert len(got) == 28
    assert got[("grain_duplicates", "facts_base", "customer_id,quarter")] == 1.0
    assert got[("null_count", "facts_base", "quarter")] == 1.0
    assert got[("null_count", "dim_location", "city")] == 1.0 and got[("null_count", "dim_location", "longitude")] == 1.0
    assert got[("profile_mean", "facts_base", "tenure_months")] == 20.0
    assert got[("profile_count", "facts_base", "monthly_charges")] == 0.0
    assert got[("profile_max", "facts_base", "cltv")] == 300.0
