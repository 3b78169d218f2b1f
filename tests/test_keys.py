"""Surrogate keys: sequential (distributed) vs the single-task window, hash vectors."""

import random
import re

import pytest
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.keys import (
    hash_key_columns,
    hash_key_joined,
    period_key,
    range_tagged,
    sequential_key,
)

from .conftest import rows


def one_task_key(df, order_by, key_name):
    """The textbook form: one window over all rows."""
    w = Window.orderBy(*[F.col(c).asc_nulls_first() for c in order_by])
    return df.withColumn(key_name, F.row_number().over(w).cast("long"))


def signed(u: int) -> int:
    return u - (1 << 64) if u >= 1 << 63 else u


@pytest.mark.parametrize("seed", [1, 7])
def test_sequential_key_matches_global_window(spark, seed):
    rnd = random.Random(seed)
    data = [(rnd.choice([None] + [f"k{rnd.randint(0, 300):04d}" for _ in range(3)]), rnd.randint(0, 5), i)
            for i in range(3000)]
    df = spark.createDataFrame(data, "k string, v int, id int").repartition(7)
    ours = sequential_key(df, ["k", "v", "id"], "sk", num_ranges=6)
    ref = one_task_key(df, ["k", "v", "id"], "sk")
    assert rows(ours, "k", "v", "id", "sk") == rows(ref, "k", "v", "id", "sk")


def test_sequential_key_dense_with_ties_and_hot_value(spark):
    # one key value holds a third of the rows, NULL keys too
    data = [("hot" if i % 3 == 0 else (None if i % 11 == 0 else f"c{i:05d}"), i) for i in range(6000)]
    df = spark.createDataFrame(data, "k string, payload int")
    out = sequential_key(df, ["k"], "sk", num_ranges=8)
    keys = sorted(r[0] for r in out.select("sk").collect())
    assert keys == list(range(1, 6001))
    # order respected: NULL keys come first, and each key value is one run of numbers
    got = {r[0]: r[1] for r in out.select("payload", "sk").collect()}
    in_order = [k for _, k in sorted((got[p], k) for k, p in data)]
    assert in_order == sorted((k for k, _ in data), key=lambda k: (k is not None, k or ""))
    again = {r[0]: r[1] for r in sequential_key(df.repartition(13), ["k"], "sk", num_ranges=64).select("payload", "sk").collect()}
    assert again == got  # ties too: whatever the partitions and ranges
    assert out.schema["sk"].dataType.simpleString() == "bigint"


def test_sequential_key_has_no_single_partition_exchange_over_rows(spark):
    df = spark.range(0, 5000).select(F.col("id").cast("string").alias("k"))
    out = sequential_key(df, ["k"], "sk")
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the only single-partition exchanges are over the drawn split points and the per-range counts
    assert plan.count("SinglePartition") <= 3


def test_hash_keys_match_xxhash64(spark):
    df = spark.createDataFrame([("a", "b"), ("Offer A", "Yes"), ("x", None)], "p string, q string")
    got = df.select("p", "q", hash_key_joined(["p", "q"]).alias("k1"), hash_key_columns(["p", "q"]).alias("k2")).collect()
    for p, q, k1, k2 in got:
        joined = "||".join(v for v in (p, q) if v is not None)
        assert k1 == signed(xxhash.xxh64_intdigest(joined.encode(), seed=42))
        h = 42
        for v in (p, q):
            if v is not None:
                h = xxhash.xxh64_intdigest(v.encode(), seed=h)
        assert k2 == signed(h)
    a, b = got[0][2], got[0][3]
    assert (a, b) == (422548665953921601, -7357372313250070212)  # the two forms differ


def test_hash_key_stable_across_partitioning(spark):
    df = spark.range(0, 2000).select(F.concat(F.lit("v"), F.col("id").cast("string")).alias("s"))
    a = rows(df.repartition(3).select("s", hash_key_joined(["s"]).alias("k")))
    b = rows(df.repartition(11).select("s", hash_key_joined(["s"]).alias("k")))
    assert a == b


def test_period_key(spark):
    df = spark.createDataFrame([(2025, 3), (2025, None)], "y int, q int")
    assert [r[0] for r in df.select(period_key("y", "q")).collect()] == [202503, None]


def test_sequential_key_with_identical_rows(spark, monkeypatch):
    from strata.operators import keys as module

    monkeypatch.setattr(module, "COPIES_PER_CHUNK", 150)
    df = spark.range(0, 4000).selectExpr("CASE WHEN id % 2 = 0 THEN 'same' WHEN id % 5 <> 0 THEN CAST(id AS STRING) END AS k")
    for repeated in (False, True):
        out = sequential_key(df.repartition(5), ["k"], "sk", num_ranges=6, repeated_rows=repeated)
        assert out.columns == ["k", "sk"]
        assert rows(out, "k", "sk") == rows(one_task_key(df, ["k"], "sk"), "k", "sk")


def test_sequential_key_of_empty_and_one_row_tables(spark):
    none = spark.createDataFrame([], "k string, v int")
    for repeated in (False, True):
        assert sequential_key(none, ["k"], "sk", repeated_rows=repeated).collect() == []
        one = spark.createDataFrame([(None, 1)], "k string, v int")
        assert [tuple(r) for r in sequential_key(one, ["k"], "sk", repeated_rows=repeated).collect()] == [(None, 1, 1)]


def test_builders_run_no_job_and_read_their_input_three_times(spark, sf_smoke):
    from strata.plans import dimensions as dims
    from strata.sources.raw_views import raw_view

    demographics = raw_view(spark, sf_smoke, "demographics")
    location, population = (raw_view(spark, sf_smoke, s) for s in ("location", "population"))
    status = spark.sparkContext.statusTracker()
    group = "no job when built"
    spark.sparkContext.setJobGroup(group, group)
    try:
        customers = dims.dim_customer(demographics)
        dims.dim_location(location, population)
        assert list(status.getJobIdsForGroup(group)) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    customers.collect()
    physical = customers._jdf.queryExecution().executedPlan().toString()
    # scans by the first column's id: rows, counts and split points, which are worked out once
    assert len(set(re.findall(r"FileScan parquet \[c_custkey#(\d+)", physical))) <= 3
    assert "ReusedSubquery" in physical
    physical = physical[: physical.rindex("== Initial Plan ==")]
    # shuffled by range: the counts, and whole rows once
    assert len(set(re.findall(r"Exchange hashpartitioning\(_sk_range#(\d+)", physical))) == 2


def test_range_sizes_follow_the_sample(spark):
    df = spark.range(0, 40000).selectExpr("concat('customer-', lpad(CAST(id * id AS STRING), 12, '0')) AS k")
    sizes = [r["count"] for r in range_tagged(df, ["k"], num_ranges=16).groupBy("_sk_range").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 40000 / 16


def test_hot_key_value_spreads_over_several_ranges(spark):
    data = [("hot" if i % 3 == 0 else f"c{i:05d}", i) for i in range(9000)]
    tagged = range_tagged(spark.createDataFrame(data, "k string, payload int"), ["k"], num_ranges=8)
    ranges_of_hot = tagged.filter("k = 'hot'").select("_sk_range").distinct().count()
    assert ranges_of_hot >= 2  # a third of the rows is not pinned to one task


def test_sequential_key_skips_unorderable_tiebreak_columns(spark):
    df = spark.createDataFrame([("b", {"x": 1}), ("a", {"y": 2})], "k string, m map<string,int>")
    out = sequential_key(df, ["k"], "sk")
    assert rows(out, "k", "sk") == [("a", 1), ("b", 2)]
