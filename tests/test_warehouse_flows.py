"""Options and failure behavior of the layer flows."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from strata.operators import quality, registry
from strata.plans import facts, flows
from strata.plans.registry import _config
from strata.plans.schemas import SILVER
from strata.session import scratch_path
from strata.sources import catalog, sinks
from strata.sources.raw_views import SUBJECTS, raw_view

from .conftest import rows


def raw_tables(spark, sf):
    return {s: raw_view(spark, sf, s) for s in SUBJECTS}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def new_table(spark, schema, **options):
    root = scratch_path(spark, "table")
    name = "t_" + root.rsplit("-", 1)[-1]
    catalog.create_table(spark, name, spark.createDataFrame([], schema).schema, f"{root}/t", **options)
    return name, root


# ---- publish
def test_publish_swaps_versions_and_a_failed_check_leaves_the_old_one(spark):
    name, root = new_table(spark, "k long, v string")
    sinks.overwrite_table(spark.createDataFrame([(1, "first")], "k long, v string"), name)
    two = spark.createDataFrame([(1, "second"), (2, "second")], "v2 int, v string").withColumnRenamed("v2", "k")
    assert sinks.publish_table(two, name, lambda written, m: [] if written.count() == m["rows"] == 2 else ["count"]) == {"rows": 2}
    assert rows(spark.table(name)) == [(1, "second"), (2, "second")]
    where = catalog.location(spark, name)
    # a published table may be read for its own next version
    with pytest.raises(sinks.PublishError, match="repeated"):
        sinks.publish_table(spark.table(name).union(spark.table(name)), name, lambda written, m: ["repeated keys"])
    assert catalog.location(spark, name) == where and rows(spark.table(name)) == [(1, "second"), (2, "second")]
    for i in range(3):
        sinks.publish_table(spark.table(name).withColumn("v", F.lit(f"v{i}")), name)
    versions = glob.glob(f"{root}/t{sinks.VERSIONS}/*")
    assert rows(spark.table(name)) == [(1, "v2"), (2, "v2")] and len(versions) == 2


def test_location_scd1_keeps_keys_over_runs(spark, sf_smoke):
    cfg = _config(spark, sf_smoke, stage=False, location_scd1=True)
    bronze = raw_tables(spark, sf_smoke)
    name = f"{cfg.silver_db}.dim_location"
    flows.run_silver(spark, cfg, bronze=bronze, only=("dim_location",))
    first = {r["zip_code"]: r["location_key"] for r in spark.table(name).collect()}
    fewer = bronze | {"location": bronze["location"].filter("zip_code % 2 = 0")}
    flows.run_silver(spark, cfg, bronze=fewer, only=("dim_location",))
    assert {r["zip_code"]: r["location_key"] for r in spark.table(name).collect()} == first
    before = rows(spark.table(name))
    bad = bronze | {"location": bronze["location"].withColumn("zip_code", F.expr("zip_code + CAST(raise_error('broken') AS INT)"))}
    with pytest.raises(Exception, match="broken"):
        flows.run_silver(spark, cfg, bronze=bad, only=("dim_location",))
    assert rows(spark.table(name)) == before
    audit = spark.table(cfg.audit_table).groupBy("status").count().collect()
    assert {r["status"]: r["count"] for r in audit} == {"success": 2, "failed": 1}


def test_scd1_refuses_a_repeated_stored_key_and_reads_input_once(spark):
    from strata.operators.scd import scd1_classify, scd1_upsert

    current = spark.createDataFrame([(1, "a", "x"), (2, "a", "y")], "sk long, k string, v string")
    incoming = spark.createDataFrame([("a", "z")], "k string, v string")
    with pytest.raises(Exception, match="repeat the natural key"):
        scd1_upsert(current, incoming, ["k"], "sk").collect()
    classified = plan(scd1_classify(current, incoming, ["k"], "sk"))
    assert classified.count("FullOuter") == 1 and "NestedLoop" not in classified


# ---- registry
def test_registry_keeps_adds_and_never_reuses_keys(spark):
    schema = registry.registry_schema(spark.createDataFrame([], "id string").schema, ["id"], "key")
    name, _ = new_table(spark, schema)
    people = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id string")
    assert registry.allocate(people("b", "a", "c", "a"), name, ["id"], "key", "r1") == 3
    assert registry.allocate(people("b", None, "aa"), name, ["id"], "key", "r2") == 2
    assert registry.allocate(people("b", None, "aa"), name, ["id"], "key", "r2") == 0  # repeated
    assert registry.allocate(people("c", "a"), name, ["id"], "key", "r3") == 0
    assert rows(spark.table(name), "key", "id", "run_id") == [
        (1, "a", "r1"), (2, "b", "r1"), (3, "c", "r1"), (4, None, "r2"), (5, "aa", "r2")]
    keyed = registry.with_registered_key(people("a", "zz", None), spark.table(name), ["id"], "key")
    assert rows(keyed) == [(None, "zz"), (1, "a"), (4, None)]


# ---- partitions
def test_rebuild_of_one_quarter_leaves_other_files_alone(spark, sf_smoke):
    cfg = _config(spark, sf_smoke, stage=False, facts_by_quarter=True)
    bronze = raw_tables(spark, sf_smoke)
    name = f"{cfg.silver_db}.facts_base"
    flows.run_silver(spark, cfg, bronze=bronze, only=("facts_base",))
    before, folder = rows(spark.table(name)), catalog.location(spark, name).removeprefix("file:")
    stamps = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{folder}/quarter=*/*.parquet")}
    found = flows.rebuild_quarters(spark, cfg, ("Q2",), bronze)
    kept = [f for f, t in stamps.items() if os.path.exists(f) and os.stat(f).st_mtime_ns == t]
    assert sorted(kept) == sorted(f for f in stamps if "quarter=Q2" not in f)
    assert rows(spark.table(name)) == before and found["rows"] == spark.table(name).filter("quarter = 'Q2'").count()
    pruned = plan(spark.table(name).filter("quarter = 'Q2'").agg(F.sum("cltv")))
    assert "PartitionFilters: [isnotnull(quarter" in pruned and "PushedFilters: []" in pruned
    with pytest.raises(ValueError, match="not partitioned"):
        plain, _ = new_table(spark, "a int")
        sinks.overwrite_partitions(spark.range(3).toDF("a"), plain)


# ---- buckets
def test_bucketed_tables_join_and_group_without_a_shuffle(spark, sf_smoke):
    cfg = _config(spark, sf_smoke, customer_buckets=4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        flows.run_bronze(spark, cfg, enforce=False)
        flows.run_silver(spark, cfg, only=("facts_base",))
        bronze = flows.bronze_tables(spark, cfg)
        joined = facts.facts_base(bronze["status"], bronze["services"])
        assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
        written = spark.table(f"{cfg.silver_db}.facts_base")
        repeated = quality.grain_duplicates(written, facts.GRAIN)
        assert "hashpartitioning" not in plan(repeated)  # only the one-row total is exchanged
        raw = raw_tables(spark, sf_smoke)
        expected = facts.facts_base(raw["status"], raw["services"])
        assert rows(written) == rows(expected.select(*written.columns))
        assert repeated.first()[0] == quality.grain_duplicates(expected, facts.GRAIN).first()[0]
        # a second load replaces the first
        n = bronze["status"].count()
        flows.run_bronze(spark, cfg, enforce=False)
        assert spark.table(f"{cfg.bronze_db}.status").count() == n
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_large_sources_get_more_buckets_and_existing_tables_keep_theirs(spark, sf_smoke, monkeypatch):
    cfg = _config(spark, sf_smoke, customer_buckets=2)
    size = max(sinks.folder_bytes(spark, f"{cfg.source_dir}/{s.file}") for s in cfg.sources if s.table in flows.JOINED_BY_CUSTOMER)
    monkeypatch.setattr(flows, "BUCKET_BYTES", -(-size // 5))
    flows.run_bronze(spark, cfg, enforce=False)
    monkeypatch.setattr(flows, "BUCKET_BYTES", size)  # a later run finds the tables
    flows.run_bronze(spark, cfg, enforce=False)
    flows.run_silver(spark, cfg, only=("facts_base",))
    tables = [f"{cfg.bronze_db}.status", f"{cfg.bronze_db}.services", f"{cfg.silver_db}.facts_base"]
    assert [catalog.bucket_count(spark, t) for t in tables] == [8, 8, 8]
    raw = raw_tables(spark, sf_smoke)
    expected = facts.facts_base(raw["status"], raw["services"])
    assert rows(spark.table(tables[2])) == rows(expected.select(*spark.table(tables[2]).columns))
    assert catalog.bucket_count(spark, f"{cfg.bronze_db}.population") is None


def test_few_partitions_are_written_without_a_sort_and_many_still_fit(spark):
    name, _ = new_table(spark, "a long, p string", partition_by=("p",))
    option = "spark.sql.maxConcurrentOutputFileWriters"
    before, started = spark.conf.get(option), []
    for n in (3, 2 * sinks.OPEN_PARTITIONS):
        df = spark.range(0, 400, numPartitions=2).select(F.col("id").alias("a"), (F.col("id") % n).cast("string").alias("p"))
        assert sinks.overwrite_table(df, name)["rows"] == 400
        assert sinks.overwrite_partitions(df, name)["rows"] == 400
        assert rows(spark.table(name)) == rows(df) and spark.conf.get(option) == before
    with sinks.open_partitions(spark):
        assert spark.conf.get(option) == str(sinks.OPEN_PARTITIONS)
        with sinks.open_partitions(spark):
            pass
        started.append(spark.conf.get(option))
    assert started == [str(sinks.OPEN_PARTITIONS)] and spark.conf.get(option) == before


def test_flows_split_methods_that_the_jvm_would_interpret(spark, sf_smoke, monkeypatch):
    option, seen = "spark.sql.codegen.hugeMethodLimit", []
    before = spark.conf.get(option)
    real = flows.facts.facts_keyed
    monkeypatch.setattr(flows.facts, "facts_keyed", lambda *a, **k: (seen.append(spark.conf.get(option)), real(*a, **k))[1])
    cfg = _config(spark, sf_smoke, stage=False, keyed_facts=True, quality_reports=False)
    bronze = raw_tables(spark, sf_smoke)
    flows.run_silver(spark, cfg, bronze=bronze, enforce=False)
    assert seen == [str(sinks.LARGEST_COMPILED)] and spark.conf.get(option) == before
    expected = real(bronze["status"], bronze["services"], spark.table(f"{cfg.silver_db}.dim_customer"))
    assert rows(spark.table(f"{cfg.silver_db}.facts_keyed")) == rows(expected)


# ---- audit and reports
def test_a_failing_bronze_run_leaves_rows_and_a_retry_replaces_them(spark, sf_smoke):
    cfg = _config(spark, sf_smoke)
    good, cfg.source_dir = cfg.source_dir, scratch_path(spark, "nothing-here")
    with pytest.raises(Exception):
        flows.run_bronze(spark, cfg, run_id="r")
    assert {(r["status"], r["row_count"]) for r in spark.table(cfg.audit_table).collect()} == {("failed", -1)}
    cfg.source_dir = good
    flows.run_bronze(spark, cfg, enforce=False, run_id="r")
    flows.run_bronze(spark, cfg, enforce=False, run_id="other")
    audit = spark.table(cfg.audit_table)
    assert audit.filter("run_id = 'r'").count() == 5 and audit.count() == 10 and audit.filter("row_count < 0").isEmpty()
    assert spark.table(f"{cfg.bronze_db}.quality_report").filter("run_id = 'r'").count() == 11


def test_load_time_is_that_of_the_run(spark, sf_smoke):
    import datetime

    cfg = _config(spark, sf_smoke)
    start = datetime.datetime.now()
    flows.run_bronze(spark, cfg, enforce=False)
    stamps = [{r[0] for r in t.select("ingestion_timestamp").distinct().collect()} for t in flows.bronze_tables(spark, cfg).values()]
    assert all(s == stamps[0] and len(s) == 1 for s in stamps)
    stamp = stamps[0].pop()
    utc = start.astimezone(datetime.timezone.utc).replace(tzinfo=None)
    assert abs((stamp - utc).total_seconds()) < 600 or abs((stamp - start).total_seconds()) < 600


def test_reports_need_no_second_read_of_the_facts_but_for_duplicates(spark, sf_smoke):
    cfg = _config(spark, sf_smoke, stage=False)
    flows.run_silver(spark, cfg, bronze=raw_tables(spark, sf_smoke))
    written = {t: spark.table(f"{cfg.silver_db}.{t}") for t in ("facts_base", "dim_location")}
    again = flows.quality_report(written)
    reported = spark.table(f"{cfg.silver_db}.quality_report").select(*again.columns)
    assert rows(reported) == rows(again) and len(rows(again)) == 28


def test_digest_of_more_rows_than_a_bigint_sum_holds(spark):
    # MD5("20"): 98f13708210194c475687be6106a3b84
    n, bits = 16_000_000, int("98f1370821", 16)
    many = spark.range(0, n, numPartitions=8).select(F.lit(20).alias("a"))
    assert n * bits > 1 << 63
    assert many.agg(quality.content_digest(many)).first()[0] == n * bits % (1 << 63)
    assert many.limit(3).agg(quality.content_digest(many)).first()[0] == 3 * bits
    assert many.limit(0).agg(quality.content_digest(many)).first()[0] is None


# ---- schema evolution
def test_a_declared_table_gains_columns_and_old_files_read_null(spark):
    old = SILVER["dim_service_package"]
    name, _ = new_table(spark, old, partition_by=("contract",))
    row = {f.name: None for f in old.fields} | {"service_package_key": 1, "contract": "One year"}
    sinks.overwrite_partitions(spark.createDataFrame([row], old), name)
    newer = spark.createDataFrame([(2, "Two year", "Yes")], "service_package_key long, contract string, paperless_billing string")
    assert catalog.add_columns(spark, name, newer.schema) == ["paperless_billing"]
    assert catalog.add_columns(spark, name, newer.schema) == []
    sinks.overwrite_partitions(newer, name)
    assert rows(spark.table(name), "service_package_key", "contract", "paperless_billing") == [(1, "One year", None), (2, "Two year", "Yes")]
    names = {r["column_name"]: r["data_type"] for r in catalog.data_dictionary(spark, "default", [name]).collect()}
    assert names["paperless_billing"] == "string" and names["service_package_key"] == "bigint"
