"""Delimited ingest, lineage, parquet sink, catalog tables, schema-keeping writes."""

import os

import pytest
from pyspark.sql import functions as F

from strata.plans.schemas import SILVER, bronze_file_schema
from strata.session import scratch_path
from strata.sources import catalog, ingest, sinks


def write_text(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_csv_with_bom_quotes_and_declared_schema(spark):
    folder = scratch_path(spark, "csv")
    # BOM before the header, header case differs from the declaration,
    # thousands separator in a quoted field, an unparsable zip code
    write_text(f"{folder}/pop.csv", '﻿ID,Zip_Code,Population\n1,90001,"54,492"\n2,oops,678\n3,96148,\n')
    df = ingest.read_delimited(spark, f"{folder}/pop.csv", bronze_file_schema("population"))
    assert df.columns == ["id", "zip_code", "population"]
    got = sorted(tuple(r) for r in df.collect())
    assert got == [(1, 90001, "54,492"), (2, None, "678"), (3, 96148, None)]


def test_declared_column_missing_from_file_is_null(spark):
    folder = scratch_path(spark, "csv")
    write_text(f"{folder}/d.csv", "customer_id,gender\nc1,M\n")
    df = ingest.read_delimited(spark, f"{folder}/d.csv", bronze_file_schema("demographics"))
    r = df.first()
    assert r.customer_id == "c1" and r.gender == "M" and r.age is None and r.number_of_dependents is None


def test_infer_schema_option(spark):
    folder = scratch_path(spark, "csv")
    write_text(f"{folder}/x.csv", "a,b\n1,2.5\n3,4.0\n")
    df = ingest.read_delimited(spark, f"{folder}/x.csv", infer_schema=True)
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["int", "double"]


def test_ingest_file_counts_in_the_write_and_adds_lineage(spark):
    src = scratch_path(spark, "src")
    write_text(f"{src}/Telco_customer_churn_population.csv/part-0.csv", "id,zip_code,population\n1,1,5\n2,2,\n")
    target = scratch_path(spark, "bronze")
    res = ingest.ingest_file(spark, src, ingest.SourceFile("Telco_customer_churn_population.csv", "population"),
                             target, bronze_file_schema("population"))
    assert res.rows == 2
    back = spark.read.parquet(res.path)
    assert back.select("source_file").distinct().collect()[0][0] == "Telco_customer_churn_population.csv"
    assert back.select(F.count_distinct("ingestion_timestamp")).first()[0] == 1
    # full load: a second run replaces, never appends
    ingest.ingest_file(spark, src, ingest.SourceFile("Telco_customer_churn_population.csv", "population"),
                       target, bronze_file_schema("population"))
    assert spark.read.parquet(res.path).count() == 2


def test_rejected_values_are_kept_and_counted(spark):
    src, target = scratch_path(spark, "src"), scratch_path(spark, "bronze")
    write_text(f"{src}/pop.csv", "id,zip_code,population,note\n1,9000x,5,a\n2,,7,b\nthree,99999999999,x,c\n4,90001,8,d\n")
    res = ingest.ingest_file(spark, src, ingest.SourceFile("pop.csv", "population"), target, bronze_file_schema("population"))
    assert res.rows == 4 and res.rejected == {"id": 1, "zip_code": 2}
    got = {r["note"]: (r["id"], r["zip_code"], r["rescued_values"]) for r in spark.read.parquet(res.path).collect()}
    assert got == {"a": (1, None, {"zip_code": "9000x"}), "b": (2, None, None), "d": (4, 90001, None),
                   "c": (None, None, {"id": "three", "zip_code": "99999999999"})}
    plain = ingest.ingest_file(spark, src, ingest.SourceFile("pop.csv", "population"), target,
                               bronze_file_schema("population"), rescue=False)
    assert plain.rejected == {} and "rescued_values" not in spark.read.parquet(plain.path).columns


def test_stage_keeps_padding(spark):
    df = spark.createDataFrame([(" a ", None), ("b", "x,y")], "s string, t string")
    path = scratch_path(spark, "stage")
    ingest.stage_delimited(df, path)
    back = sorted(tuple(r) for r in ingest.read_delimited(spark, path).collect())
    assert back == [(" a ", None), ("b", "x,y")]


def test_external_table_and_schema_keeping_overwrite(spark):
    root = scratch_path(spark, "wh")
    db = "t_" + root.rsplit("-", 1)[-1]
    catalog.create_database(spark, db)
    catalog.create_database(spark, db)  # idempotent
    name = f"{db}.dim_customer"
    assert catalog.create_table(spark, name, SILVER["dim_customer"], f"{root}/dim_customer", "comment")
    assert not catalog.create_table(spark, name, SILVER["dim_customer"], f"{root}/dim_customer")
    df = spark.createDataFrame([(1, "c1", 30, "25-34", "Male", "Married", 1, 3)],
                               "customer_key int, customer_id string, age int, age_group string, gender string, "
                               "marital_status string, number_of_dependents int, family_size int")
    assert sinks.overwrite_table(df, name) == {"rows": 1}
    assert sinks.overwrite_table(df.union(df.withColumn("customer_key", F.lit(2))), name) == {"rows": 2}
    t = spark.table(name)
    assert t.count() == 2
    assert t.schema["customer_key"].dataType.simpleString() == "bigint"
    assert t.schema["customer_key"].metadata.get("comment") == SILVER["dim_customer"]["customer_key"].metadata["comment"]
    info = {n: (k, loc) for n, k, loc in catalog.table_info(spark, db)}
    assert info["dim_customer"][0] == "EXTERNAL"
    assert info["dim_customer"][1].rstrip("/").endswith("dim_customer")
    dd = catalog.data_dictionary(spark, db, ["dim_customer"]).collect()
    assert len(dd) == len(SILVER["dim_customer"].fields)


def test_checkpoint_root_is_reused(spark):
    from strata.session import checkpoint_root

    assert checkpoint_root(spark) == checkpoint_root(spark)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_ansi_mode_does_not_change_results(spark, ansi):
    from strata.functions import standard as std

    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([("1.2.3",), ("", ), ("99999999999",), ("12,5",)], "p string")
        got = [r[0] for r in df.select(std.clean_count("p")).collect()]
        assert got == [None, 0, None, 125]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_ingest_rebalance_keeps_rows(spark):
    src = scratch_path(spark, "src")
    write_text(f"{src}/Telco_customer_churn_population.csv/part-0.csv",
               "id,zip_code,population\n" + "".join(f"{i},{i},{i}\n" for i in range(500)))
    target = scratch_path(spark, "bronze")
    res = ingest.ingest_file(spark, src, ingest.SourceFile("Telco_customer_churn_population.csv", "population"),
                             target, bronze_file_schema("population"), rebalance=True)
    assert res.rows == 500 and spark.read.parquet(res.path).count() == 500


def test_current_database_is_restored(spark):
    before = spark.catalog.currentDatabase()
    catalog.create_database(spark, "t_switch_db")
    with catalog.current_database(spark, "t_switch_db"):
        assert spark.catalog.currentDatabase() == "t_switch_db"
    assert spark.catalog.currentDatabase() == before


def test_command_line_runs_both_layers(spark, sf_smoke):
    """The CLI entry point over staged source files: bronze then one silver table."""
    from strata.__main__ import main
    from strata.plans.registry import _stage_sources

    src = _stage_sources(spark, sf_smoke)
    root = scratch_path(spark, "cli")
    tag = root.rsplit("-", 1)[-1]
    args = ["--source-dir", src, "--bronze-base", f"{root}/bronze", "--silver-base", f"{root}/silver",
            "--bronze-db", f"cli_b_{tag}", "--silver-db", f"cli_s_{tag}", "--no-enforce"]
    assert main(["ddl", *args]) == 0
    assert main(["bronze", *args]) == 0
    assert main(["validate", *args]) == 0  # --no-enforce: reports, does not raise
    assert main(["silver", *args, "--only", "dim_quarter", "dim_promotion"]) == 0
    assert main(["silver", *args, "--report-table", f"cli_s_{tag}.quality_report"]) == 0
    assert spark.table(f"cli_s_{tag}.quality_report").where("run_id IS NOT NULL").count() >= 28
    assert spark.table(f"cli_s_{tag}.dim_quarter").count() == 6
    assert spark.table(f"cli_s_{tag}.dim_customer").count() > 0  # rebuilt by the full silver run


def test_bronze_gate_raises_once_naming_every_short_table(spark, sf_smoke):
    from strata.operators.quality import DataQualityError
    from strata.plans import flows
    from strata.plans.registry import _config

    cfg = _config(spark, sf_smoke)  # sf0.001: every table is below its minimum
    with pytest.raises(DataQualityError) as err:
        flows.run_bronze(spark, cfg, enforce=True)
    for t in ("demographics", "location", "population", "services", "status"):
        assert t in str(err.value)
    # the silver gate passes: every table has rows
    audit = flows.run_silver(spark, cfg, enforce=True)
    assert {r.table_name for r in audit.collect()} == set(flows.SILVER_COMMENTS)
