"""Command line: run a layer of the warehouse in the current Spark application.

    spark-submit --py-files strata.zip -m strata bronze --source-dir DIR --bronze-base DIR
    python -m strata silver --bronze-base DIR --silver-base DIR [--only dim_customer ...]
    python -m strata ddl --bronze-base DIR --silver-base DIR      # declare databases and tables only
    python -m strata validate --bronze-base DIR                    # minimum-row gate on loaded bronze tables

Uses the session that ``spark-submit`` (or the environment) configures; set
``spark.checkpoint.dir`` to a shared folder on a cluster.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .operators import quality
from .plans import flows
from .plans.schemas import SILVER


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="strata")
    ap.add_argument("layer", choices=["bronze", "silver", "all", "ddl", "validate"])
    ap.add_argument("--source-dir", default="", help="folder with the delimited source files")
    ap.add_argument("--bronze-base", required=True, help="bronze Parquet root ({base}/{table}/parquet)")
    ap.add_argument("--silver-base", default="", help="silver table root ({base}/{table})")
    ap.add_argument("--bronze-db", default="bronze_telco")
    ap.add_argument("--silver-db", default="silver_telco")
    ap.add_argument("--audit-table", default=None, help="e.g. silver_telco.load_audit")
    ap.add_argument("--report-table", default=None, help="name of the silver quality report (default: quality_report in the silver database)")
    ap.add_argument("--no-quality-reports", action="store_true", help="leave out the quality reports")
    ap.add_argument("--customer-buckets", type=int, default=None, help="hash status, services and facts by customer")
    ap.add_argument("--facts-by-quarter", action="store_true", help="one folder of facts per quarter")
    ap.add_argument("--location-scd1", action="store_true", help="location members keep their keys (SCD type 1)")
    ap.add_argument("--customer-registry", default=None, help="stable customer keys from this table")
    ap.add_argument("--keyed-facts", action="store_true", help="also write facts with the keys of their dimensions")
    ap.add_argument("--paperless-billing", action="store_true", help="paperless billing as a package attribute")
    ap.add_argument("--only", nargs="*", choices=list(SILVER), help="silver tables to rebuild (default: all)")
    ap.add_argument("--business-year", type=int, default=flows.dims.BUSINESS_YEAR)
    ap.add_argument("--grain-safe-facts", action="store_true", help="join facts on customer and quarter")
    ap.add_argument("--prefer-internet-type", action="store_true",
                    help="internet service from the connection type first (documented intent)")
    ap.add_argument("--no-enforce", action="store_true", help="report check failures without failing the run")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"strata-{args.layer}").getOrCreate()
    cfg = flows.WarehouseConfig(
        source_dir=args.source_dir,
        bronze_base=args.bronze_base,
        silver_base=args.silver_base,
        bronze_db=args.bronze_db,
        silver_db=args.silver_db,
        audit_table=args.audit_table,
        report_table=args.report_table,
        quality_reports=not args.no_quality_reports,
        customer_buckets=args.customer_buckets,
        facts_by_quarter=args.facts_by_quarter,
        location_scd1=args.location_scd1,
        customer_registry=args.customer_registry,
        keyed_facts=args.keyed_facts,
        paperless_billing=args.paperless_billing,
        business_year=args.business_year,
        facts_join_on=("customer_id", "quarter") if args.grain_safe_facts else ("customer_id",),
        prefer_internet_type=args.prefer_internet_type,
    )
    enforce = not args.no_enforce
    if args.layer == "ddl":
        flows.create_bronze_tables(spark, cfg)
        if args.silver_base:
            flows.create_silver_tables(spark, cfg)
        return 0
    if args.layer == "validate":
        report = quality.min_rows(flows.bronze_tables(spark, cfg), cfg.min_rows)
        report.show(truncate=False)
        if enforce:
            quality.enforce(report, "bronze minimum rows")
        return 0
    if args.layer in ("bronze", "all"):
        flows.run_bronze(spark, cfg, enforce=enforce).show(truncate=False)
    if args.layer in ("silver", "all"):
        only = tuple(args.only) if args.only else None
        flows.run_silver(spark, cfg, enforce=enforce, only=only).show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
