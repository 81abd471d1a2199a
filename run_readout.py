"""Batch entry point.

spark-submit run_readout.py {analysis,dashboard,bi} INPUT OUTPUT [--input-format csv]
spark-submit run_readout.py load BATCH WAREHOUSE [--input-format csv]     # upsert all tables found, or none
spark-submit run_readout.py qa WAREHOUSE                                  # constraints and gates; fails if any is broken
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from liftline.operators.quality import require_constraints, require_quality
from liftline.plans.readout import analysis_readout, bi_export, dashboard_readout
from liftline.schemas import READOUT_INPUTS, TABLES
from liftline.sources.files import missing_inputs, read_tables
from liftline.sources.upsert import upsert_tables

READOUTS = {"analysis": analysis_readout, "dashboard": dashboard_readout, "bi": bi_export}


def load(spark: SparkSession, batch: str, warehouse: str, fmt: str = "parquet") -> list[str]:
    """Upsert every table found in ``batch``; its rows must keep all constraints before any table changes."""
    missing = set(missing_inputs(spark, batch, TABLES, fmt))
    names = [n for n in TABLES if n not in missing]
    if not names:
        raise FileNotFoundError(f"no tables under {batch}")
    upsert_tables(spark, warehouse, read_tables(spark, batch, names, fmt), constraints=True)
    return names


def qa(spark: SparkSession, warehouse: str, fmt: str = "parquet") -> None:
    tables = read_tables(spark, warehouse, None, fmt)
    require_constraints(tables)
    require_quality(tables["dim_users"], tables["fact_events"])


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("job", choices=[*sorted(READOUTS), "load", "qa"])
    parser.add_argument("input", help="folder holding one file or folder per warehouse table")
    parser.add_argument("output", nargs="?", help="folder for the result tables, or the warehouse to load into")
    parser.add_argument("--input-format", default="parquet", choices=["parquet", "csv"])
    parser.add_argument("--output-format", default="csv", choices=["parquet", "csv"])
    args = parser.parse_args()
    if args.job != "qa" and not args.output:
        parser.error("output is needed")

    spark = SparkSession.builder.appName(f"readout-{args.job}").getOrCreate()
    if args.job == "qa":
        qa(spark, args.input, args.input_format)
    elif args.job == "load":
        print("\n".join(load(spark, args.input, args.output, args.input_format)))
    else:
        tables = read_tables(spark, args.input, READOUT_INPUTS, args.input_format)
        for name, path in READOUTS[args.job](spark, tables, args.output, fmt=args.output_format).items():
            print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
