"""spark-submit entry point: build the marts, then run the checks.

    spark-submit tidemark/plans/run.py --raw-root s3://bucket/raw --database marts
    spark-submit tidemark/plans/run.py --raw-database raw --checks-only

Without ``--checks-only`` the three marts are built as new versions and then
published (full refresh). With ``--checks`` the 95 data-quality checks run on
those versions first: a failing check on a mart keeps the marts published
before (``--gate`` widens or lifts that), and any failing check ends the job
with status 1, so a scheduler can stop downstream work. The check results are
also written as a table (``<database>.quality_results``) for inspection.
The session's own settings (cluster size, shuffle partitions,
checkpoint folder) are left as submitted; only the semantics the models
need (UTC, ANSI, AQE) are applied.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys
from collections.abc import Mapping

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tidemark.functions.expr import run_timestamp  # noqa: E402
from tidemark.operators.quality import run_checks  # noqa: E402
from tidemark.plans.models import Warehouse  # noqa: E402
from tidemark.session import configure  # noqa: E402
from tidemark.sources.catalog import MART_KEYS, build_marts, ensure_database  # noqa: E402
from tidemark.sources.publish import AuditFailed  # noqa: E402
from tidemark.sources.raw import read_catalog_tables, read_parquet_tables  # noqa: E402


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--raw-root", help="folder with <group>/<table> parquet datasets")
    src.add_argument("--raw-database", help="catalog database holding the raw tables")
    p.add_argument("--database", default="marts", help="database for the mart tables")
    p.add_argument("--as-of", type=dt.date.fromisoformat, default=None,
                   help="run date for day counts (default: today)")
    p.add_argument("--checks", action="store_true", help="run the 95 checks after the build")
    p.add_argument("--checks-only", action="store_true", help="run the checks, skip the build")
    p.add_argument("--gate", choices=("marts", "all", "none"), default="marts",
                   help="whose failing checks keep a build from being published")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    args = parse(argv)
    spark = configure(SparkSession.builder.appName("tidemark").getOrCreate())
    raw = (read_parquet_tables(spark, args.raw_root) if args.raw_root
           else read_catalog_tables(spark, args.raw_database))
    run_ts = dt.datetime.now(dt.timezone.utc).replace(microsecond=0)
    wh = Warehouse(raw, as_of=args.as_of, run_ts=run_ts)
    ensure_database(spark, args.database)
    results = f"{args.database}.quality_results"
    if not (args.checks or args.checks_only):
        for table in build_marts(spark, wh, database=args.database):
            print(f"built {table}")
        return 0

    def checked(marts: Mapping[str, str]) -> DataFrame:
        """Run all checks, the marts' on the given tables; the rows that gate a build."""
        (run_checks(lambda name: spark.table(marts[name]) if name in marts else wh.model(name))
         .withColumn("checked_at", run_timestamp(run_ts)).write.mode("overwrite").saveAsTable(results))
        gate = {"marts": F.col("model").isin(*MART_KEYS), "all": F.lit(True), "none": F.lit(False)}[args.gate]
        return spark.table(results).where(gate)

    wh.write_checked(("helper",))  # build and checks read the same evaluated models
    if args.checks_only:
        checked({name: f"{args.database}.{name}" for name in MART_KEYS})
    else:
        try:
            for table in build_marts(spark, wh, database=args.database, audit=checked):
                print(f"built {table}")
        except AuditFailed as stopped:
            print(stopped)
    failed = spark.table(results).where(F.col("failures") > 0)
    n_failed = failed.count()
    failed.orderBy("model", "column_name", "test").show(100, truncate=False)
    print(f"{n_failed} of 95 checks failed; results in {results}")
    return 1 if n_failed else 0


if __name__ == "__main__":
    sys.exit(main())
