"""The jobs as a program for spark-submit.

    spark-submit tideline/plans/run.py star --source /data/tables --database mart
    spark-submit tideline/plans/run.py changes --database mart --size 5000 --seed 42
    spark-submit tideline/plans/run.py passengers --source /data/tables --database mart

Without ``--source`` tables are read from the session's catalog.
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from pyspark.sql import SparkSession  # noqa: E402

from tideline.plans import jobs  # noqa: E402
from tideline.sources.tables import load_tables  # noqa: E402


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Write the star schema, apply changes, or write the passenger tables.")
    parser.add_argument("job", choices=("star", "changes", "passengers"))
    parser.add_argument("--source", help="folder of Parquet tables; the catalog's if left out")
    parser.add_argument("--database", required=True, help="database to write to; made if it is absent")
    parser.add_argument("--size", type=int, default=jobs.SAMPLE_SIZE, help="orders to change")
    parser.add_argument("--seed", type=int, default=jobs.SEED)
    return parser.parse_args(given)


def run(spark: SparkSession, options: argparse.Namespace) -> dict[str, int]:
    """Rows of every table that the job wrote."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {options.database}")
    if options.job == "changes":
        return jobs.run_change_cycle(spark, options.database, options.size, options.seed)
    job = jobs.build_star_schema if options.job == "star" else jobs.build_passenger_marts
    return job(spark, load_tables(spark, options.source), options.database)


if __name__ == "__main__":
    for table, rows in run(SparkSession.builder.getOrCreate(), arguments()).items():
        print(f"{table}\t{rows}")
