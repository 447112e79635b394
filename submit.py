"""Entry for spark-submit:

spark-submit --py-files sluice.zip submit.py --endpointsConfigPath ... --tablesConfigPath ...
    --schemasPath ... --sourceName ... --sinkName ... --mode daily
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from sluice import run_from_files

# The names of the run's arguments.
REQUIRED = ("endpointsConfigPath", "tablesConfigPath", "sourceName", "sinkName", "mode")
OPTIONAL = ("schemasPath",)


def main() -> None:
    parser = argparse.ArgumentParser(description="Copy the tables of one mode.")
    for name in REQUIRED:
        parser.add_argument(f"--{name}", required=True)
    for name in OPTIONAL:
        parser.add_argument(f"--{name}")
    parser.add_argument("--asOf", dest="as_of", help="the run's day, today in UTC if not given")
    parser.add_argument(
        "--customModes",
        dest="custom_modes",
        action="store_true",
        help="take any other mode as a full read that appends",
    )
    parser.add_argument(
        "--tablesAtOnce",
        dest="tables_at_once",
        type=int,
        default=1,
        help="how many tables are in work at a time",
    )
    parser.add_argument("--resume", help="the run's name; what a run of this name has finished is left out")
    arguments = vars(parser.parse_args())
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    spark = SparkSession.builder.appName("sluice").getOrCreate()
    run_from_files(spark, **arguments).show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
