"""A daily job: validate the day's invoice file, store its partial totals, and
publish the Total-labelled cube over every day stored so far.

    spark-submit --py-files tierwise.zip examples/daily_totals.py \\
        --facts landing/2026-12-01.csv --dictionary tiers.csv \\
        --partials store/partials --day 2026-12-01 --out published/totals --rejects published/rejects

Each day reads only that day's rows; the cube is rolled up from the stored
partial rows of all days. Re-running a day replaces that day's partials.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tierwise import (  # noqa: E402
    INVOICE,
    TIER,
    configure,
    invoice_metrics,
    partial_totals,
    read_csv,
    totals_from_partials,
    validated_rows,
    write_csv,
)

DIMS = ["legal_entity", "counter_party", "tier"]


def run(spark, facts, dictionary, partials, day, out, rejects):
    valid, rejected, bad_lines = validated_rows(spark, facts, INVOICE)
    write_csv(rejected, f"{rejects}/day={day}", mode="overwrite")
    tiers = read_csv(spark, dictionary, TIER)
    part = partial_totals(valid, tiers, "counter_party", DIMS, invoice_metrics())
    part.write.mode("overwrite").parquet(f"{partials}/day={day}")
    stored = spark.read.parquet(partials).drop("day")
    cube = totals_from_partials(stored, DIMS, invoice_metrics(), "cube", "total")
    write_csv(cube, out, mode="overwrite")
    return cube


def main() -> None:
    p = argparse.ArgumentParser(description=__doc__.split("\n\n")[0])
    for name in ("facts", "dictionary", "partials", "day", "out", "rejects"):
        p.add_argument(f"--{name}", required=True)
    a = p.parse_args()
    spark = configure(SparkSession.builder.appName("daily-totals").getOrCreate())
    run(spark, a.facts, a.dictionary, a.partials, a.day, a.out, a.rejects)


if __name__ == "__main__":
    main()
