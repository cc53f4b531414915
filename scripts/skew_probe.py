"""Skew probe: one join key holding a third of the fact rows, no broadcast.

Usage: python scripts/skew_probe.py [sf_dir]

Reassigns every third invoice line to one counter party (a derived, skewed
copy of the fact), disables broadcast joins so the dictionary join must
shuffle, and times three plans of the same cube:

* join first, then aggregate (sort-merge join on the skewed key);
* the same with explicit hot-key salting;
* aggregate before the join (``totals_over_join``).

Prints one JSON line; results are checked equal before timing is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tierwise.functions.metrics import invoice_metrics  # noqa: E402
from tierwise.operators import joins, totals  # noqa: E402
from tierwise.plans import invoices as inv  # noqa: E402
from tierwise.session import local_session  # noqa: E402

DIMS = list(inv.DIMS)
HOT_KEY = 1


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 16)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    fact = inv.invoices(spark, sf_dir).withColumn(
        "counter_party", F.when(F.col("invoice_id") % 3 == 0, F.lit(HOT_KEY).cast("bigint")).otherwise(F.col("counter_party"))
    )
    tiers = inv.tiers(spark, sf_dir).unionByName(
        spark.range(1).select(F.lit(HOT_KEY).cast("bigint").alias("counter_party"), F.lit(99).cast("bigint").alias("tier"))
    )
    n = fact.count()
    hot = fact.filter(F.col("counter_party") == HOT_KEY).count()
    plans = {
        "join_then_aggregate": lambda: totals.totals(joins.enrich(fact, tiers, "counter_party"), DIMS, invoice_metrics(), "cube", "total"),
        "salted_join_then_aggregate": lambda: totals.totals(
            joins.enrich(fact, tiers, "counter_party", salt=16, hot_rows=max(1, n // 10)), DIMS, invoice_metrics(), "cube", "total"
        ),
        "aggregate_then_join": lambda: totals.totals_over_join(fact, tiers, "counter_party", DIMS, invoice_metrics(), "cube", "total"),
    }
    results = {name: sorted(map(tuple, mk().collect()), key=repr) for name, mk in plans.items()}
    assert all(r == results["join_then_aggregate"] for r in results.values())
    times = {name: [] for name in plans}
    for r in range(3):
        for name in (list(plans) if r % 2 == 0 else list(plans)[::-1]):
            t0 = time.perf_counter()
            plans[name]().write.format("noop").mode("overwrite").save()
            times[name].append(time.perf_counter() - t0)
    print(json.dumps({
        "sf_dir": sf_dir, "fact_rows": n, "hot_key_rows": hot,
        "median_sec": {k: round(statistics.median(v), 3) for k, v in times.items()},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
