"""Scale probe: the totals plans over k copies of the sf0.1 fact.

Usage: python scripts/scale_probe.py [--no-broadcast] [sf_dir] [k ...]

Each invoice row is repeated k times with ``explode(sequence(1, k))`` (no
cross join), so rows grow k-fold while groups stay the same, as they do when
more days of data arrive. ``--no-broadcast`` disables broadcast joins, as for
a dictionary too large to broadcast. Prints one JSON line of median seconds
per plan and k.
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


def main() -> None:
    args = sys.argv[1:]
    no_broadcast = "--no-broadcast" in args
    args = [a for a in args if a != "--no-broadcast"]
    sf_dir = args[0] if args else "/root/testdata/sf0.1"
    ks = [int(k) for k in args[1:]] or [1, 4, 16]
    spark = local_session(8, 16)
    if no_broadcast:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    tiers = inv.tiers(spark, sf_dir)
    base_rows = inv.invoices(spark, sf_dir).count()
    out = {}
    for k in ks:
        fact = inv.invoices(spark, sf_dir)
        if k > 1:
            fact = fact.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.lit(k)))).drop("__copy")
        plans = {
            "aggregate_then_join": lambda: totals.totals_over_join(fact, tiers, "counter_party", DIMS, invoice_metrics(), "pairs", "count"),
            "join_then_aggregate": lambda: totals.totals(joins.enrich(fact, tiers, "counter_party"), DIMS, invoice_metrics(), "pairs", "count"),
            "union_of_six": lambda: totals.totals_union(joins.enrich(fact, tiers, "counter_party"), DIMS, invoice_metrics(), "pairs", "count"),
        }
        for name, mk in plans.items():
            ts = []
            for _ in range(3):
                t0 = time.perf_counter()
                mk().write.format("noop").mode("overwrite").save()
                ts.append(time.perf_counter() - t0)
            out.setdefault(name, {})[f"x{k}"] = round(statistics.median(ts), 3)
    print(json.dumps({"sf_dir": sf_dir, "broadcast": not no_broadcast, "rows_base": base_rows, "median_sec": out}))
    spark.stop()


if __name__ == "__main__":
    main()
