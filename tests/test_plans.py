"""The physical plans the operators produce: scans, Expand, shuffles, joins, skew."""

from __future__ import annotations

from conftest import rows
from pyspark.sql import functions as F

from tierwise.functions.metrics import invoice_metrics
from tierwise.operators import joins
from tierwise.operators import totals as T
from tierwise.plans import catalog

DIMS = ["legal_entity", "counter_party", "tier"]
SF = "/root/testdata/sf0.001"


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def scans(df) -> int:
    import re

    return len(re.findall(r"^\(\d+\) Scan parquet", formatted(df), flags=re.M))


def test_totals_after_join_is_one_scan_one_expand_one_shuffle(spark):
    df = catalog.totals_after_join(spark, SF)
    plan = plan_text(df)
    assert plan.count("Expand") == 1
    assert scans(df) == 2  # lineitem once, supplier once
    assert "BroadcastHashJoin" in formatted(df)
    assert plan.count("Exchange hashpartitioning") == 1


def test_totals_aggregate_fact_rows_before_the_join(spark):
    df = catalog.totals_count_label(spark, SF)
    text = formatted(df)
    assert plan_text(df).count("Expand") == 1 and scans(df) == 2
    # The fact side of the join is a final aggregate over (legal_entity, counter_party).
    tree = text.split("\n\n")[0]
    join_at = tree.index("BroadcastHashJoin")
    assert "HashAggregate" in tree[join_at:]
    assert plan_text(df).count("Exchange hashpartitioning") == 2


def test_union_form_scans_once_per_set(spark):
    df = catalog.totals_union_form(spark, SF)
    assert scans(df) >= 6


def test_preaggregation_adds_one_shuffle(spark):
    df = catalog.totals_preaggregated(spark, SF)
    assert plan_text(df).count("Exchange hashpartitioning") == 2


def test_scan_reads_only_needed_columns(spark):
    text = formatted(catalog.totals_count_label(spark, SF))
    lineitem_schema = [line for line in text.splitlines() if "ReadSchema" in line and "l_suppkey" in line][0]
    assert "l_shipdate" not in lineitem_schema and "l_extendedprice" not in lineitem_schema
    assert "s_acctbal" not in text  # the whole dictionary, two columns of it
    by_status = formatted(catalog.totals_by_status(spark, SF))
    assert "In(l_returnflag, [A,R])" in by_status  # the status filter reaches the scan


def test_checked_broadcast_falls_back_when_too_large(spark):
    sf = "/root/testdata/sf0.01"  # 48 dictionary rows
    fact = catalog.inv.invoices(spark, sf)
    dictionary = catalog.inv.tiers(spark, sf)
    _, ok = joins.checked_broadcast(dictionary, max_rows=10)
    assert not ok
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = joins.enrich(fact, dictionary, "counter_party", broadcast=True, max_broadcast_rows=1000)
        assert "BroadcastHashJoin" in formatted(small)
        large = joins.enrich(fact, dictionary, "counter_party", broadcast=True, max_broadcast_rows=10)
        assert "SortMergeJoin" in formatted(large)
        assert rows(small) == rows(large)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_salted_join_on_a_hot_key_equals_plain_join(spark):
    # One key holds a third of all fact rows.
    fact = spark.range(0, 3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k")
    )
    dictionary = spark.range(0, 50).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    plain = joins.enrich(fact, dictionary, "k")
    salted = joins.enrich(fact, dictionary, "k", broadcast=False, salt=8, hot_rows=500)
    assert rows(salted, ["id", "k", "w"]) == rows(plain, ["id", "k", "w"])
    assert [r.k for r in joins.hot_keys(fact, "k", 500).collect()] == [0]
    # Hot rows are tagged by a broadcast join: the fact is shuffled once, for the salted join.
    text = formatted(salted)
    assert text.count("BroadcastHashJoin") >= 1


def test_salted_join_goes_on_beyond_the_hot_key_bound(spark):
    # All ten keys are hot at 10 rows; only five may be: the bound rises, the join goes on.
    fact = spark.range(0, 1000).select("id", (F.col("id") % 10).alias("k"))
    dictionary = spark.range(0, 10).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    plain = joins.enrich(fact, dictionary, "k")
    salted = joins.enrich(fact, dictionary, "k", broadcast=False, salt=4, hot_rows=10, max_hot_keys=5)
    assert rows(salted, ["id", "k", "w"]) == rows(plain, ["id", "k", "w"])


def test_salted_left_join_keeps_null_keys_out_of_the_shuffle(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = spark.range(0, 3000).select("id", F.when(F.col("id") % 3 != 0, F.col("id") % 50).alias("k"))
        dictionary = spark.range(0, 40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
        plain = joins.enrich(fact, dictionary, "k", "left")
        salted = joins.enrich(fact, dictionary, "k", "left", broadcast=False, salt=8, hot_rows=500)
        assert rows(salted, ["id", "k", "w"]) == rows(plain, ["id", "k", "w"])
        by_task = salted.filter(F.col("k").isNull()).groupBy(F.spark_partition_id()).count().collect()
        assert len(by_task) > 1  # they stay in the partitions they were read in
        assert "isnotnull(k" in formatted(salted).lower()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_first_by_is_a_partial_aggregate_not_a_window(spark):
    d = catalog.inv.suppliers_by_nation(spark, SF)
    plan = plan_text(joins.first_by(d, "nationkey", "suppkey"))
    assert "Window" not in plan
    assert "HashAggregate" in plan or "SortAggregate" in plan


def test_totals_preaggregate_matches_on_real_tables(spark):
    a = rows(catalog.totals_cube_label(spark, SF))
    b = rows(catalog.totals_preaggregated(spark, SF))
    assert a == b


def test_totals_union_matches_on_real_tables(spark):
    e = catalog.enriched(spark, SF)
    a = rows(T.totals(e, DIMS, invoice_metrics(), "pairs", "count"))
    b = rows(T.totals_union(e, DIMS, invoice_metrics(), "pairs", "count"))
    assert a == b


def test_bucketed_tables_join_and_preaggregate_without_a_shuffle(spark):
    from tierwise import sinks

    sf = "/root/testdata/sf0.01"
    for name in ("inv_bucketed", "tier_bucketed"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    sinks.write_table(catalog.inv.invoices(spark, sf), "inv_bucketed", bucket_by="counter_party", buckets=8)
    sinks.write_table(catalog.inv.tiers(spark, sf), "tier_bucketed", bucket_by="counter_party", buckets=8)
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in old:
            spark.conf.set(k, "-1")  # force a shuffle-free sort-merge join, not a broadcast
        df = T.totals_over_join(
            spark.table("inv_bucketed"), spark.table("tier_bucketed"), "counter_party", DIMS, invoice_metrics(), "cube", "total"
        )
        plan = plan_text(df)
        assert "SortMergeJoin" in plan
        # One shuffle in all: the grouping sets. The pre-aggregate and the join run per bucket.
        assert plan.count("Exchange hashpartitioning") == 1
        assert rows(df) == rows(catalog.totals_cube_label(spark, sf))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
        for name in ("inv_bucketed", "tier_bucketed"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_salted_null_safe_join_with_a_hot_null_key(spark):
    # A third of the fact rows have no key; under null-safe matching they all
    # meet the dictionary's null-key row, the hottest key of all.
    fact = spark.range(0, 3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 50).cast("bigint").alias("k")
    )
    dictionary = spark.createDataFrame([(None, -1)] + [(i, i * 10) for i in range(50)], "k bigint, w bigint")
    plain = joins.enrich(fact, dictionary, "k", null_safe=True)
    salted = joins.enrich(fact, dictionary, "k", null_safe=True, broadcast=False, salt=8, hot_rows=500)
    assert salted.columns == plain.columns
    assert rows(salted, ["id", "k", "w"]) == rows(plain, ["id", "k", "w"])
    assert salted.filter(F.col("k").isNull()).count() == 1000


def test_broadcast_check_bounds_bytes_as_well_as_rows(spark):
    wide = spark.range(0, 100).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 1000).alias("payload"))
    n, size = joins.measure(wide)
    assert n == 100 and size == 100 * (8 + 1000)
    assert joins.checked_broadcast(wide, max_rows=1000, max_bytes=200_000)[1]
    assert not joins.checked_broadcast(wide, max_rows=1000, max_bytes=50_000)[1]
    assert not joins.checked_broadcast(wide, max_rows=50, max_bytes=10**9)[1]


def test_salted_left_join_keeps_unmatched_rows(spark):
    fact = spark.range(0, 3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 60).alias("k")
    )
    dictionary = spark.range(0, 50).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    plain = joins.enrich(fact, dictionary, "k", "left")
    salted = joins.enrich(fact, dictionary, "k", "left", broadcast=False, salt=8, hot_rows=500)
    assert rows(salted, ["id", "k", "w"]) == rows(plain, ["id", "k", "w"])
    assert salted.filter(F.col("w").isNull()).count() > 0


def test_hot_fraction_bounds_the_hot_keys(spark):
    fact = spark.range(0, 3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k")
    )
    dictionary = spark.range(0, 50).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    plain = joins.enrich(fact, dictionary, "k")
    # Only key 0 holds a third of the rows; every other key holds about 1.3%.
    salted = joins.enrich(fact, dictionary, "k", broadcast=False, salt=8, hot_fraction=0.2)
    assert rows(salted, ["id", "k", "w"]) == rows(plain, ["id", "k", "w"])


def test_rejects_check_every_field_once(spark):
    plan = plan_text(catalog.reject_reasons(spark, SF))
    assert plan.count("RLIKE") == 3  # three integer fields
    assert "SinglePartition" not in plan
