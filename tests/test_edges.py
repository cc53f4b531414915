"""Edge rows: nulls, unknown statuses, negatives, duplicate and missing
dictionary keys, a literal ``Total`` value, and the union typing trap."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tierwise.functions.metrics import count_of, count_rows, invoice_metrics, max_of, metric_set, sum_if, sum_of
from tierwise.operators import joins
from tierwise.operators import totals as T
from tierwise.operators.joins import enrich

DIMS = ["legal_entity", "counter_party", "tier"]
FACT = "invoice_id long, legal_entity string, counter_party string, rating long, status string, value long"


@pytest.fixture(scope="module")
def edge_fact(spark):
    return spark.createDataFrame(
        [
            (1, "L1", "C1", 3, "ARAP", 10),
            (2, "L1", None, 2, "ARAP", 5),  # null join key
            (3, None, "C1", 1, "ACCR", 7),  # null group key
            (4, "L2", "C2", -4, "ACCR", None),  # negative rating, null value
            (5, "L2", "C2", -2, "OTHER", 100),  # a third status
            (6, "Total", "C1", 1, "ARAP", 1),  # a value that reads like a label
            (7, "L3", "C9", 1, "ARAP", 1),  # key missing from the dictionary
        ],
        FACT,
    )


@pytest.fixture(scope="module")
def edge_dict(spark):
    return spark.createDataFrame(
        [("C1", 1, 20), ("C1", 9, 10), ("C2", 2, 5), (None, 7, 1)],
        "counter_party string, tier long, priority long",
    )


def test_union_of_count_and_text_is_string_typed(enriched):
    # Under ANSI rules a text column unioned with a count would be coerced to
    # a number and fail on 'L1'; every dimension is cast to string first.
    out = T.totals_union(enriched, DIMS, invoice_metrics(), "pairs", "count")
    assert dict(out.dtypes)["legal_entity"] == "string"
    assert out.count() == 37


def test_null_keys_do_not_match_by_default(edge_fact, edge_dict):
    joined = joins.enrich(edge_fact, edge_dict.drop("priority"), "counter_party")
    assert 2 not in {r.invoice_id for r in joined.collect()}


def test_null_safe_join_matches_null_to_null(edge_fact, edge_dict):
    joined = joins.enrich(edge_fact, edge_dict.drop("priority"), "counter_party", null_safe=True)
    got = {(r.invoice_id, r.tier) for r in joined.collect()}
    assert (2, 7) in got
    assert 7 not in {i for i, _ in got}  # a key absent from the dictionary is dropped


def test_duplicate_dictionary_key_multiplies_in_a_plain_join(edge_fact, edge_dict):
    joined = joins.enrich(edge_fact, edge_dict.drop("priority"), "counter_party")
    assert joined.filter(F.col("invoice_id") == 1).count() == 2


def test_lookup_keeps_first_by_declared_order(edge_fact, edge_dict):
    out = joins.lookup(edge_fact, edge_dict, "counter_party", order_by="priority")
    got = {r.invoice_id: r.tier for r in out.collect()}
    assert got[1] == 9  # priority 10 beats priority 20
    assert got[4] == 2
    assert 7 not in got


def test_merge_right_wins_on_shared_names(spark):
    fact = spark.createDataFrame([(1, "k", "left")], "id long, key string, label string")
    dictionary = spark.createDataFrame([("k", "right", 2), ("k", "later", 3)], "key string, label string, seq long")
    out = joins.merge_right_wins(fact, dictionary, "key", order_by="seq").collect()
    assert [(r.id, r.label, r.seq) for r in out] == [(1, "right", 2)]


def test_strict_mode_names_missing_keys(edge_fact, edge_dict):
    with pytest.raises(joins.MissingKeyError, match="C9"):
        joins.enrich(edge_fact.filter(F.col("counter_party").isNotNull()), edge_dict, "counter_party", strict=True)


def test_null_group_keys_are_kept_and_told_apart_from_totals(edge_fact, edge_dict):
    joined = joins.lookup(edge_fact, edge_dict, "counter_party", order_by="priority")
    out = T.totals(joined, DIMS, invoice_metrics(), "cube", "null", grouping_id="gid")
    # The detail row of invoice 3 has a null legal entity but is not a total.
    detail_null = out.filter((F.col("gid") == 0) & F.col("legal_entity").isNull()).collect()
    assert len(detail_null) == 1 and detail_null[0].counter_party == "C1"


def test_literal_total_value_is_not_a_total_row(edge_fact, edge_dict):
    joined = joins.lookup(edge_fact, edge_dict, "counter_party", order_by="priority")
    out = T.totals(joined, DIMS, invoice_metrics(), "cube", "total", grouping_id="gid")
    data_rows = out.filter((F.col("legal_entity") == "Total") & (F.col("gid") == 0)).collect()
    assert len(data_rows) == 1 and data_rows[0].sum_value_ARAP == 1


def test_conditional_sum_of_only_null_values_is_zero(edge_fact, edge_dict):
    joined = joins.lookup(edge_fact, edge_dict, "counter_party", order_by="priority")
    out = T.group_metrics(joined, ["counter_party"], invoice_metrics())
    c2 = out.filter(F.col("counter_party") == "C2").first()
    assert c2.sum_value_ACCR == 0  # the only ACCR row has a null value
    assert c2.sum_value_ARAP == 0  # no ARAP row at all
    assert c2.max_rating == -2  # max of negatives is not floored at 0


def test_third_status_counts_in_max_but_not_in_sums(edge_fact, edge_dict):
    joined = joins.lookup(edge_fact, edge_dict, "counter_party", order_by="priority")
    metrics = metric_set("rating", "value", "status", "ARAP", "ACCR", "OTHER")
    out = T.group_metrics(joined, ["legal_entity"], metrics)
    l2 = out.filter(F.col("legal_entity") == "L2").first()
    assert (l2.sum_value_OTHER, l2.sum_value_ACCR, l2.max_rating) == (100, 0, -2)


def test_count_label_counts_non_null_values(edge_fact, edge_dict):
    joined = joins.lookup(edge_fact, edge_dict, "counter_party", order_by="priority")
    out = T.totals(joined, DIMS, [count_rows()], [["counter_party"]], "count")
    c1 = out.filter(F.col("counter_party") == "C1").first()
    # C1 rows: invoices 1, 3 (null legal entity) and 6.
    assert (c1.legal_entity, c1.n_rows) == ("2", 3)


def test_preaggregated_equals_direct_with_nulls(edge_fact, edge_dict):
    joined = joins.lookup(edge_fact, edge_dict, "counter_party", order_by="priority")
    from tierwise.functions.metrics import count_of, min_of

    metrics = invoice_metrics() + [
        count_rows(),
        max_of("value", "max_value"),
        min_of("rating", "min_rating"),
        count_of("value", "n_value"),
        sum_if("value", F.col("rating") > 0, "pos"),
    ]
    for label in ("count", "total", "null"):
        direct = T.totals(joined, DIMS, metrics, "cube", label, grouping_id="g")
        pre = T.totals(joined, DIMS, metrics, "cube", label, grouping_id="g", preaggregate=True)
        assert rows(direct) == rows(pre)


def test_cube_over_seven_dimensions(spark):
    dims = [f"d{i}" for i in range(7)]
    df = spark.range(4).select(*[(F.col("id") % 2).alias(d) for d in dims], F.col("id").alias("v"))
    assert T.totals(df, dims, [sum_of("v")], "cube", "total").count() == 1 + 2 * (2**7 - 1)


@pytest.mark.parametrize("label", ["count", "total", "null"])
def test_grand_total_of_no_rows(spark, label):
    df = spark.createDataFrame([], "a string, b string, v long")
    metrics = [max_of("v"), sum_of("v"), count_rows("n")]
    rows_out = T.totals(df, ["a", "b"], metrics, "cube", label, grouping_id="g").collect()
    shown = {"count": "0", "total": "Total", "null": None}[label]
    assert [tuple(r) for r in rows_out] == [(shown, shown, None, None, 0, 3)]
    pre = T.totals(df, ["a", "b"], metrics, "cube", label, grouping_id="g", preaggregate=True).collect()
    assert [tuple(r) for r in pre] == [tuple(r) for r in rows_out]


@pytest.mark.parametrize("how", ["inner", "left", "right", "outer"])
def test_partials_equal_the_direct_plan_for_every_join_and_for_decimals(spark, how):
    fact = spark.createDataFrame(
        [("0", "1", "1.25"), ("0", "9", "2.50"), ("1", "1", None), ("1", None, "4.00")], "e string, k string, t string"
    ).selectExpr("e", "k", "CAST(t AS decimal(12,2)) AS v")
    dictionary = spark.createDataFrame([("1", 5), ("2", 6)], "k string, tier long")
    metrics = [sum_of("v"), count_of("v", "n"), count_rows("rows"), max_of("tier", "top")]
    direct = T.totals(enrich(fact, dictionary, "k", how), ["e", "k", "tier"], metrics, "cube", "total", grouping_id="g")
    over = T.totals_over_join(fact, dictionary, "k", ["e", "k", "tier"], metrics, "cube", "total", how=how, grouping_id="g")
    assert over.schema["sum_v"].dataType == direct.schema["sum_v"].dataType
    assert sorted(map(str, over.collect())) == sorted(map(str, direct.collect()))
    pre = T.totals(enrich(fact, dictionary, "k", how), ["e", "k", "tier"], metrics, "cube", "total", grouping_id="g", preaggregate=True)
    assert pre.schema["sum_v"].dataType == direct.schema["sum_v"].dataType
    assert sorted(map(str, pre.collect())) == sorted(map(str, direct.collect()))


def test_set_generator_order():
    assert T.grouping_sets(["a", "b", "c"], "pairs") == [("a",), ("a", "b"), ("a", "c"), ("b",), ("b", "c"), ("c",)]
    assert T.complements(["a", "b", "c"], "singles")[0] == (("a",), ("b", "c"))
    assert len(T.grouping_sets(["a", "b", "c"], "cube")) == 8
    assert T.grouping_sets(["a", "b", "c"], "rollup") == [("a", "b", "c"), ("a", "b"), ("a",), ()]
    # Sets chosen by size, as combinations of r dimensions.
    assert T.grouping_sets(["a", "b", "c"], [1, 2]) == T.grouping_sets(["a", "b", "c"], "pairs")
    assert T.grouping_sets(["a", "b", "c"], [3, 0]) == [(), ("a", "b", "c")]
    assert T.grouping_sets(["a", "b", "c"], ["a", ["b", "c"]]) == [("a",), ("b", "c")]
    with pytest.raises(ValueError):
        T.grouping_sets(["a", "b"], [["a", "z"]])


def test_aggregating_before_the_join_equals_joining_first(edge_fact, edge_dict):
    dictionary = edge_dict.drop("priority")
    metrics = invoice_metrics() + [count_rows()]
    for how in ("inner", "left"):
        for label in ("count", "total", "null"):
            direct = T.totals(joins.enrich(edge_fact, dictionary, "counter_party", how), DIMS, metrics, "cube", label, grouping_id="g")
            eager = T.totals_over_join(edge_fact, dictionary, "counter_party", DIMS, metrics, "cube", label, how=how, grouping_id="g")
            assert rows(direct) == rows(eager)
    direct = T.totals(joins.enrich(edge_fact, dictionary, "counter_party", null_safe=True), DIMS, metrics, "pairs", "count")
    eager = T.totals_over_join(edge_fact, dictionary, "counter_party", DIMS, metrics, "pairs", "count", null_safe=True)
    assert rows(direct) == rows(eager)


def test_metrics_reading_both_tables_join_first(edge_fact, edge_dict):
    dictionary = edge_dict.drop("priority")
    metrics = [sum_if("value", F.col("tier") > 1, "value_above_tier_1"), count_rows()]
    direct = T.totals(joins.enrich(edge_fact, dictionary, "counter_party"), DIMS, metrics, "cube", "total")
    eager = T.totals_over_join(edge_fact, dictionary, "counter_party", DIMS, metrics, "cube", "total")
    assert rows(direct) == rows(eager)
    level = T.group_over_join(edge_fact, dictionary, "counter_party", ["legal_entity"], metrics)
    assert rows(level) == rows(T.group_metrics(joins.enrich(edge_fact, dictionary, "counter_party"), ["legal_entity"], metrics))


def test_aggregating_before_the_join_rejects_unknown_columns(edge_fact, edge_dict):
    with pytest.raises(ValueError):
        T.totals_over_join(edge_fact, edge_dict, "counter_party", ["legal_entity", "nope"], invoice_metrics())


def test_single_level_over_join_with_dictionary_metrics(edge_fact, edge_dict):
    from tierwise.functions.metrics import count_of, min_of

    dictionary = edge_dict.drop("priority")
    metrics = [
        count_of("rating", "n_rating"),
        max_of("tier", "max_tier"),
        min_of("tier", "min_tier"),
        sum_of("tier", "sum_tier"),
        count_of("tier", "n_tier"),
        sum_if("value", F.col("status") == "ARAP", "arap"),
        count_rows(),
    ]
    for how in ("inner", "left"):
        direct = T.group_metrics(joins.enrich(edge_fact, dictionary, "counter_party", how), ["legal_entity"], metrics)
        eager = T.group_over_join(edge_fact, dictionary, "counter_party", ["legal_entity"], metrics, how=how)
        assert rows(direct) == rows(eager)
        cube = T.totals(joins.enrich(edge_fact, dictionary, "counter_party", how), DIMS, metrics, "cube", "count")
        cube_eager = T.totals_over_join(edge_fact, dictionary, "counter_party", DIMS, metrics, "cube", "count", how=how)
        assert rows(cube) == rows(cube_eager)


@pytest.mark.parametrize(
    "dims,keys,names,label",
    [
        (["legal_entity", "legal_entity"], [], ["a"], "count"),
        (["legal_entity"], ["legal_entity"], ["a"], "count"),
        (["legal_entity"], [], ["a", "a"], "count"),
        (["legal_entity"], [], ["legal_entity"], "count"),
        (["legal_entity"], [], ["a"], "sum"),
    ],
)
def test_totals_rejects_ambiguous_requests(edge_fact, dims, keys, names, label):
    metrics = [sum_of("value", n) for n in names]
    with pytest.raises(ValueError):
        T.totals(edge_fact, dims, metrics, "singles", label, keys=keys)


def test_first_by_rejects_ordering_by_the_key(edge_dict):
    with pytest.raises(ValueError):
        joins.first_by(edge_dict, "counter_party", "counter_party")


def test_missing_keys_are_distinct_and_follow_the_null_rule(edge_fact, edge_dict):
    plain = [r.counter_party for r in joins.missing_keys(edge_fact, edge_dict, "counter_party").collect()]
    assert len(plain) == 2 and set(plain) == {None, "C9"}  # under SQL rules a null key never finds its row
    safe = [r.counter_party for r in joins.missing_keys(edge_fact, edge_dict, "counter_party", null_safe=True).collect()]
    assert safe == ["C9"]  # the dictionary has a null-key row


def test_totals_maintained_from_appended_partials(spark):
    from tierwise.functions.metrics import count_of, min_of
    from tierwise.plans import invoices as inv

    sf = "/root/testdata/sf0.01"
    fact, tiers = inv.invoices(spark, sf), inv.tiers(spark, sf)
    metrics = invoice_metrics() + [count_rows(), max_of("tier", "max_tier"), min_of("tier", "min_tier"), count_of("tier", "n_tier")]
    # Two batches, as two days of data would arrive; they share grains.
    day1, day2 = fact.filter(F.col("rating") <= 3), fact.filter(F.col("rating") > 3)
    stored = T.partial_totals(day1, tiers, "counter_party", DIMS, metrics)
    appended = stored.unionByName(T.partial_totals(day2, tiers, "counter_party", DIMS, metrics))
    whole = T.totals_over_join(fact, tiers, "counter_party", DIMS, metrics, "cube", "count", grouping_id="g")
    assert rows(T.totals_from_partials(appended, DIMS, metrics, "cube", "count", grouping_id="g")) == rows(whole)
    compacted = T.compact_partials(appended, metrics)
    assert compacted.columns == appended.columns
    assert compacted.count() < appended.count()
    assert rows(T.totals_from_partials(compacted, DIMS, metrics, "cube", "count", grouping_id="g")) == rows(whole)


def test_partials_refuse_metrics_that_need_both_tables(edge_fact, edge_dict):
    with pytest.raises(ValueError):
        T.partial_totals(edge_fact, edge_dict, "counter_party", DIMS, [sum_if("value", F.col("tier") > 1, "x")])


def test_metrics_over_expressions_need_names(edge_fact):
    with pytest.raises(ValueError):
        max_of(F.col("value") * 2)
    doubled = T.group_metrics(edge_fact, ["legal_entity"], [sum_of(F.col("value") * 2, "double_value")])
    assert {r.legal_entity: r.double_value for r in doubled.collect()}["L1"] == 30
