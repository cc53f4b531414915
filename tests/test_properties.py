"""Properties of totals on random data, checked against a brute-force answer."""

from __future__ import annotations

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tierwise.functions.metrics import count_rows, invoice_metrics
from tierwise.operators import totals as T

DIMS = ["legal_entity", "counter_party", "tier"]
SCHEMA = "legal_entity string, counter_party string, tier long, rating long, status string, value long"

row = st.tuples(
    st.sampled_from(["L1", "L2", "Total", None]),
    st.sampled_from(["C1", "C2", "C3", None]),
    st.sampled_from([1, 2, None]),
    st.integers(-5, 9) | st.none(),
    st.sampled_from(["ARAP", "ACCR", "N"]),
    st.integers(-100, 1000) | st.none(),
)


def brute(records, sets, label):
    """Each grouping set evaluated on its own, in plain Python."""
    out = []
    for kept in sets:
        groups = {}
        for r in records:
            rec = dict(zip(["legal_entity", "counter_party", "tier", "rating", "status", "value"], r))
            groups.setdefault(tuple(rec[c] for c in kept), []).append(rec)
        for key, members in groups.items():
            shown = []
            for c in DIMS:
                if c in kept:
                    v = key[kept.index(c)]
                    shown.append(None if v is None else str(v))
                elif label == "count":
                    shown.append(str(sum(m[c] is not None for m in members)))
                else:
                    shown.append("Total")
            ratings = [m["rating"] for m in members if m["rating"] is not None]
            sums = [
                sum(m["value"] for m in members if m["status"] == s and m["value"] is not None) for s in ("ARAP", "ACCR")
            ]
            out.append(tuple(shown) + (max(ratings) if ratings else None, *sums, len(members)))
    return sorted(out, key=repr)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(records=st.lists(row, min_size=1, max_size=25), shape=st.sampled_from(["pairs", "cube", "rollup", "singles"]),
       label=st.sampled_from(["count", "total"]), pre=st.booleans())
def test_totals_equal_brute_force(spark, records, shape, label, pre):
    df = spark.createDataFrame(records, SCHEMA)
    metrics = invoice_metrics() + [count_rows()]
    got = T.totals(df, DIMS, metrics, shape, label, preaggregate=pre)
    got_rows = sorted((tuple(r) for r in got.collect()), key=repr)
    assert got_rows == brute(records, [list(s) for s in T.grouping_sets(DIMS, shape)], label)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(records=st.lists(row, min_size=1, max_size=25))
def test_each_level_adds_up_to_the_grand_total(spark, records):
    df = spark.createDataFrame(records, SCHEMA)
    out = T.totals(df, DIMS, invoice_metrics() + [count_rows()], "cube", "null", grouping_id="g").toPandas()
    grand = out[out.g == 7].iloc[0]
    for g, level in out.groupby("g"):
        assert level.sum_value_ARAP.sum() == grand.sum_value_ARAP
        assert level.n_rows.sum() == grand.n_rows
        if pd.notna(grand.max_rating):
            assert level.max_rating.max() == grand.max_rating
    assert set(out.g) == set(range(8))


dict_row = st.tuples(st.sampled_from(["C1", "C2", "C3", None]), st.sampled_from([1, 2, 3, None]))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    records=st.lists(row, min_size=1, max_size=20),
    dictionary=st.lists(dict_row, min_size=0, max_size=6),
    how=st.sampled_from(["inner", "left"]),
    shape=st.sampled_from(["pairs", "cube"]),
    label=st.sampled_from(["count", "total", "null"]),
)
def test_aggregating_before_the_join_equals_joining_first(spark, records, dictionary, how, shape, label):
    from tierwise.functions.metrics import count_of, max_of
    from tierwise.operators.joins import enrich

    fact = spark.createDataFrame(records, SCHEMA).drop("tier")
    tiers = spark.createDataFrame(dictionary, "counter_party string, tier long")
    metrics = invoice_metrics() + [count_rows(), max_of("tier", "max_tier"), count_of("tier", "n_tier")]
    direct = T.totals(enrich(fact, tiers, "counter_party", how), DIMS, metrics, shape, label, grouping_id="g")
    eager = T.totals_over_join(fact, tiers, "counter_party", DIMS, metrics, shape, label, how=how, grouping_id="g")
    key = lambda r: repr(tuple(r))
    assert sorted(direct.collect(), key=key) == sorted(eager.collect(), key=key)


def python_integer_reason(text):
    """The integer rule written out in plain Python, as the specification."""
    import re

    if text is None:
        return "missing value"
    t = text.strip(" ")
    if not re.fullmatch(r"[+-]?[0-9]+", t):
        return "not an integer"
    if not -(2**63) <= int(t) < 2**63:
        return "integer out of range"
    return None


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.none() | st.text(alphabet="0123456789+-. _e", max_size=24), min_size=1, max_size=60))
def test_integer_rule_matches_its_specification(spark, texts):
    from pyspark.sql import functions as F

    from tierwise.operators.quality import integer_reason

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    got = {r.i: r.r for r in df.select("i", integer_reason(F.col("v")).alias("r")).collect()}
    assert got == {i: python_integer_reason(t) for i, t in enumerate(texts)}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    records=st.lists(row, min_size=1, max_size=20),
    shape=st.sampled_from(["pairs", "singles", "cube", "rollup"]),
    label=st.sampled_from(["count", "total", "null"]),
    keyed=st.booleans(),
)
def test_union_form_equals_one_pass(spark, records, shape, label, keyed):
    df = spark.createDataFrame(records, SCHEMA)
    metrics = invoice_metrics() + [count_rows()]
    keys = ["status"] if keyed else []
    one_pass = T.totals(df, DIMS, metrics, shape, label, keys=keys)
    union = T.totals_union(df, DIMS, metrics, shape, label, keys=keys)
    key = lambda r: repr(tuple(r))
    assert sorted(one_pass.collect(), key=key) == sorted(union.select(*one_pass.columns).collect(), key=key)
