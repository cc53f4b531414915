"""Recorded outputs of the exercise, compared as multisets."""

from __future__ import annotations

from conftest import parse, rows

from tierwise.functions.metrics import count_of, count_rows, invoice_metrics, max_of, sum_if, sum_of
from tierwise.operators import totals as T
from pyspark.sql import functions as F

COLS = ["legal_entity", "counter_party", "tier", "max_rating", "sum_value_ARAP", "sum_value_ACCR"]
DIMS = ["legal_entity", "counter_party", "tier"]
TYPES = (str, str, str, int, int, int)

# The count-labelled totals, by grouping set.
BY_SET = {
    ("legal_entity",): "L1 6 6 6 85 100; L2 6 6 6 1020 207; L3 6 6 6 145 205",
    ("counter_party",): "3 C1 3 3 40 0; 2 C2 2 3 20 40; 5 C3 5 6 5 197; 2 C4 2 6 40 100; 3 C5 3 6 1000 115; 3 C6 3 6 145 60",
    ("tier",): "3 3 1 3 40 0; 2 2 2 3 20 40; 5 5 3 6 5 197; 2 2 4 6 40 100; 3 3 5 6 1000 115; 3 3 6 6 145 60",
    ("legal_entity", "counter_party"): "L1 C1 3 3 40 0; L1 C3 1 6 5 0; L1 C4 2 6 40 100; L2 C2 2 3 20 40; "
    "L2 C3 1 2 0 52; L2 C5 3 6 1000 115; L3 C3 3 4 0 145; L3 C6 3 6 145 60",
    ("legal_entity", "tier"): "L1 3 1 3 40 0; L1 1 3 6 5 0; L1 2 4 6 40 100; L2 2 2 3 20 40; "
    "L2 1 3 2 0 52; L2 3 5 6 1000 115; L3 3 3 4 0 145; L3 3 6 6 145 60",
    ("counter_party", "tier"): "3 C1 1 3 40 0; 2 C2 2 3 20 40; 5 C3 3 6 5 197; 2 C4 4 6 40 100; 3 C5 5 6 1000 115; 3 C6 6 6 145 60",
}

# The detail level (legal entity, counter party, tier).
DETAIL = (
    "L1 C1 1 3 40 0; L1 C3 3 6 5 0; L1 C4 4 6 40 100; L2 C2 2 3 20 40; "
    "L2 C3 3 2 0 52; L2 C5 5 6 1000 115; L3 C3 3 4 0 145; L3 C6 6 6 145 60"
)
GRAND = ("Total", "Total", "Total", 6, 1250, 512)

# Totals per status; '-' marks a rolled-up column.
# Columns: legal_entity counter_party tier status n_rows max_rating sum_value.
BY_STATUS = """
L1 C1 - ARAP 3 3 40; L1 - - ARAP 5 6 85; - C1 - ARAP 3 3 40; - - 1 ARAP 3 3 40; L1 - 1 ARAP 3 3 40; - C1 1 ARAP 3 3 40;
L2 C2 - ARAP 1 2 20; L2 - - ARAP 2 6 1020; - C2 - ARAP 1 2 20; - - 2 ARAP 1 2 20; L2 - 2 ARAP 1 2 20; - C2 2 ARAP 1 2 20;
L1 C4 - ARAP 1 6 40; - C4 - ARAP 1 6 40; - - 4 ARAP 1 6 40; L1 - 4 ARAP 1 6 40; - C4 4 ARAP 1 6 40;
L2 C5 - ARAP 1 6 1000; - C5 - ARAP 1 6 1000; - - 5 ARAP 1 6 1000; L2 - 5 ARAP 1 6 1000; - C5 5 ARAP 1 6 1000;
L3 C6 - ARAP 2 5 145; L3 - - ARAP 2 5 145; - C6 - ARAP 2 5 145; - - 6 ARAP 2 5 145; L3 - 6 ARAP 2 5 145; - C6 6 ARAP 2 5 145;
L1 C3 - ARAP 1 6 5; - C3 - ARAP 1 6 5; - - 3 ARAP 1 6 5; L1 - 3 ARAP 1 6 5; - C3 3 ARAP 1 6 5;
L3 C3 - ACCR 3 4 145; L3 - - ACCR 4 6 205; - C3 - ACCR 4 4 197; - - 3 ACCR 4 4 197; L3 - 3 ACCR 3 4 145; - C3 3 ACCR 4 4 197;
L2 C5 - ACCR 2 4 115; L2 - - ACCR 4 4 207; - C5 - ACCR 2 4 115; - - 5 ACCR 2 4 115; L2 - 5 ACCR 2 4 115; - C5 5 ACCR 2 4 115;
L3 C6 - ACCR 1 6 60; - C6 - ACCR 1 6 60; - - 6 ACCR 1 6 60; L3 - 6 ACCR 1 6 60; - C6 6 ACCR 1 6 60;
L2 C2 - ACCR 1 3 40; - C2 - ACCR 1 3 40; - - 2 ACCR 1 3 40; L2 - 2 ACCR 1 3 40; - C2 2 ACCR 1 3 40;
L1 C4 - ACCR 1 5 100; L1 - - ACCR 1 5 100; - C4 - ACCR 1 5 100; - - 4 ACCR 1 5 100; L1 - 4 ACCR 1 5 100; - C4 4 ACCR 1 5 100;
L2 C3 - ACCR 1 2 52; L2 - 3 ACCR 1 2 52
"""

# count_rating, max_tier, sum_value per (legal entity, counter party).
ENTITY = "L1 C1 3 1 40; L1 C3 1 3 5; L1 C4 2 4 140; L2 C2 2 2 60; L2 C3 1 3 52; L2 C5 3 5 1115; L3 C3 3 3 145; L3 C6 3 6 205"


def count_labelled():
    out = []
    for text in BY_SET.values():
        out.extend(parse(text, TYPES))
    return sorted(out, key=repr)


def total_labelled():
    out = []
    for kept, text in BY_SET.items():
        for row in parse(text, TYPES):
            dims = tuple(v if c in kept else "Total" for c, v in zip(DIMS, row[:3]))
            out.append(dims + row[3:])
    out.extend(parse(DETAIL, TYPES))
    out.append(GRAND)
    return sorted(out, key=repr)


def test_count_labelled_six_sets(enriched):
    got = rows(T.totals(enriched, DIMS, invoice_metrics(), "pairs", "count"), COLS)
    assert len(got) == 37
    assert got == count_labelled()


def test_union_form_equals_grouping_sets(enriched):
    got = rows(T.totals_union(enriched, DIMS, invoice_metrics(), "pairs", "count"), COLS)
    assert got == count_labelled()


def test_total_labelled_cube(enriched):
    got = rows(T.totals(enriched, DIMS, invoice_metrics(), "cube", "total"), COLS)
    assert len(got) == 46
    assert got == total_labelled()


def test_preaggregated_cube_equals_direct(enriched):
    got = rows(T.totals(enriched, DIMS, invoice_metrics(), "cube", "total", preaggregate=True), COLS)
    assert got == total_labelled()
    got = rows(T.totals(enriched, DIMS, invoice_metrics(), "pairs", "count", preaggregate=True), COLS)
    assert got == count_labelled()


def test_rollup_is_part_of_cube(enriched):
    cube = set(rows(T.totals(enriched, DIMS, invoice_metrics(), "cube", "total"), COLS))
    rollup = rows(T.totals(enriched, DIMS, invoice_metrics(), "rollup", "total"), COLS)
    assert set(rollup) <= cube
    # Hierarchical sample rows of the brief: L1/Total/Total and L1/C1/Total.
    assert ("L1", "Total", "Total", 6, 85, 100) in rollup
    assert ("L1", "C1", "Total", 3, 40, 0) in rollup
    assert len(rollup) == 3 + 8 + 8 + 1


def test_detail_level(enriched):
    got = rows(T.group_metrics(enriched, DIMS, invoice_metrics()), COLS)
    assert got == sorted(((a, b, int(c), d, e, f) for a, b, c, d, e, f in parse(DETAIL, TYPES)), key=repr)


def test_totals_by_status(enriched):
    filtered = enriched.filter(F.col("status").isin("ARAP", "ACCR"))
    metrics = [count_rows("n_rows"), max_of("rating", "max_rating"), sum_of("value", "sum_value")]
    out = T.totals(filtered, DIMS, metrics, "pairs", "null", keys=["status"])
    got = rows(out, DIMS + ["status", "n_rows", "max_rating", "sum_value"])
    expected = [
        tuple(None if v == "-" else v for v in r[:4]) + r[4:]
        for r in parse(BY_STATUS.replace("\n", " "), (str, str, str, str, int, int, int))
    ]
    assert len(got) == 63
    assert sum(1 for r in got if r[3] == "ARAP") == 33
    assert got == sorted(expected, key=repr)


def test_entity_summary(enriched):
    from tierwise.plans.pipeline import entity_summary

    got = rows(entity_summary(enriched), ["legal_entity", "counter_party", "count_rating", "max_tier", "sum_value"])
    assert got == parse(ENTITY, (str, str, int, int, int))


def test_detail_lines_with_eleven_spaces(enriched):
    from tierwise.sinks import format_lines

    per = T.group_metrics(
        enriched,
        ["legal_entity", "counter_party"],
        [
            max_of("tier", "tier"),
            max_of("rating", "max_rating"),
            sum_if("value", F.col("status") == "ARAP", "sum_of_ARAP"),
            sum_if("value", F.col("status") == "ACCR", "sum_of_ACCR"),
        ],
    )
    lines = sorted(r.line for r in format_lines(per, ["legal_entity", "counter_party", "tier", "max_rating", "sum_of_ARAP", "sum_of_ACCR"]).collect())
    expected = sorted((" " * 11).join(r.split()) for r in DETAIL.split(";"))
    assert lines == expected
    assert "L1           C1           1           3           40           0" in lines


def test_grand_total(enriched):
    r = T.grand_total(enriched, invoice_metrics() + [count_of("rating", "n")]).first()
    assert (r.max_rating, r.sum_value_ARAP, r.sum_value_ACCR, r.n) == (6, 1250, 512, 18)


def test_joined_rows_carry_their_tier(enriched):
    got = rows(enriched, ["invoice_id", "counter_party", "tier"])
    assert len(got) == 18
    assert all(tier == int(cp[1:]) for _, cp, tier in got)


def test_inferred_schema_broadcast_join_and_union_reproduce_the_count_labelled_output(spark, data_dir):
    from tierwise.operators.joins import enrich
    from tierwise.sources.files import read_csv

    facts = read_csv(spark, str(data_dir / "invoices.csv"), infer=True)
    tiers = read_csv(spark, str(data_dir / "tiers.csv"), infer=True)
    joined = enrich(facts, tiers, "counter_party", broadcast=True)
    got = rows(T.totals_union(joined, DIMS, invoice_metrics(), "pairs", "count"), COLS)
    assert got == count_labelled()
