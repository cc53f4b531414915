"""Validation into a reject table: the integer rule, typed fields, positions."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tierwise.operators import quality
from tierwise.schemas import INVOICE
from tierwise.sources import files


def test_validation_positions_and_reasons(spark, data_dir):
    raw = files.read_csv_tolerant(spark, str(data_dir / "invoices_dirty.csv"), INVOICE)
    good = raw.filter(F.col(files.EXTRA).isNull()).drop(files.EXTRA)
    checked = quality.validate(quality.with_position(good), INVOICE)
    bad = sorted(rows(quality.invalid_rows(checked, ["position", "invoice_id"]), ["position", "invoice_id", "first_reason"]))
    assert bad == [
        (5, "5", "missing value"),
        (20, "20", "not an integer"),
        (23, "20", "not an integer"),
        (24, "5", "missing value"),
    ]
    # Structural only: a status of 3 and a counter party of 2 pass.
    assert quality.valid_rows(checked, INVOICE).count() == 21
    rej = sorted(rows(quality.rejects(checked, ["position"]), ["position", "column", "raw_value", "reason"]))
    assert rej[1] == (20, "value", "10e", "not an integer")


@pytest.mark.parametrize("files_n,split_bytes", [(1, 1024), (7, 2048), (7, 1 << 20), (3, 4096)])
def test_positions_are_exact_over_splits_and_files(spark, tmp_path, files_n, split_bytes):
    path = str(tmp_path / f"rows-{files_n}-{split_bytes}")
    spark.range(0, 5000, 1, files_n).select(F.col("id").cast("string").alias("v")).write.csv(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    try:
        df = spark.read.schema("v string").csv(path)
        # Drop some rows first: positions count the rows that are left.
        kept = df.filter(F.col("v").cast("long") % 7 != 3)
        out = quality.with_position(kept)
        expected = spark.range(0, 5000).filter(F.col("id") % 7 != 3).count()
        got = out.agg(F.min("position"), F.max("position"), F.countDistinct("position"), F.count("*")).first()
        assert tuple(got) == (1, expected, expected, expected)
        # Parts are written in id order, so positions follow the ids.
        ordered = out.select(F.col("v").cast("long").alias("id"), "position")
        w = ordered.withColumn("prev", F.lag("id").over(Window.orderBy("position")))
        assert w.filter(F.col("prev") >= F.col("id")).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_positions_do_not_shuffle_the_rows(spark, tmp_path):
    path = str(tmp_path / "positions")
    spark.range(0, 2000, 1, 4).select(F.col("id").cast("string").alias("v"), F.repeat(F.lit("wide"), 9).alias("payload")).write.csv(path)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = quality.with_position(spark.read.schema("v string, payload string").csv(path))
        plan = out._jdf.queryExecution().executedPlan().toString()
        # Offsets are broadcast behind the size check; no exchange carries the rows' payload.
        assert "BroadcastHashJoin" in plan and plan.count("payload") >= 1
        assert not any("payload" in part.splitlines()[1] for part in plan.split("Exchange hashpartitioning")[1:] if len(part.splitlines()) > 1)
        assert out.count() == 2000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("text", ["\t5", "5\n", " \r\n+5\x0b"])
def test_all_white_space_around_an_integer_is_trimmed(spark, text):
    df = spark.createDataFrame([(text,)], "t string").select(quality.integer_reason(F.col("t")).alias("r"))
    assert df.first().r is None


def test_missing_required_column_rejects_every_row(spark, invoices):
    text = invoices.select([F.col(c).cast("string") for c in invoices.columns if c != "rating"])
    checked = quality.validate(text, INVOICE)
    reasons = {r.first_reason for r in checked.select("first_reason").collect()}
    assert reasons == {quality.REASON_MISSING_COLUMN}
    assert checked.filter(F.size("errors") == 0).count() == 0
    assert checked.filter("valid").count() == 0


@pytest.mark.parametrize(
    "text,reason",
    [(" 12 ", None), ("+3", None), ("-7", None), ("10.5", "not an integer"), ("1_0", "not an integer"),
     ("10e", "not an integer"), (None, "missing value"), ("9223372036854775808", "integer out of range"),
     ("", "not an integer"), ("+", "not an integer"), ("+-1", "not an integer"), ("1.0", "not an integer"),
     ("1 2", "not an integer"), ("\uff11\uff12", "not an integer"), ("00012", None), ("-0", None),
     ("-9223372036854775809", "integer out of range"), ("9223372036854775807", None)],
)
def test_integer_rule(spark, text, reason):
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(quality.integer_reason(F.col("v")).alias("r")).first().r == reason


def test_positions_need_a_file_source(spark):
    with pytest.raises(ValueError, match="read from files"):
        quality.with_position(spark.range(3))


def test_integer_range_follows_the_field_type(spark):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("small", T.IntegerType()), T.StructField("big", T.LongType())])
    df = spark.createDataFrame([("3000000000", "3000000000"), ("7", "7")], "small string, big string")
    checked = quality.validate(df, schema)
    got = sorted((r.small, r.first_reason) for r in checked.collect())
    assert got == [("3000000000", "integer out of range"), ("7", None)]
    assert [tuple(r) for r in quality.valid_rows(checked, schema).collect()] == [(7, 7)]


def test_other_typed_fields_must_cast_cleanly(spark):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("amount", T.DoubleType()), T.StructField("day", T.DateType())])
    df = spark.createDataFrame([("1.5", "2024-01-31"), ("abc", "2024-02-30"), (None, "2024-03-01")], "amount string, day string")
    checked = quality.validate(df, schema)
    got = sorted(((r.amount, r.first_reason, r.valid) for r in checked.collect()), key=repr)
    assert got == sorted([("1.5", None, True), ("abc", "not a double", False), (None, "missing value", False)], key=repr)
    bad_day = [e.reason for r in checked.collect() for e in r.errors if e.column == "day"]
    assert bad_day == ["not a date"]
    assert quality.valid_rows(checked, schema).count() == 1


def test_validated_totals_do_not_compute_positions(spark, data_dir, tiers):
    from tierwise.functions.metrics import invoice_metrics
    from tierwise.plans.pipeline import validated_totals

    out = validated_totals(
        spark, str(data_dir / "invoices_dirty.csv"), INVOICE, tiers, "counter_party",
        ["legal_entity", "counter_party", "tier"], invoice_metrics(), "cube", "total",
    )
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()
    grand = out.filter("legal_entity = 'Total' AND counter_party = 'Total' AND tier = 'Total'").first()
    assert (grand.sum_value_ARAP, grand.sum_value_ACCR) == (1250 + 65, 512 - 50 - 52 + 60)


def test_domain_rules_are_optional_extra_checks(spark, data_dir):
    raw = files.read_csv_tolerant(spark, str(data_dir / "invoices_dirty.csv"), INVOICE)
    good = raw.filter(F.col(files.EXTRA).isNull()).drop(files.EXTRA)
    rules = {"status": F.col("status").isin("ARAP", "ACCR"), "counter_party": F.col("counter_party").rlike("^C[0-9]+$")}
    checked = quality.validate(quality.with_position(good), INVOICE, rules)
    bad = sorted(rows(quality.invalid_rows(checked, ["position", "invoice_id"]), ["position", "first_reason"]))
    # Structural faults as before, plus invoice 14's status 3 and invoice 19's counter party 2 (twice).
    assert bad == [
        (5, "missing value"), (14, quality.REASON_NOT_ALLOWED), (19, quality.REASON_NOT_ALLOWED),
        (20, "not an integer"), (22, quality.REASON_NOT_ALLOWED), (23, "not an integer"), (24, "missing value"),
    ]
    with pytest.raises(ValueError):
        quality.validate(good, INVOICE, {"nope": F.lit(True)})
