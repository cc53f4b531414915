"""Sources, sinks, the pipeline, reuse, and the session helpers."""

from __future__ import annotations

import pytest
from conftest import parse, rows
from pyspark.sql import functions as F

from tierwise import sinks
from tierwise.plans.pipeline import Pipeline, entity_summary
from tierwise.schemas import INVOICE, TIER
from tierwise.session import scratch_path
from tierwise.sources import files, tables


def test_csv_with_bare_carriage_returns(spark, data_dir, invoices, tiers):
    assert invoices.count() == 18
    assert tiers.count() == 6
    assert invoices.schema == INVOICE
    assert invoices.filter(F.col("invoice_id") == 11).first().value == 1000


def test_csv_inferred_types(spark, data_dir):
    df = files.read_csv(spark, str(data_dir / "invoices.csv"), infer=True)
    assert dict(df.dtypes)["value"] == "int"
    assert df.count() == 18


def test_json_array_of_records(spark, data_dir):
    df = files.read_json_records(spark, str(data_dir / "tiers.json"), TIER)
    assert rows(df, ["counter_party", "tier"]) == [(f"C{i}", i) for i in range(1, 7)]


def test_tolerant_read_separates_wrong_width_rows(spark, data_dir):
    raw = files.read_csv_tolerant(spark, str(data_dir / "invoices_dirty.csv"), INVOICE)
    good, bad = files.split_corrupt(raw)
    assert good.count() == 25
    assert sorted(r.raw_line for r in bad.collect()) == ["21,L2,C2,3,ACCR,40,1"] * 2


def test_tolerant_read_counts_fields_and_keeps_whole_lines(spark, tmp_path):
    path = tmp_path / "wide.csv"
    good_lines = ["1,L1,C1,1,ARAP,10", '2,"L2, ""x"", Inc",C2,2,ARAP,20', "3,L3", ",,,,,"]
    bad_lines = ["4,L1,C1,1,ARAP,10,", "5,L1,C1,1,ARAP,10,,junk", "6,L1,C1,1,ARAP,10,x,y,z", '7,"L,1",C1,1,ARAP,10,1']
    path.write_text("\n".join(good_lines[:2] + bad_lines + [""] + good_lines[2:]))
    good, bad = files.split_corrupt(files.read_csv_tolerant(spark, str(path), INVOICE, header=False, escape='"'))
    assert sorted(r.raw_line for r in bad.collect()) == sorted(bad_lines)
    assert sorted((r.invoice_id or "", r.legal_entity, r.value) for r in good.collect()) == [
        ("", None, None), ("1", "L1", "10"), ("2", 'L2, "x", Inc', "20"), ("3", "L3", None),
    ]
    assert good.count() == 4 and bad.count() == 4  # also when nothing but the count is read


def test_csv_sink_roundtrip(spark, enriched):
    from tierwise.functions.metrics import invoice_metrics
    from tierwise.operators.totals import totals
    from tierwise.plans.catalog import TOTALS_SCHEMA

    out = totals(enriched, ["legal_entity", "counter_party", "tier"], invoice_metrics())
    path = scratch_path(spark, "sink-test")
    sinks.write_csv(out, path)
    back = files.read_csv(spark, path, TOTALS_SCHEMA)
    assert rows(back) == rows(out)
    with pytest.raises(Exception):
        sinks.write_csv(out, path)  # default mode fails on an existing target


def test_table_sink_and_source(spark, invoices):
    name = "tierwise_test_invoices"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    sinks.write_table(invoices, name, format=None)
    try:
        back = tables.read_table(spark, name)
        assert rows(back) == rows(invoices)
        with pytest.raises(Exception):
            sinks.write_table(invoices, name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_views(spark, invoices, tiers):
    tables.register_views(df_main=invoices, df_dict=tiers)
    n = spark.sql("SELECT count(*) AS n FROM df_main JOIN df_dict USING (counter_party)").first().n
    assert n == 18


def test_pipeline_csv_and_json_sources_to_csv_sink(spark, data_dir):
    path = scratch_path(spark, "pipeline-test")
    Pipeline(
        sources=[
            lambda: files.read_csv(spark, str(data_dir / "invoices.csv"), INVOICE),
            lambda: files.read_json_records(spark, str(data_dir / "tiers.json"), TIER),
        ],
        transformations=[entity_summary],
        sink=lambda df: sinks.write_csv(df, path),
    ).run(merge_on="counter_party")
    schema = "legal_entity string, counter_party string, count_rating long, max_tier long, sum_value long"
    back = spark.read.option("header", True).schema(schema).csv(path)
    assert rows(back) == parse(
        "L1 C1 3 1 40; L1 C3 1 3 5; L1 C4 2 4 140; L2 C2 2 2 60; L2 C3 1 3 52; L2 C5 3 5 1115; L3 C3 3 3 145; L3 C6 3 6 205",
        (str, str, int, int, int),
    )


def test_pipeline_folds_three_sources(spark, invoices, tiers):
    ratings = spark.createDataFrame([(f"C{i}", f"grade{i % 2}") for i in range(1, 7)], "counter_party string, grade string")
    out = Pipeline(sources=[invoices, tiers, ratings]).run(merge_on="counter_party")
    assert out.count() == 18 and "grade" in out.columns and "tier" in out.columns


def test_materialize_checkpoints_to_the_shared_folder(spark, enriched):
    from tierwise.operators.reuse import materialize

    reused = materialize(enriched, "checkpoint")
    assert "LogicalRDD" in reused._jdf.queryExecution().optimizedPlan().toString()
    assert rows(reused) == rows(enriched)
    cached = materialize(enriched, "cache")
    assert cached.count() == 18
    cached.unpersist()


def test_public_api_imports():
    import tierwise

    for name in ("totals", "totals_over_join", "enrich", "validate", "read_csv", "write_csv", "Pipeline"):
        assert hasattr(tierwise, name)


def test_show_prints_a_bounded_preview(enriched, capsys):
    sinks.show(enriched, 3)
    out = capsys.readouterr().out
    assert "only showing top 3 rows" in out


def test_missing_connector_surfaces_sparks_error(spark):
    with pytest.raises(Exception, match="DATA_SOURCE_NOT_FOUND|Failed to find the data source"):
        tables.read_table(spark, "project.dataset.table", format="org.example.absent").schema


def test_json_lines(spark, tiers, tmp_path):
    path = str(tmp_path / "tiers-jsonl")
    tiers.write.json(path)
    back = files.read_json_lines(spark, path, TIER)
    assert rows(back) == rows(tiers)


def test_typed_read_fails_on_a_field_that_does_not_parse(spark, data_dir):
    df = files.read_csv(spark, str(data_dir / "invoices_dirty.csv"), INVOICE)
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        df.collect()
    permissive = files.read_csv(spark, str(data_dir / "invoices_dirty.csv"), INVOICE, mode="PERMISSIVE")
    assert permissive.count() == 27


def test_formatted_lines_written_as_text(spark, enriched, tmp_path):
    path = str(tmp_path / "lines")
    lines = sinks.format_lines(enriched.select("legal_entity", "counter_party", "value"))
    sinks.write_lines(lines, path)
    back = sorted(r.value for r in spark.read.text(path).collect())
    assert back == sorted(r.line for r in lines.collect())
    assert back[0].count(" " * 11) == 2


def test_format_based_table_sink_and_source(spark, invoices, tmp_path):
    path = str(tmp_path / "invoices-parquet")
    sinks.write_table(invoices, path, format="parquet")
    back = tables.read_table(spark, format="parquet", path=path)
    assert rows(back) == rows(invoices)
    with pytest.raises(Exception):
        sinks.write_table(invoices, path, format="parquet")  # default mode: target exists
    sinks.write_table(invoices, path, format="parquet", mode="overwrite")
    assert tables.read_table(spark, format="parquet", path=path).count() == 18


def test_checkpoint_folder_without_a_spark_context():
    from tierwise.session import checkpoint_dir

    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default=None):
            return self.value if key == "spark.checkpoint.dir" else default

    class RemoteSession:  # the shape of a Spark Connect session
        def __init__(self, value):
            self.conf = Conf(value)

        @property
        def sparkContext(self):
            raise RuntimeError("not available")

    assert checkpoint_dir(RemoteSession("s3a://shared/ckpt")) == "s3a://shared/ckpt"
    with pytest.raises(RuntimeError):
        checkpoint_dir(RemoteSession(None))


def test_bucketing_needs_a_catalog_table(invoices, tmp_path):
    with pytest.raises(ValueError, match="catalog table"):
        sinks.write_table(invoices, str(tmp_path / "b"), format="parquet", bucket_by="counter_party", buckets=4)


def test_pipeline_left_merge_and_chained_steps(spark, invoices):
    partial_tiers = spark.createDataFrame([("C1", 1), ("C2", 2)], "counter_party string, tier long")
    steps = [
        lambda df: df.filter(F.col("status") == "ARAP"),
        lambda df: df.groupBy("counter_party").agg(F.count(F.lit(1)).alias("n"), F.max("tier").alias("tier")),
    ]
    out = Pipeline([invoices, partial_tiers], steps).plan("counter_party", how="left")
    got = {r.counter_party: (r.n, r.tier) for r in out.collect()}
    assert got["C1"] == (3, 1) and got["C5"] == (1, None)  # C5 has no tier but is kept
