"""The command line runs the exercise's jobs end to end on the sample files."""

from __future__ import annotations

import pytest
from conftest import rows

from tierwise import cli
from tierwise.session import scratch_path


def test_totals_cube_with_total_labels(spark, data_dir, capsys):
    out = cli.run(
        ["totals", "--facts", str(data_dir / "invoices.csv"), "--dictionary", str(data_dir / "tiers.csv"),
         "--sets", "cube", "--label", "total", "--rows", "50"],
        spark,
    )
    assert out.count() == 46
    assert "Total" in capsys.readouterr().out


def test_count_labelled_totals_to_csv(spark, data_dir):
    path = scratch_path(spark, "cli")
    out = cli.run(
        ["totals", "--facts", str(data_dir / "invoices.csv"), "--dictionary", str(data_dir / "tiers.json"),
         "--out", path],
        spark,
    )
    back = spark.read.option("header", True).schema(out.schema).csv(path)
    assert rows(back) == rows(out) and len(rows(out)) == 37


def test_by_status_and_summary(spark, data_dir):
    facts, dictionary = str(data_dir / "invoices.csv"), str(data_dir / "tiers.csv")
    assert cli.run(["by-status", "--facts", facts, "--dictionary", dictionary], spark).count() == 63
    summary = cli.run(["summary", "--facts", facts, "--dictionary", dictionary], spark)
    got = sorted(tuple(r) for r in summary.select("legal_entity", "counter_party", "count_rating", "max_tier", "sum_value").collect())
    assert got[:3] == [("L1", "C1", 3, 1, 40), ("L1", "C3", 1, 3, 5), ("L1", "C4", 2, 4, 140)] and len(got) == 8


def test_validate(spark, data_dir):
    out = cli.run(["validate", "--facts", str(data_dir / "invoices_dirty.csv")], spark)
    assert sorted(r.position for r in out.collect()) == [5, 20, 23, 24]


def test_totals_over_validated_rows_with_a_reject_table(spark, data_dir):
    rejects = scratch_path(spark, "cli-rejects")
    out = cli.run(
        ["totals", "--facts", str(data_dir / "invoices_dirty.csv"), "--dictionary", str(data_dir / "tiers.csv"),
         "--validate", "--rejects", rejects, "--sets", "cube", "--label", "total"],
        spark,
    )
    grand = out.filter("legal_entity = 'Total' AND counter_party = 'Total' AND tier = 'Total'").first()
    # 21 valid rows. Against the clean file: invoice 18 appears twice (+65 ARAP);
    # invoice 5 has no value (-50 ACCR), invoice 14 has status 3 (-52 ACCR), the
    # repeated invoice 6 names C2 (+60 ACCR), and counter party '2' has no tier.
    assert (grand.sum_value_ARAP, grand.sum_value_ACCR) == (1250 + 65, 512 - 50 - 52 + 60)
    back = spark.read.option("header", True).csv(rejects)
    assert sorted(int(r.position) for r in back.collect()) == [5, 20, 23, 24]


def test_help_runs_without_spark():
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-m", "tierwise", "--help"], cwd=repo, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0 and "totals" in out.stdout and "--validate" in out.stdout


def test_detail_lines(spark, data_dir):
    out = cli.run(["detail", "--facts", str(data_dir / "invoices.csv"), "--dictionary", str(data_dir / "tiers.csv")], spark)
    lines = sorted(r.line for r in out.collect())
    assert len(lines) == 8
    assert "L1           C1           1           3           40           0" in lines


def test_totals_from_stored_partials(spark, data_dir):
    a, b = scratch_path(spark, "cli-partials-a"), scratch_path(spark, "cli-partials-b")
    facts, dictionary = str(data_dir / "invoices.csv"), str(data_dir / "tiers.csv")
    cli.run(["partials", "--facts", facts, "--dictionary", dictionary, "--out", a], spark)
    cli.run(["partials", "--facts", facts, "--dictionary", dictionary, "--out", b], spark)
    twice = cli.run(["totals", "--partials", f"{a},{b}", "--sets", "cube", "--label", "total"], spark)
    grand = twice.filter("legal_entity = 'Total' AND counter_party = 'Total' AND tier = 'Total'").first()
    # The same batch stored twice counts twice.
    assert (grand.max_rating, grand.sum_value_ARAP, grand.sum_value_ACCR) == (6, 2 * 1250, 2 * 512)
    once = cli.run(["totals", "--partials", a, "--sets", "cube", "--label", "total"], spark)
    assert once.count() == 46


def test_stream_then_totals_from_the_stored_partials(spark, data_dir, tmp_path):
    import shutil

    incoming = tmp_path / "incoming"
    incoming.mkdir()
    shutil.copy(data_dir / "invoices.csv", incoming / "day1.csv")
    out = scratch_path(spark, "cli-stream")
    cli.run(["stream", "--incoming", str(incoming), "--dictionary", str(data_dir / "tiers.csv"), "--out", out, "--once"], spark)
    cube = cli.run(["totals", "--partials", out, "--sets", "cube", "--label", "total"], spark)
    assert cube.count() == 46


def test_module_runs_end_to_end_in_a_fresh_process(data_dir, tmp_path):
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = tmp_path / "cube"
    cmd = [sys.executable, "-m", "tierwise", "totals", "--facts", str(data_dir / "invoices.csv"),
           "--dictionary", str(data_dir / "tiers.json"), "--sets", "cube", "--label", "total", "--out", str(out)]
    done = subprocess.run(cmd, cwd=repo, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    lines = [line for p in sorted(out.glob("part-*.csv")) for line in p.read_text().splitlines()]
    assert sum(1 for line in lines if line != "legal_entity,counter_party,tier,max_rating,sum_value_ARAP,sum_value_ACCR") == 46
    assert "Total,Total,Total,6,1250,512" in lines


def test_sorted_preview(spark, data_dir, capsys):
    cli.run(["summary", "--facts", str(data_dir / "invoices.csv"), "--dictionary", str(data_dir / "tiers.csv"), "--sort"], spark)
    lines = [line for line in capsys.readouterr().out.splitlines() if line.startswith("|L")]
    assert lines == sorted(lines) and len(lines) == 8


@pytest.mark.parametrize(
    "argv",
    [
        ["totals"],  # no facts and no partials
        ["totals", "--facts", "x.csv"],  # no dictionary
        ["partials", "--facts", "x.csv", "--dictionary", "d.csv"],  # no output folder
        ["stream", "--incoming", "in/"],  # no dictionary, no output folder
        ["totals", "--facts", "x.csv", "--dictionary", "d.csv", "--label", "sum"],  # unknown label
    ],
)
def test_usage_errors_exit_cleanly(spark, argv):
    with pytest.raises(SystemExit) as e:
        cli.run(argv, spark)
    assert e.value.code == 2


def test_parquet_output(spark, data_dir):
    out = scratch_path(spark, "cli-parquet")
    cube = cli.run(
        ["totals", "--facts", str(data_dir / "invoices.csv"), "--dictionary", str(data_dir / "tiers.csv"),
         "--sets", "cube", "--label", "total", "--out", out, "--format", "parquet"],
        spark,
    )
    assert rows(spark.read.parquet(out)) == rows(cube)


def test_validate_with_allowed_values(spark, data_dir):
    out = cli.run(["validate", "--facts", str(data_dir / "invoices_dirty.csv"), "--allow", "status=ARAP,ACCR"], spark)
    assert sorted(r.position for r in out.collect()) == [5, 14, 20, 23, 24]
    with pytest.raises(SystemExit):
        cli.run(["validate", "--facts", "x.csv", "--allow", "colour=red"], spark)


def test_validate_writes_the_reject_table(spark, data_dir):
    rejects = scratch_path(spark, "cli-validate-rejects")
    cli.run(["validate", "--facts", str(data_dir / "invoices_dirty.csv"), "--rejects", rejects], spark)
    table = spark.read.option("header", True).csv(rejects)
    assert table.columns == ["position", "invoice_id", "column", "raw_value", "reason"]
    assert sorted((int(r.position), r.column, r.reason) for r in table.collect())[1] == (20, "value", "not an integer")
