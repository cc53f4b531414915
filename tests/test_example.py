"""The daily-job example over two days of files."""

from __future__ import annotations

import importlib.util
import os

from tierwise.session import scratch_path

HERE = os.path.dirname(os.path.abspath(__file__))


def load_example():
    spec = importlib.util.spec_from_file_location("daily_totals", os.path.join(HERE, "..", "examples", "daily_totals.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def test_two_days_roll_up_into_one_cube(spark, data_dir):
    job = load_example()
    store, out, rejects = (scratch_path(spark, n) for n in ("ex-partials", "ex-out", "ex-rejects"))
    tiers = str(data_dir / "tiers.csv")
    job.run(spark, str(data_dir / "invoices.csv"), tiers, store, "d1", out, rejects)
    cube = job.run(spark, str(data_dir / "invoices_dirty.csv"), tiers, store, "d2", out, rejects)
    grand = cube.filter("legal_entity = 'Total' AND counter_party = 'Total' AND tier = 'Total'").first()
    # Day 1 is the clean file; day 2 the dirty one (its 21 valid rows).
    assert (grand.sum_value_ARAP, grand.sum_value_ACCR) == (1250 + 1315, 512 + 470)
    # Re-running a day replaces it rather than adding it twice.
    again = job.run(spark, str(data_dir / "invoices_dirty.csv"), tiers, store, "d2", out, rejects)
    grand = again.filter("legal_entity = 'Total' AND counter_party = 'Total' AND tier = 'Total'").first()
    assert (grand.sum_value_ARAP, grand.sum_value_ACCR) == (1250 + 1315, 512 + 470)
    assert spark.read.option("header", True).csv(f"{rejects}/day=d2").count() == 4
