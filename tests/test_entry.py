"""The driver contract, and every registered query against its SQL oracle."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tierwise.plans import catalog, oracles

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if v is None:
        return "\0null"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{round(v, 6):.6f}"
    return str(v)


def multiset(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs_on_the_smallest_data(spark):
    df = entry.entry(spark)
    assert df.columns == ["legal_entity", "counter_party", "tier", "max_rating", "sum_value_ARAP", "sum_value_ACCR"]
    assert df.count() >= 1


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(oracles.ORACLE_SQL)
    assert set(catalog.QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    expected = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert multiset(df.columns, got) == multiset(cols, expected)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_reads_whole_tables(spark, name):
    # No registered query caps or samples its rows.
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    for node in ("GlobalLimit", "LocalLimit", "Sample", "Tail"):
        assert node not in plan, f"{name} plan contains {node}"


def test_recorded_figures_at_sf001(spark):
    sf = "/root/testdata/sf0.01"
    q = entry.queries()
    assert q["totals_count_label"](spark, sf).count() == 477
    cube = q["totals_cube_label"](spark, sf)
    grand = cube.filter("legal_entity = 'Total' AND counter_party = 'Total' AND tier = 'Total'").collect()
    assert [(r.max_rating, r.sum_value_ARAP, r.sum_value_ACCR) for r in grand] == [(7, 506627, 508542)]
    assert cube.count() == 678


def test_bench_prints_one_json_line():
    import json
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    some = ["totals_count_label", "enrich_salted", "tolerant_read_rows"]
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_ROUNDS="1", BENCH_CPUS="2", BENCH_QUERIES=",".join(some))
    done = subprocess.run([sys.executable, "bench.py"], cwd=repo, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-2000:]
    lines = [line for line in done.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(result) and sorted(result["queries"]) == sorted(some)
    assert result["unit"] == "sec" and result["value"] > 0 and "failed" not in result
