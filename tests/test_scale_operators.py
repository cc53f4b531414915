"""Key filter, combiner, lattice, fan-out, warehouse source and replayable writes."""

from __future__ import annotations

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tierwise.functions.metrics import count_of, count_rows, max_of, sum_if, sum_of
from tierwise.operators import combine, fanout, joins, lattice, totals
from tierwise.sinks import replace_partitions
from tierwise.sources import warehouse


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_key_filter_keeps_matches_and_drops_most_others(spark):
    fact = spark.range(40_000).selectExpr("IF(id % 50 = 0, NULL, id) AS k", "cast(id AS string) AS s", "id AS v")
    dictionary = spark.range(0, 40_000, 40).selectExpr("id AS k", "cast(id AS string) AS s")
    for on in ("k", ["k", "s"]):
        kept = joins.key_filter(fact, dictionary, on)
        matches = fact.join(dictionary, on, "left_semi")
        assert matches.exceptAll(kept).count() == 0
        assert matches.count() <= kept.count() <= matches.count() + 0.03 * 40_000
    assert rows_of(joins.keys_in_dictionary(fact, dictionary, "k", bloom=True)) == rows_of(joins.keys_in_dictionary(fact, dictionary, "k"))
    assert rows_of(joins.enrich(fact, dictionary.select("k"), "k", bloom=True)) == rows_of(joins.enrich(fact, dictionary.select("k"), "k"))
    # A full filter passes everything; no keys pass nothing.
    assert joins.key_filter(fact, dictionary, "k", max_bits=64).exceptAll(fact).count() == 0
    assert joins.key_filter(fact, dictionary.limit(0), "k").count() == 0
    assert joins.key_filter(fact.selectExpr("cast(k AS int) AS k"), dictionary, "k").count() == 40_000


def test_key_filter_runs_before_the_shuffle(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact, dictionary = spark.range(20_000).selectExpr("id AS k", "id AS v"), spark.range(0, 20_000, 100).selectExpr("id AS k")
        joined = joins.keys_in_dictionary(fact, dictionary, "k", broadcast=False, bloom=True)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        exchange = plan[plan.index("Exchange hashpartitioning") :]
        assert "Filter" in exchange[: exchange.index("Range")] and "subquery" in exchange[: exchange.index("Range")].lower()
        assert joined.count() == 200
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("max_groups", [100_000, 2])
def test_combiner_against_statistics(spark, max_groups):
    rng = random.Random(1)
    data = [(rng.choice(["hot"] * 8 + ["a", "b", None]), rng.randint(0, 2), rng.choice([None, 1e9 + rng.random(), 1e9 + 5])) for _ in range(3000)]
    df = spark.createDataFrame(data, "g string, h int, x double").repartition(5)
    got = {(r.g, r.h): r.var for r in combine.combine_by(df, ["g", "h"], ["x"], combine.second_moment(), "var", max_groups).collect()}
    groups: dict = {}
    for g, h, x in data:
        groups.setdefault((g, h), []).extend([] if x is None else [x])
    assert set(got) == set(groups)
    for k, values in groups.items():
        assert (got[k] is None and not values) or math.isclose(got[k], statistics.pvariance(values), rel_tol=1e-6, abs_tol=1e-6)


def test_combiner_of_another_state(spark):
    # The longest text and how many are as long.
    def more(acc, texts):
        for t in texts:
            if len(t) > len(acc[0]):
                acc = (t, 1)
            elif len(t) == len(acc[0]):
                acc = (min(t, acc[0]), acc[1] + 1)
        return acc

    longest = combine.Combiner(
        create=lambda: ("", 0),
        add=lambda acc, cols: more(acc, cols[0].to_pylist()),
        merge=lambda a, b: a if len(a[0]) > len(b[0]) else b if len(b[0]) > len(a[0]) else (min(a[0], b[0]), a[1] + b[1]),
        extract=lambda acc: f"{acc[0]}:{acc[1]}", state="text string, n long", result="string",
    )
    df = spark.createDataFrame([(i % 3, "x" * (i % 7)) for i in range(70)], "k long, t string").repartition(4)
    got = {r.k: r.out for r in combine.combine_by(df, "k", ["t"], longest, "out").collect()}
    assert got == {k: f"xxxxxx:{sum(i % 3 == k and i % 7 == 6 for i in range(70))}" for k in range(3)}
    assert combine.combine_by(df.limit(0), "k", ["t"], longest, "out").count() == 0


def metrics():
    return [max_of("v"), sum_of("v"), count_of("v"), count_rows("n"), sum_if("v", F.col("v") > 5, "big")]


@pytest.mark.parametrize("sets,label,keys", [("cube", "total", []), ("cube", "count", []), ("pairs", "count", ["k"]), ("rollup", "null", ["k"]), ("singles", "count", [])])
def test_lattice_equals_totals(spark, sets, label, keys):
    rng = random.Random(5)
    data = [(rng.choice([None, "p", "q"]), rng.randint(0, 3), rng.choice([None, 1, 2]), rng.choice("xy"), rng.choice([None, *range(12)])) for _ in range(400)]
    df = spark.createDataFrame(data, "a string, b int, c int, k string, v long")
    dims = ["a", "b", "c"]
    want = totals.totals(df, dims, metrics(), sets, label, keys, grouping_id="gid")
    got = lattice.totals_by_lattice(df, dims, metrics(), sets, label, keys, grouping_id="gid")
    assert got.columns == want.columns and rows_of(got) == rows_of(want)


def test_lattice_of_no_rows(spark):
    df = spark.createDataFrame([], "a string, b int, v long")
    for label in ("total", "count"):
        assert rows_of(lattice.totals_by_lattice(df, ["a", "b"], metrics(), "cube", label)) == rows_of(totals.totals(df, ["a", "b"], metrics(), "cube", label))


def test_eight_dimensions_expand_fewer_rows():
    cards = [2, 3, 2, 2, 2, 2, 7, 4]
    dims = [f"d{i}" for i in range(8)]
    sizes = {}
    for s in totals.grouping_sets(dims, "cube"):
        sizes[frozenset(s)] = min(5000, math.prod(cards[dims.index(c)] for c in s))
    stored, parent = lattice.choose_parents(sizes, frozenset(dims))
    assert all(parent[s] >= s and parent[s] in stored for s in sizes)
    plain = sizes[frozenset(dims)] * len(sizes)
    assert lattice.expand_rows(sizes, parent) + sum(sizes[v] for v in stored) < plain / 3


def test_fan_out_yields_any_number_of_rows(spark):
    df = spark.createDataFrame([("a", "b", None, 1), (None, "x", "y", 2), (None, None, None, 3)], "p string, q string, r string, v long")
    got = rows_of(fanout.fan_out(df, fanout.keyed_levels, "level string, key string", ["p", "q", "r"], keep=["v"]))
    assert got == [(1, "0", "a"), (1, "01", "a|b"), (1, "1", "b"), (2, "1", "x"), (2, "12", "x|y"), (2, "2", "y")]


def test_fan_out_holds_a_batch_of_made_rows_and_sends_no_batch_per_row(spark):
    def many(n, text):
        for i in range(n or 0):
            yield i, None if i % 2 else text

    df = spark.range(3000, numPartitions=2).selectExpr(
        "id", "IF(id = 7, 25000, IF(id % 5 = 0, NULL, id % 3)) AS n", "IF(id % 4 = 0, NULL, concat('t', id)) AS text",
        "timestamp_seconds(id) AS at", "id % 2 = 0 AS n_kept",
    )
    got = fanout.fan_out(df, many, "place long, word string", ["n", "text"], keep=["at", "id", "n_kept"])
    assert "MapInArrow" in got._jdf.queryExecution().executedPlan().toString()
    made = df.selectExpr("*", "explode(sequence(0L, cast(n AS bigint) - 1)) AS place").where("n > 0")
    want = made.selectExpr("at", "id", "n_kept", "place", "IF(place % 2 = 0, text, NULL) AS word")
    assert got.schema.simpleString() == want.schema.simpleString()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()

    # Batches of the generator's task: as many as its made rows need, and none larger.
    import pyarrow as pa
    from pyspark.sql import types as T

    rows = pa.RecordBatch.from_pydict({"n": [1] * 900 + [25_000], "text": ["x"] * 901, "id": list(range(901))})
    schema = T.StructType.fromDDL("place long, word string")
    sizes = [b.num_rows for b in fanout._generate(many, schema, 2)(iter([rows]))]
    assert sizes == [10_000, 10_000, 5_900]


def test_fan_out_of_values_that_spark_converts(spark):
    df = spark.sql("SELECT timestamp'2024-01-02 03:04:05' AS at, array('a', NULL) AS words, named_struct('x', 1) AS s, 5 AS v")
    got = fanout.fan_out(df, lambda at, words, s: [(at, w, s["x"] + len(words)) for w in words], "at2 timestamp, word string, n int", ["at", "words", "s"], keep=["v", "words"])
    want = spark.sql("SELECT 5 AS v, array('a', NULL) AS words, timestamp'2024-01-02 03:04:05' AS at2, explode(array('a', NULL)) AS word, 3 AS n")
    assert rows_of(got) == rows_of(want) and got.count() == 2


def test_fan_out_without_inputs(spark):
    got = fanout.fan_out(spark.range(3), lambda: [("x",), ("y",)], "w string", [], keep=["id"])
    assert rows_of(got) == [(0, "x"), (0, "y"), (1, "x"), (1, "y"), (2, "x"), (2, "y")]


def test_warehouse_commits_all_or_nothing(spark, tmp_path):
    warehouse.register(spark)
    path = str(tmp_path / "table")
    rows = spark.range(100).selectExpr("id AS k", "cast(id % 5 AS string) AS s", "IF(id % 10 = 0, NULL, id / 2.0) AS x").repartition(4)
    rows.write.format(warehouse.FORMAT).mode("append").save(path)
    read = lambda: spark.read.format(warehouse.FORMAT).load(path)
    assert rows_of(read()) == rows_of(rows)
    failing = rows.withColumn("k", F.when(F.col("k") == 77, F.raise_error(F.lit("killed")).cast("bigint")).otherwise(F.col("k")))
    with pytest.raises(Exception, match="killed"):
        failing.write.format(warehouse.FORMAT).mode("append").save(path)
    assert rows_of(read()) == rows_of(rows)
    rows.write.format(warehouse.FORMAT).mode("append").save(path)
    assert read().count() == 200
    rows.filter("k < 10").write.format(warehouse.FORMAT).mode("overwrite").save(path)
    assert rows_of(read()) == rows_of(rows.filter("k < 10"))


def test_warehouse_prunes_files(spark, tmp_path):
    warehouse.register(spark)
    path = str(tmp_path / "table")
    for low in (0, 100, 200):
        spark.range(low, low + 100).selectExpr("id AS k", "concat('n', id) AS s").coalesce(2).write.format(warehouse.FORMAT).mode("append").save(path)
    load = lambda *tests: spark.read.format(warehouse.FORMAT).option("where", warehouse.where(*tests)).load(path)
    some = load(("k", ">=", 195), ("k", "<", 203), ("s", "not null"))
    assert sorted(r.k for r in some.collect()) == list(range(195, 203))
    stored = load()
    assert stored.filter("k >= 290").count() == 10 and stored.filter("s = 'n7' OR k = 250").count() == 2
    assert load(("k", "in", [1, 299, 900])).count() == 2 and load(("s", "null")).count() == 0
    files = lambda *tests: len(warehouse.Reader(path, stored.schema, 1, list(tests)).partitions())
    assert 0 < files(("k", ">=", 205)) < files()
    with pytest.raises(ValueError):
        warehouse.where(("k", "like", "x"))


def test_a_repeated_day_changes_nothing_else(spark, tmp_path):
    path = str(tmp_path / "days")
    rows = spark.range(60).selectExpr("id AS v", "id % 3 AS day")
    replace_partitions(rows, path, "day")
    for _ in range(2):
        replace_partitions(rows.filter("day = 1").selectExpr("v + 1000 AS v", "day"), path, "day")
    want = rows.selectExpr("IF(day = 1, v + 1000, v) AS v", "day")
    assert rows_of(spark.read.parquet(path).selectExpr("v", "cast(day AS long)")) == rows_of(want)
    with pytest.raises(Exception, match="broken"):
        bad = rows.filter("day = 2").select(F.raise_error(F.lit("broken")).cast("long").alias("v"), "day")
        replace_partitions(bad, path, "day")
    assert spark.read.parquet(path).count() == 60
