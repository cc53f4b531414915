from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

from helpers import empty, messy

from tierwise.llm import mixing
from tierwise.operators import joins


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    """Shares resharing the excess until none is above, in fractions."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in stopped]
        share = Fraction(total - sum(stopped.values()), sum(weight[s] for s in rest)) if rest else 0
        above = {s: most * sizes[s] for s in rest if weight[s] * share > most * sizes[s]}
        if not above:
            return {**{s: float(weight[s] * share) for s in rest}, **{s: float(v) for s, v in stopped.items()}}
        stopped.update(above)


def corpus(spark, seed, sources=40, docs=1500):
    rng = random.Random(seed)
    names = [None, "", "é", "z", "Z", "😀", "￿"] + [f"s{i}" for i in range(sources - 7)]
    heavy = [rng.random() ** 6 for _ in names]
    rows = [(i, " ".join("w" for _ in range(rng.choice([0, 1, 5, 80]))), rng.choices(names, heavy)[0]) for i in range(docs)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string"), rows


def check(plan, rows):
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = brute_targets(sizes)
    got = plan.collect()
    assert len(got) == len(rows)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) <= 1e-6 * max(1, want[r.source])
        assert r.target <= 3 * r.source_size and r.taken == r.size * r.copies <= 3 * r.size
        rate = r.target / r.source_size if r.source_size else 0
        assert r.copies in (int(rate), int(rate) + 1)
        taken[r.source] += r.taken
    return sizes, want, taken


def test_targets_against_fractions_and_reruns_agree(spark):
    for seed in (1, 2, 3):
        docs, rows = corpus(spark, seed)
        check(mixing.plan(docs), rows)
    again = lambda: sorted(map(tuple, mixing.plan(docs.repartition(7)).collect()), key=repr)
    assert again() == again()


def test_taken_words_come_near_the_target(spark):
    docs, rows = corpus(spark, 4, sources=9, docs=20_000)
    sizes, want, taken = check(mixing.plan(docs), rows)
    for s, target in want.items():
        # Five standard deviations of independent copies of at most 80 words.
        assert abs(taken[s] - target) <= 5 * (80 * sizes[s] / 4) ** 0.5 + 1


def test_a_hot_source_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(joins, "DEFAULT_MAX_BROADCAST_ROWS", 0)
    monkeypatch.setattr(joins, "checked_broadcast", lambda df, *a, **k: (df, False))
    rows = [(i, "a b c", "hot" if i % 3 else f"s{i % 200}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check(mixing.plan(docs), rows)


def test_mix_emits_what_the_plan_takes(spark):
    docs, _ = corpus(spark, 5, docs=400)
    plan = {r.doc_id: r for r in mixing.plan(docs).collect()}
    emitted = Counter(r.doc_id for r in mixing.mix(docs.withColumn("__draw", docs.doc_id)).collect())
    assert all(emitted[i] == p.copies for i, p in plan.items() if p.size)
    assert mixing.mix(docs).columns == docs.columns


def test_messy_rows_empty_tables_and_one_source(spark):
    docs = messy(spark)
    got = mixing.plan(docs).collect()
    assert len(got) == docs.count() and all(r.target == r.source_size for r in got)  # one source takes all
    assert {r.taken for r in got if r.size == 0} == {0}
    assert mixing.mix(docs).columns == docs.columns
    assert mixing.plan(empty(spark)).count() == 0 and mixing.mix(empty(spark)).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", "b"), (None, "", None)], "doc_id long, text string, source string")
    assert [r.taken for r in mixing.plan(blank).collect()] == [0, 0, 0]
