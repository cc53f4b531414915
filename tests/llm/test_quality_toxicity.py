from __future__ import annotations

import zlib

import numpy as np
from helpers import TEXTS, documents, empty, messy

from tierwise.llm import quality, toxicity

SF = "/root/testdata/sf0.01"


def labels(spark, column):
    return {r.doc_id: r[column] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


def test_quality_agrees_with_the_labels_it_never_saw(spark):
    known = labels(spark, "quality")
    rows = quality.classify(documents(spark, SF)).collect()
    right = [r.keep == bool(known[r.doc_id]) for r in rows if r.doc_id in known]
    lost = [r.doc_id for r in rows if known.get(r.doc_id) == 1 and not r.keep]
    assert np.mean(right) >= 0.97 and len(lost) <= 0.01 * len(right)
    kept = {r.doc_id for r in quality.keep_good(documents(spark, SF)).collect()}
    assert kept == {r.doc_id for r in rows if r.keep}


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.8
    accuracy = [0.95, 0.9, 0.8, 0.7]
    votes = np.stack([np.where(rng.random(len(truth)) < a, truth, ~truth).astype(int) for a in accuracy], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    posterior, found = quality.label_model(patterns, counts.astype(float), rounds=200)
    for k, a in enumerate(accuracy):
        assert abs(found[k, 1, 1] - a) < 0.05
    best = dict(zip(map(tuple, patterns), posterior))
    assert np.mean([(best[tuple(v)] >= 0.5) == t for v, t in zip(votes, truth)]) > 0.93


def test_quality_messy_rows(spark):
    docs = messy(spark)
    rows = quality.classify(docs).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.score == 0 and not r.keep for r in rows if r.doc_id in (3, 4))
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    assert quality.classify(empty(spark)).collect() == [] and quality.keep_good(empty(spark)).collect() == []
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert [r.score for r in quality.classify(blank).collect()] == [0.0, 0.0]


def test_toxicity_on_the_held_out_fold(spark):
    sf = "/root/testdata/sf0.1"
    docs, marked = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = toxicity.classify(docs, marked).collect()
    assert len(rows) == docs.count()
    known = {r.doc_id: r.toxic for r in marked.collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5) for r in rows)
    held = [(r.score, known[r.doc_id]) for r in rows if r.held_out and r.doc_id in known]
    toxic, clean = [s for s, y in held if y], [s for s, y in held if not y]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in toxic for b in clean])
    assert auc >= 0.93 and np.mean([s >= 0.5 for s in clean]) <= 0.02 and np.mean([s >= 0.5 for s in toxic]) >= 0.8


def test_neutral_group_mentions_do_not_move_the_score(spark):
    # One group is named in toxic texts far more often than in others; the words that make them toxic are others.
    rows, marks = [], []
    for i in range(600):
        toxic, group = i % 4 == 0, ("muslims" if i % 4 == 0 and i % 8 else "people" if i % 3 else "women")
        rows.append((i, f"these {group} {'are scum and trash' if toxic else 'were at the river'} on day{i}"))
        marks.append((i, int(toxic)))
    docs, marked = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")
    none = lambda column: column < 0
    fair, _ = toxicity.fit(docs, marked, none, fairness=20.0)
    blunt, _ = toxicity.fit(docs, marked, none, fairness=0.0)
    gap = lambda w: abs(w.get("muslims", 0) - w.get("people", 0))
    assert gap(blunt) > 0.5 and gap(fair) < 0.2 * gap(blunt)
    assert fair["scum"] > 1 and fair["trash"] > 1


def test_toxicity_messy_rows(spark):
    docs = messy(spark)
    marked = spark.createDataFrame([(1, 1, "x"), (2, 0, "x"), (2, None, "x"), (None, 1, "x"), (99, 1, "x")], "doc_id long, toxic int, label string")
    rows = toxicity.classify(docs, marked).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out for r in rows if r.doc_id is None)
    assert len({r.score for r in rows if r.doc_id in (3, 4, 7)}) == 1  # null, empty and blank: the bias
    assert toxicity.classify(empty(spark), marked).collect() == []
    unlabelled = toxicity.classify(docs, marked.limit(0)).collect()
    assert len(unlabelled) == len(TEXTS) and all(r.predicted == 0 for r in unlabelled)


def test_swapping_a_group_does_not_move_the_whole_score(spark):
    # As above, but over everything a swap changes: the term and its beginnings.
    rows, marks = [], []
    for i in range(600):
        toxic, group = i % 4 == 0, ("muslims" if i % 4 == 0 and i % 8 else "people" if i % 3 else "women")
        rows.append((i, f"these {group} {'are scum and trash' if toxic else 'were at the river'} on day{i}"))
        marks.append((i, int(toxic)))
    docs, marked = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")
    none = lambda column: column < 0
    logit = lambda w, text: sum(w.get(e, 0) for e in toxicity.entries(toxicity.words(text)))
    gap = lambda w: abs(logit(w, "these muslims were here") - logit(w, "these people were here"))
    fair, _ = toxicity.fit(docs, marked, none, fairness=20.0)
    blunt, _ = toxicity.fit(docs, marked, none, fairness=0.0)
    assert gap(blunt) > 0.5 and gap(fair) < 0.2 * gap(blunt)


def test_swaps_leave_what_other_words_give():
    order = {w: k for k, w in enumerate(sorted({"muslims", "people", "^musli", "^muslim", "^muslims", "^peopl", "^people"}))}
    name = {str(k): w for w, k in order.items()}
    told = {tuple(tuple(name[p] for p in side.split(",") if p) for side in c.split("|")) for c in toxicity.swaps({"muslims", "muslimah"}, order)}
    assert (("^muslims", "muslims"), ("^peopl", "^people", "people")) in told


def test_the_sample_is_bounded_when_ids_repeat(spark, monkeypatch):
    from tierwise.llm import toxicity

    seen = []
    train = toxicity._train
    monkeypatch.setattr(toxicity, "_train", lambda rows, *a: seen.append(len(rows)) or train(rows, *a))
    rows = [(i % 30, f"{'vile' if i % 2 else 'kind'} words number {i}") for i in range(4000)] + [(1, "the same")] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, toxic int")
    toxicity.fit(docs, labels, lambda c: c < 0, max_sample=30, min_z=0.1)
    assert seen and max(seen) <= 30


def test_identity_terms_in_training_texts_change_the_weights(spark):
    from tierwise.llm import toxicity

    # One group is named in toxic texts only; without the penalty its name would weigh as much as an insult.
    rows = [(i, f"the muslims are vile number{i}") for i in range(40)] + [(100 + i, f"the people are kind number{i}") for i in range(40)]
    rows += [(200 + i, f"les musulmans sont affreux number{i}") for i in range(40)] + [(300 + i, f"les gens sont gentils number{i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 100 or 200 <= i < 300)) for i, _ in rows], "doc_id long, toxic int")
    none = lambda c: c < 0
    fair, _ = toxicity.fit(docs, labels, none, min_z=0.5)
    plain, _ = toxicity.fit(docs, labels, none, min_z=0.5, fairness=0.0)
    gap = lambda w, a, b: abs(w.get(a, 0) - w.get(b, 0))
    for a, b in (("muslims", "people"), ("musulmans", "gens")):
        assert gap(plain, a, b) > 0.5 and gap(fair, a, b) < 0.2 * gap(plain, a, b)
    assert fair["vile"] > 0.5


def test_quality_scores_equal_a_plain_computation(spark):
    """Votes, label model and scorer anew over all texts at once, without Spark."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    scores = {r.doc_id: r.score for r in quality.classify(docs).collect()}
    texts = [(i, t, quality.measures(t)) for i, t in rows if t]
    said = quality.votes(np.array([m for *_, m in texts]))
    patterns, place, counts = np.unique(said, axis=0, return_inverse=True, return_counts=True)
    posterior = quality.label_model(patterns, counts.astype(float))[0][place.ravel()]
    distinct = sorted({(i, t): k for k, (i, t, _) in enumerate(texts)}.values())
    x = np.array([quality.features(t, m) for _, t, m in texts])
    weights, bias = quality.fit_scorer(x[distinct], posterior[distinct])
    plain = 1 / (1 + np.exp(-(x.astype(float) @ weights + bias)))
    assert len(scores) == len(rows) and all(scores[i] == 0 for i, t in rows if not t)
    assert max(abs(scores[i] - p) for (i, *_), p in zip(texts, plain)) < 1e-3
