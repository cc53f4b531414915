"""Quality: a weak-label model over heuristic labellers, and a hashed linear scorer.

1. Every text is measured (shares of marks, capitals, digits, repeated words,
   repeated lines, common words and so on) and each labeller votes good, bad or
   nothing by thresholds on one measure.
2. Votes are counted per vote pattern over all documents. There are at most 3 to
   the number of labellers patterns, whatever the input, so the expectation-
   maximisation runs on that table: it alternates the posterior of each pattern
   and each labeller's probabilities to vote as it does on good and on bad texts
   (their accuracies), from a majority vote as the start. No labels are read.
3. A logistic scorer over hashed byte-class trigrams and the measures' bins is
   fitted to the posteriors of at most ``max_sample`` documents, chosen by a hash of
   id and text, and then scores every whole text. Texts whose score is at least
   ``threshold`` are kept.

Null and empty texts get no votes and score 0: there is nothing to keep. Rows of
one id are judged each for itself. Extra columns are kept by ``keep_good``. An
empty table gives no rows.
"""

from __future__ import annotations

import operator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import store
from .names import free

BUCKETS = 1024
MAX_SAMPLE = 6000
GOOD, BAD, NONE = 1, 0, 2
# Frequent function words of English, German, French and Spanish.
COMMON = frozenset(
    "the of and to in is that it was for on are as with his they at be this from have or by one had not but what all were when we "
    "der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach "
    "le la les et des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec ou son "
    "el los las y que una por con no su para es al lo como más pero sus le ya o este sí porque esta entre".split()
)
_CLASS = np.full(256, 7, np.int64)  # bytes beyond ASCII and control bytes
_CLASS[ord("a") : ord("z") + 1] = 0
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[[32, 9]] = 3
_CLASS[[10, 13]] = 4
for _k, _c in enumerate("""!"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"""):
    _CLASS[ord(_c)] = 8 + _k
_CLASS[128:] = 5
_SIZE = 40
_MARKS = (_CLASS >= 8) & ~np.isin(np.arange(256), [ord(c) for c in ".,'-"])
MEASURES = ("marks", "capitals", "digits", "repeats", "lines", "common", "variety", "length", "wordiness")


def measures(text: str) -> np.ndarray:
    """The measures of a non-empty text, in the order of ``MEASURES``."""
    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
    counts = np.bincount(raw, minlength=256)
    classes = np.bincount(_CLASS, counts, _SIZE)
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    n, size = max(1, len(words)), max(1, len(raw))
    letters = max(1.0, classes[0] + classes[1] + classes[5])
    lowered = text.lower().split()
    return np.array([
        counts[_MARKS].sum() / size,
        classes[1] / letters,
        classes[2] / size,
        sum(map(operator.eq, words, words[1:])) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        sum(map(COMMON.__contains__, lowered)) / n,
        min(1.0, len(set(lowered)) / min(n, 400)),
        n,
        len(text) / n,
    ])


# (measure, good if at most, bad if at least); a negative measure index reads the other way round.
LABELLERS = (
    ("marks", 0.015, 0.05), ("capitals", 0.12, 0.4), ("digits", 0.03, 0.2), ("repeats", 0.03, 0.2), ("lines", 0.1, 0.4),
    ("wordiness", 9.0, 14.0), ("-common", 0.12, 0.04), ("-variety", 0.3, 0.12),
)
# Shares that say little about a few words: their labellers do not vote bad on texts under FEW words.
FEW = 25
_SMALL = ("digits", "wordiness", "common", "variety", "marks")


def votes(measured: np.ndarray) -> np.ndarray:
    """A row of votes (GOOD, BAD, NONE) per row of measures."""
    out = np.full((len(measured), len(LABELLERS)), NONE, np.int64)
    for k, (name, good, bad) in enumerate(LABELLERS):
        value = measured[:, MEASURES.index(name.lstrip("-"))]
        if name.startswith("-"):
            out[value >= good, k], out[value <= bad, k] = GOOD, BAD
        else:
            out[value <= good, k], out[value >= bad, k] = GOOD, BAD
        if name.lstrip("-") in _SMALL:
            out[(measured[:, MEASURES.index("length")] < FEW) & (out[:, k] == BAD), k] = NONE
    return out


def label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of good per vote pattern, and each labeller's probabilities
    (labeller, class, vote), by expectation-maximisation."""
    m = patterns.shape[1]
    one_hot = np.eye(3)[patterns]  # pattern, labeller, vote
    for_good, for_bad = (patterns == GOOD).sum(axis=1), (patterns == BAD).sum(axis=1)
    # A labeller says bad of few texts; one such vote outweighs several good ones.
    posterior = 1 / (1 + np.exp(np.clip(3.0 * for_bad - 0.6 * for_good, -20, 20)))
    weights = counts / counts.sum()
    accuracy = np.full((m, 2, 3), 1 / 3)
    for _ in range(rounds):
        mass = np.stack([weights * (1 - posterior), weights * posterior])  # class, pattern
        accuracy = np.einsum("cp,plv->lcv", mass, one_hot) + 1e-4
        accuracy /= accuracy.sum(axis=2, keepdims=True)
        prior = np.clip(mass.sum(axis=1), 1e-4, None)
        likely = np.einsum("plv,lcv->pc", one_hot, np.log(accuracy)) + np.log(prior)
        posterior = 1 / (1 + np.exp(np.clip(likely[:, 0] - likely[:, 1], -30, 30)))
    return posterior, accuracy


_EDGES = {
    "marks": (0.005, 0.015, 0.03, 0.05, 0.1), "capitals": (0.02, 0.06, 0.12, 0.25, 0.5), "digits": (0.005, 0.02, 0.05, 0.1, 0.2),
    "repeats": (0.01, 0.03, 0.08, 0.2, 0.5), "lines": (0.02, 0.1, 0.2, 0.4, 0.6), "common": (0.02, 0.06, 0.12, 0.2, 0.35),
    "variety": (0.06, 0.12, 0.2, 0.3, 0.6), "length": (2, 5, 10, 30, 200), "wordiness": (4, 6, 8, 10, 14),
}
WIDTH = BUCKETS + 6 * len(MEASURES)
_BUCKET = (np.arange(_SIZE**3) * 2654435761 % 2**32) * BUCKETS >> 32


def features(text: str, measured: np.ndarray) -> np.ndarray:
    """Hashed byte-class trigrams (square roots of their shares) and the measures' bins."""
    kinds = _CLASS[np.frombuffer(text.encode("utf-8"), np.uint8)]
    out = np.zeros(WIDTH, np.float32)
    if len(kinds) >= 3:
        grams = _BUCKET[(kinds[:-2] * _SIZE + kinds[1:-1]) * _SIZE + kinds[2:]]
        out[:BUCKETS] = np.sqrt(np.bincount(grams, minlength=BUCKETS) / len(kinds))
    for k, name in enumerate(MEASURES):
        out[BUCKETS + 6 * k + np.searchsorted(_EDGES[name], measured[k], side="right")] = 1
    return out


def fit_scorer(rows: np.ndarray, targets: np.ndarray, l2: float = 1e-4, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on soft targets."""
    n, kind = len(rows), np.float32  # one type throughout, or every product would copy the rows
    weights, speed, bias, bias_speed = np.zeros(rows.shape[1], kind), np.zeros(rows.shape[1], kind), 0.0, 0.0
    step, l2 = kind(4.0 / max(1.0, float(np.einsum("ij,ij->i", rows, rows).max()))), kind(l2)
    targets = targets.astype(kind)
    for _ in range(rounds):
        ahead = weights + kind(0.9) * speed
        error = 1 / (1 + np.exp(-np.clip(rows @ ahead + kind(bias + 0.9 * bias_speed), -30, 30))) - targets
        speed = kind(0.9) * speed - step * (error @ rows / kind(n) + l2 * ahead)
        bias_speed = 0.9 * bias_speed - float(step * error.mean())
        weights, bias = weights + speed, bias + bias_speed
    return weights.astype(np.float64), float(bias)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_sample: int = MAX_SAMPLE) -> dict:
    """The label model's posteriors and accuracies and the scorer's weights."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text")).where("text != ''")
    texts = texts.select("text", F.xxhash64("id", "text").alias("mark"))

    def vote(batches):
        for batch in batches:
            if batch.num_rows:
                measured = np.array([measures(t.as_py()) for t in batch.column(0)])
                code = votes(measured) @ 3 ** np.arange(len(LABELLERS))
                yield pa.RecordBatch.from_arrays([pa.array(code.astype(np.int32)), batch.column(1)], ["pattern", "mark"])

    voted = store(spark, texts.mapInArrow(vote, "pattern int, mark long"), "quality-votes")
    table = voted.groupBy("pattern").count().orderBy("pattern").collect()  # at most 3 ** labellers rows
    if not table:
        return {"weights": np.zeros(WIDTH), "bias": 0.0, "accuracy": None}
    code = np.array([r["pattern"] for r in table])
    counts = np.array([r["count"] for r in table], float)
    patterns = code[:, None] // 3 ** np.arange(len(LABELLERS)) % 3
    posterior, accuracy = label_model(patterns, counts)
    by_code = dict(zip(code.tolist(), posterior.tolist()))
    share = min(1.0, 0.95 * max_sample / counts.sum())
    sampled = texts.where(F.pmod("mark", F.lit(1_000_003)) < int(1_000_003 * share)) if share < 1 else texts

    def describe(batches):
        for batch in batches:
            out = []
            for t in batch.column(0):
                text = t.as_py()
                measured = measures(text)
                target = by_code[int((votes(measured[None, :]) @ 3 ** np.arange(len(LABELLERS)))[0])]
                out.append((features(text, measured).tobytes(), target))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out])], ["x", "y"])

    # One text per part of the hash, so that copies of a text do not fill the sample.
    distinct = sampled.dropDuplicates(["mark"]).select("text")
    sample = distinct.mapInArrow(describe, "x binary, y double").limit(max_sample).collect()
    rows = np.frombuffer(b"".join(r["x"] for r in sample), np.float32).reshape(-1, WIDTH)
    weights, bias = fit_scorer(rows, np.array([r["y"] for r in sample]))
    return {"weights": weights, "bias": bias, "accuracy": accuracy}


def with_scores(docs: DataFrame, model: dict, out_col: str, text_col: str, keep: list[str]) -> DataFrame:
    """``keep`` and the score of every row's whole text, in one pass over the scan."""
    weights, bias = model["weights"], model["bias"]
    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField(out_col, T.DoubleType())])

    def run(batches):
        for batch in batches:
            scores = []
            for t in batch.column(batch.num_columns - 1):
                text = t.as_py()
                if not text:
                    scores.append(0.0)
                    continue
                logit = float(features(text, measures(text)) @ weights) + bias
                scores.append(float(1 / (1 + np.exp(-np.clip(logit, -500, 500)))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())], [*keep, out_col])

    return docs.select(*keep, F.col(text_col).cast("string").alias(*free([*keep, out_col], "text_to_score"))).mapInArrow(run, schema)


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, score (of good) and keep."""
    model = fit(docs, id_col, text_col, **options)
    ided = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return with_scores(ided, model, "score", "text", ["doc_id"]).withColumn("keep", F.col("score") >= threshold)


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, **options) -> DataFrame:
    """``docs`` without the rows that score under ``threshold``."""
    model, (score,) = fit(docs, id_col, text_col, **options), free(docs.columns, "score")
    return with_scores(docs, model, score, text_col, docs.columns).where(F.col(score) >= threshold).select(*docs.columns)
