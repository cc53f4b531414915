"""Toxicity: a counterfactual-regularised linear classifier.

A text is the set of its lower-cased words and of their beginnings of five to
eight letters (so inflected and compound forms count); its score is the logistic
function of a bias plus the weights of the vocabulary entries it holds. Training takes the
log loss over labelled texts, an L2 penalty, and a counterfactual penalty: in
every training text that names a group, each identity term is swapped for every
other term of its set, and the squared change of the whole logit is penalised:
the term's and the substitute's words and beginnings, less those that other words
of the text give, too. Equal changes are counted over the training texts, so the
penalty is exact and costs one change, not one text, at a time. A neutral mention of a
group then moves the score no more than a mention of any other, and since each
set holds neutral words (people, person), hardly at all.

Identity terms are English, German, French and Spanish. Where no training text holds
one, as in invented prose, there is no swap to penalise and the model is plain logistic.

Bounds: the fit sees at most ``max_sample`` labelled texts (ids and then texts chosen
by a hash; equal texts of an id once) and ``vocabulary`` entries, those whose share among toxic and other texts
differs most by its z value, and always the identity terms. Scoring covers all
rows and whole texts in one pass over the scan, without a shuffle.

Rows whose id is null or held out are never learnt from. Several labels of a
document count as toxic if one does; null labels are none. Null and empty texts
score the bias. Without labels of both classes every score is the share of
toxic labels (0 without any). Rows of one id are scored each for itself. Extra
columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import store

MAX_SAMPLE = 20_000
VOCABULARY = 4096
MIN_TEXTS = 4
# Groups' names by kind of word; a term is swapped for others of its set only.
IDENTITY_SETS = (
    ("people", "women", "men", "girls", "boys", "muslims", "christians", "jews", "hindus", "buddhists", "atheists", "immigrants",
     "refugees", "foreigners", "gays", "lesbians", "africans", "asians", "europeans", "americans", "mexicans", "germans", "arabs"),
    ("person", "woman", "man", "girl", "boy", "muslim", "christian", "jew", "hindu", "buddhist", "atheist", "immigrant", "refugee",
     "foreigner", "lesbian", "african", "asian", "european", "american", "mexican", "german", "arab"),
    ("other", "black", "white", "gay", "straight", "transgender", "bisexual", "queer", "old", "young", "elderly", "disabled", "blind",
     "deaf", "jewish", "islamic", "catholic", "protestant", "female", "male", "indigenous", "latino"),
    ("leute", "menschen", "frauen", "männer", "mädchen", "jungen", "muslime", "christen", "juden", "hindus", "atheisten", "einwanderer",
     "flüchtlinge", "ausländer", "schwule", "lesben", "afrikaner", "asiaten", "türken", "polen", "araber"),
    ("gens", "personnes", "femmes", "hommes", "filles", "garçons", "musulmans", "chrétiens", "juifs", "hindous", "athées", "immigrés",
     "réfugiés", "étrangers", "homosexuels", "lesbiennes", "africains", "asiatiques", "arabes", "polonais", "roms"),
    ("gente", "personas", "mujeres", "hombres", "chicas", "chicos", "musulmanes", "cristianos", "judíos", "hindúes", "ateos", "inmigrantes",
     "refugiados", "extranjeros", "homosexuales", "lesbianas", "africanos", "asiáticos", "árabes", "gitanos", "mexicanos"),
)
_WORD = re.compile(r"[^\W\d_]+")
BEGINNINGS = (5, 6, 7, 8)


def words(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def entries(found) -> set[str]:
    """Words and their beginnings, these marked by a caret."""
    out = set(found)
    for size in BEGINNINGS:
        out.update(["^" + w[:size] for w in found if len(w) >= size])
    return out


def swaps(found: set[str], order: dict[str, int]):
    """The changes of listed entries by swapping each identity term in ``found`` for each other term of its
    set, as text: places lost, then places gained. Swaps that change none are left out."""
    for group in IDENTITY_SETS:
        for term in found.intersection(group):
            rest = entries(found - {term})
            lost = entries([term]) - rest
            for other in group:
                if other != term:
                    new = entries([other]) - rest
                    sides = [sorted(order[w] for w in side if w in order) for side in (lost - new, new - lost)]
                    if any(sides):
                        yield "|".join(",".join(map(str, side)) for side in sides)


def _train(rows: list[np.ndarray], labels: np.ndarray, size: int, changes: dict[str, int], l2: float, fairness: float, rounds: int):
    """Weights and bias by Nesterov gradient steps on the penalised log loss."""
    n = len(rows)
    row = np.repeat(np.arange(n), [len(r) for r in rows])
    col = np.concatenate(rows).astype(np.int64) if n else np.zeros(0, np.int64)
    sides = [[np.array(side.split(","), np.int64) if side else np.zeros(0, np.int64) for side in c.split("|")] for c in changes]
    count = np.array(list(changes.values()), float) / max(1, n) * fairness
    width = np.array([len(lost) + len(new) for lost, new in sides], np.int64)
    which = np.repeat(np.arange(len(sides)), width)
    place = np.concatenate([side for pair in sides for side in pair]) if sides else np.zeros(0, np.int64)
    sign = np.concatenate([np.repeat([-1.0, 1.0], [len(lost), len(new)]) for lost, new in sides]) if sides else np.zeros(0)
    share = labels.mean()
    weights, bias = np.zeros(size), float(np.log(share / (1 - share)))
    speed, bias_speed = np.zeros(size), 0.0
    # A step the steepest curvature allows: texts' word counts, and the changes' widths.
    degree = np.bincount(place, (2 * count * width)[which], size) if len(place) else np.zeros(size)
    freq = np.bincount(col, minlength=size) / max(1, n)
    step = 1.0 / (0.25 * freq * max(1.0, np.mean([len(r) for r in rows])) + l2 + degree + 1e-3)
    for t in range(rounds):
        ahead, bias_ahead = weights + 0.9 * speed, bias + 0.9 * bias_speed
        logit = bias_ahead + np.bincount(row, ahead[col], n)
        error = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels
        grad = np.bincount(col, error[row], size) / n + l2 * ahead
        if len(place):
            change = 2 * count * np.bincount(which, sign * ahead[place], len(sides))
            grad += np.bincount(place, sign * change[which], size)
        speed = 0.9 * speed - 0.5 * step * grad
        bias_speed = 0.9 * bias_speed - 0.5 * error.mean()
        weights, bias = weights + speed, bias + bias_speed
    return weights, bias


def fit(
    docs: DataFrame, labels: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    max_sample: int = MAX_SAMPLE, vocabulary: int = VOCABULARY, l2: float = 1e-5, fairness: float = 4.0, rounds: int = 600,
    min_z: float = 5.0,
) -> tuple[dict[str, float], float]:
    """(weight by word, bias) learnt from labelled rows outside ``held_out`` (a
    function of the id column)."""
    spark = docs.sparkSession
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).where(~held_out(F.col(id_col)))
    marked = known.groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    total = marked.count()
    if total > max_sample:
        marked = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < int(1_000_003 * 0.95 * max_sample / total))
    marked = store(spark, marked.limit(max_sample), "toxicity-labels")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def split(batches):
        for batch in batches:
            found = pa.array([sorted(entries(words(t.as_py()))) for t in batch.column(0)], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], found], ["label", "mark", "other", "words"])

    # The sample of labels has at most max_sample rows, so it may be broadcast. An id may have any number
    # of texts: equal ones are learnt once, and of more than max_sample texts those of the least hashes.
    marks = F.xxhash64("doc_id", "text").alias("mark"), F.hash("text", "doc_id").alias("other")
    joined = texts.join(F.broadcast(marked), "doc_id").select("text", "label", *marks)
    found = joined.mapInArrow(split, "label int, mark long, other int, words array<string>")
    found = store(spark, found.groupBy("mark", "other").agg(F.first("label").alias("label"), F.first("words").alias("words")), "toxicity-sample")
    sample = found.orderBy("mark", "other").limit(max_sample)
    sample = store(spark, sample.select("label", "words"), "toxicity-bounded")
    classes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    seen, toxic = sum(classes.values()), classes.get(1, 0)
    if not toxic or toxic == seen:
        share = min(max(toxic / seen if seen else 0.0, 1e-9), 1 - 1e-9)
        return {}, float(np.log(share / (1 - share)))
    by_word = sample.select("label", F.explode("words").alias("word")).groupBy("word").agg(
        F.count("*").alias("n"), F.sum("label").alias("hits")
    )
    share = toxic / seen
    z = F.abs(F.col("hits") - F.col("n") * share) / F.sqrt(F.col("n") * share * (1 - share))
    terms = {w: (s, i) for s, group in enumerate(IDENTITY_SETS) for i, w in enumerate(group)}
    listed = by_word.where(F.col("n") >= MIN_TEXTS).withColumn("z", z).where(F.col("z") >= min_z)
    chosen = {r["word"] for r in listed.orderBy(F.desc("z"), "word").limit(vocabulary).collect()} | set(terms)
    order = {w: k for k, w in enumerate(sorted(chosen))}

    def places(batches):
        for batch in batches:
            found = [[order[w] for w in ws if w in order] for ws in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], ["label", "places"])

    rows = sample.select("label", "words").mapInArrow(places, "label int, places array<int>").collect()
    known_places = [np.array(r["places"], np.int64) for r in rows]

    def changed(batches):
        for batch in batches:
            found = [c for ws in batch.column(0).to_pylist() for c in swaps({w for w in ws if w[0] != "^"}, order)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["change"])

    # Per pair of terms a few changes at most, whatever the texts: beginnings are lost or kept from the longest on.
    counted = sample.select("words").mapInArrow(changed, "change string").groupBy("change").count()
    changes = {r["change"]: r["count"] for r in counted.orderBy("change").collect()}
    weights, bias = _train(known_places, np.array([r["label"] for r in rows], float), len(order), changes, l2, fairness, rounds)
    return {w: float(weights[k]) for w, k in order.items() if weights[k]}, float(bias)


def with_scores(docs: DataFrame, weights: dict[str, float], bias: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of every row."""

    def run(batches):
        known = weights.keys()
        starts = {w[1 : 1 + BEGINNINGS[0]] for w in known if w[0] == "^"}

        def logit(text):
            found = words(text)
            near = entries([w for w in found if w[: BEGINNINGS[0]] in starts])
            return bias + sum(weights[w] for w in sorted((found | near) & known))

        for batch in batches:
            logits = np.array([logit(t.as_py()) for t in batch.column(1)], float)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(logits, -500, 500))))], ["doc_id", "score"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, score double")


def held_out_fold(column):
    """crc32 of the id as text, modulo 5, is 0; rows without an id are held out, too."""
    return F.coalesce(F.crc32(column.cast("string")) % 5 == 0, F.lit(True))


def classify(docs: DataFrame, labels: DataFrame, held_out=held_out_fold, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score and predicted."""
    weights, bias = fit(docs, labels, held_out, id_col, **options)
    text_col = options.get("text_col", "text")
    scored = with_scores(docs, weights, bias, id_col, text_col)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
