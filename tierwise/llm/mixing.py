"""Mixing sources to target weights: how often each document is emitted.

1. A scan counts each document's words and keeps a narrow row (id, source, size,
   draw); everything after it reads those rows, never a text.
2. Sizes are summed per source. Sources are numbered in code point order, null
   last, and weigh ``weights`` in turn. They share all words by weight; a target
   stops at ``max_repeats`` times its source's size and the excess is shared by
   weight among the others, again until none is above. A round is one aggregate
   of the source table: the words of the sources that stop (C) and the weight of
   the rest (W) give the share (total - C) / W, which never falls, so the sources
   that stop only grow in number and the rounds end. Comparisons are exact.
3. rate = target / size. A document is emitted floor(rate) times, and once more if
   its draw, a number in [0, 1) from a hash of seed, id and text, is below the
   rest. Rates are at most ``max_repeats``, so no document exceeds that.

Draws depend on the row alone, so reruns and rerun tasks agree. Rows that are equal
in id and text share a draw; rows that share only an id, or have none, do not.
Null and empty texts have size 0 and are taken 0 words. A null source is a source.
Extra columns are not read by ``plan`` and are kept by ``mix``. An empty table
gives no rows. Source rows are joined by broadcast behind a size check, else
with hot sources salted.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import enrich
from ..operators.numbering import running_sum
from ..session import store

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
SEED = 20_240_611
WORD = r"[^\x20\x09-\x0D]+"
_DIGITS = 13  # hexadecimal digits of a draw: 52 bits, exact in a double


def draw(id_col: Column, text: Column, seed: int) -> Column:
    """A number in [0, 1) from the MD5 of seed, id and text."""
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(id_col.cast("string"), F.lit("")), F.md5(text))
    return F.conv(F.substring(F.md5(key), 1, _DIGITS), 16, 10).cast("long") / F.lit(float(16**_DIGITS))


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``sources`` (source, source_size) with weight and target."""
    ordered = running_sum(sources, [F.col("source").isNull(), "source"], F.lit(1), "number")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    weighed = store(sources.sparkSession, ordered.select("source", "source_size", weight.cast("long").alias("weight")), "mix-sources")
    total = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    stopped, rest, share_weight = -1, total, 1
    exact = lambda c: c.cast("decimal(19,0)")
    while True:
        # Stops where max_repeats * size <= weight * rest / share_weight.
        stops = exact(max_repeats * F.col("source_size")) * F.lit(share_weight).cast("decimal(19,0)") <= exact(F.col("weight")) * F.lit(rest).cast("decimal(19,0)")
        if stopped < 0:
            stops = F.lit(False)
        row = weighed.agg(
            F.count_if(stops).alias("n"), F.coalesce(F.sum(F.when(stops, max_repeats * F.col("source_size"))), F.lit(0)).alias("c"),
            F.coalesce(F.sum(F.when(~stops, F.col("weight"))), F.lit(0)).alias("w"),
        ).first()
        if row["n"] == stopped or not row["w"]:
            break
        stopped, rest, share_weight = row["n"], total - row["c"], row["w"]
    share = (F.col("weight") * F.lit(rest)).cast("double") / F.lit(float(share_weight))
    return weighed.withColumn("target", F.when(stops, (max_repeats * F.col("source_size")).cast("double")).otherwise(share))


def plan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: int = SEED,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target (its
    source's), copies and taken (size times copies)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    narrow = store(
        spark,
        docs.select(
            F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), draw(F.col(id_col), text, seed).alias("draw"),
        ),
        "mix-sizes",
    )
    per_source = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    wanted = targets(per_source, weights, max_repeats).drop("weight")
    joined = enrich(narrow, wanted, "source", null_safe=True, salt=16, hot_fraction=0.01)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    copies = F.floor(rate) + F.when(F.col("draw") < rate - F.floor(rate), 1).otherwise(0)
    return joined.select("doc_id", "source", "size", "source_size", "target", copies.cast("long").alias("copies")).withColumn(
        "taken", F.col("size") * F.col("copies")
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """``docs`` with every row as often as ``plan`` takes it."""
    rates = plan(docs, id_col, text_col, source_col, **options).where("source_size > 0").select(
        "source", (F.col("target") / F.col("source_size")).alias("rate")
    ).distinct()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    names = {n: n for n in ("__source", "__draw")}
    for n in names:
        while names[n] in docs.columns:
            names[n] = "_" + names[n]
    seed = options.get("seed", SEED)
    rows = docs.select("*", F.col(source_col).cast("string").alias(names["__source"]), draw(F.col(id_col), text, seed).alias(names["__draw"]))
    rate_col = names["__source"] + "_rate"
    wanted = rates.select(F.col("source").alias(names["__source"]), F.col("rate").alias(rate_col))
    joined = enrich(rows, wanted, names["__source"], how="left", null_safe=True, salt=16, hot_fraction=0.01)
    rate = F.when(F.regexp_count(text, F.lit(WORD)) > 0, F.col(rate_col)).otherwise(0.0)
    copies = (F.floor(rate) + F.when(F.col(names["__draw"]) < rate - F.floor(rate), 1).otherwise(0)).cast("int")
    return joined.where(copies > 0).select(*[F.col(c) for c in docs.columns], F.explode(F.array_repeat(F.lit(1), copies)).alias(names["__draw"] + "_n")).select(*docs.columns)


ORACLE_SQL = f"""
WITH sizes AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         CAST(CAST('0x' || substr(md5(concat_ws(':', '{SEED}', coalesce(CAST(doc_id AS VARCHAR), ''), md5(coalesce(text, '')))), 1, {_DIGITS}) AS BIGINT) AS DOUBLE)
           / {float(16**_DIGITS)!r} AS draw
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM sizes GROUP BY source
), ordered AS (
  SELECT *, sum(source_size) OVER () AS total,
         coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c,
         sum(weight) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w
  FROM sources
), level AS (
  SELECT min_by(total - c, w * -1) AS rest, max(w) AS w
  FROM ordered WHERE CAST(3 * source_size AS HUGEINT) * w > CAST(weight AS HUGEINT) * (total - c)
), wanted AS (
  SELECT source, source_size,
         CASE WHEN w IS NULL OR CAST(3 * source_size AS HUGEINT) * w <= CAST(weight AS HUGEINT) * rest THEN CAST(3 * source_size AS DOUBLE)
              ELSE CAST(weight * rest AS DOUBLE) / CAST(w AS DOUBLE) END AS target
  FROM sources, level
), rated AS (
  SELECT doc_id, size, source_size, target, draw, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
  FROM sizes s JOIN wanted t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rated
"""
