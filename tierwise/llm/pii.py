"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Seeds: e-mail addresses, IPv4 addresses, card numbers and phone numbers by
pattern, leftmost and non-overlapping per kind, those that fail their check
(parts over 255, Luhn, digit counts) dropped without another try.

The patterns are written with possessive quantifiers and a look-behind where
that finds the same matches, so no text makes them run in more than linear
time or deep recursion.

Bootstrapping: a candidate is what no seed covers and could be personal data in
another form: a digit run of ``MIN_DIGITS`` digits or more, with or without plus
and inner marks; four numbers between dots, also bracketed or spelled ones; an
e-mail address with its at sign or dots bracketed, spelled or spaced, with letters
of any script, or without a dot. A candidate's form and digit count say which
kinds it can be (``FITS``), not the seeds' own shapes; its contexts decide. A lexical
pattern is a kind of word pair: the word before, or the word after, folded to
lower case. Pattern and instance form a graph over all documents; in each of
``rounds`` rounds a pattern's score is the lower confidence bound (Wilson's, at
``SIGMAS`` standard errors) of the mean confidence of its distinct instances
(seeds of its kind 1, the rest what they have so far). It takes the pattern's own
instances only, so neither the corpus's size nor another pattern moves it. A
candidate's confidence in a kind it can be is that of its best pattern. Patterns
with ``min_seeds`` distinct seeds are scored; from the second round on, candidates
found with a confidence of ``threshold`` count as seeds, so they induce patterns that
no seed stands in. Patterns of that score are trusted, and candidates they find
that can be of their kind are added as spans of it. Counts are aggregates over all
documents; trusted patterns are joined, and broadcast only by Spark's own
measure of their size.

Null and empty texts have no spans. Rows of one id are scanned each for itself.
Extra columns are not read. An empty table gives no rows. Offsets count code
points, ends are exclusive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import store
from .spans import chunks_sql, cut_sql, located_sql, quoted

KINDS = ("email", "ip", "card", "phone")
MIN_DIGITS = 7
# So five instances, all seeds, score 5/6: a reliable pattern passes from about min_seeds on.
SIGMAS = 1.0
_LOCAL = r"A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A cheap test that a text can hold the kind at all.
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
# A dot as written to hide it, and four numbers between dots, the last of them no more.
_DOT = r"(?:\.|\x20?[\[({<]\x20?(?:\.|(?i:dot))\x20?[\])}>]\x20?|\x20(?i:dot)\x20)"
_QUAD = rf"[0-9]++(?:{_DOT}[0-9]++){{3}}"
CANDIDATE = (
    rf"(?<![A-Za-z0-9])(?<![0-9]\.){_QUAD}(?![A-Za-z0-9]|\.[0-9])"
    r"|(?<![A-Za-z0-9])\+?(?:\((?=[0-9]{1,5}\)))?[0-9](?:[ .()/-]{0,2}[0-9])++(?![A-Za-z0-9])"
)
# An at sign in brackets, spaced or of full width before any domain, or the bare word before one whose dots are hidden, too.
_NAME = r"[\p{L}\p{M}\p{N}_%+-]"
MAIL_CANDIDATE = (
    rf"(?<![\p{{L}}\p{{M}}\p{{N}}._%+-])[\p{{L}}\p{{M}}\p{{N}}._%+-]++"
    rf"(?:(?:\x20?[\[({{<]\x20?(?:@|(?i:at))\x20?[\])}}>]\x20?|\x20?[@\uFF20]\x20?){_NAME}++(?:{_DOT}{_NAME}++)*+"
    rf"|\x20(?i:at)\x20{_NAME}++(?:(?!\.){_DOT}{_NAME}++)++)"
)
MAIL_HINT = r"[@\uFF20]|(?i)[\[({<]\x20?at\x20?[\])}>]|(?i)\x20dot\x20|(?i)[\[({<]\x20?(?:\.|dot)\x20?[\])}>]"


def _digits(value: str) -> str:
    return f"regexp_replace({value}, '[^0-9]', '')"


# Luhn: from the right, every second digit doubled, digits summed.
_LUHN = (
    "aggregate(sequence(1, length({d})), 0, (s, i) -> s + CASE WHEN i % 2 = 1 THEN int(substr({d}, -i, 1)) "
    "ELSE int(substr({d}, -i, 1)) * 2 - IF(int(substr({d}, -i, 1)) > 4, 9, 0) END) % 10 = 0"
)
VALID = {
    "email": "true",
    "ip": "forall(split({m}, '[.]'), p -> length(ltrim('0', p)) <= 3 AND try_cast(concat('0', ltrim('0', p)) AS int) <= 255)",
    "card": f"length({_digits('{m}')}) BETWEEN 12 AND 19 AND (" + _LUHN.format(d=_digits("{m}")) + ")",
    "phone": f"length({_digits('{m}')}) BETWEEN 9 AND 15",
}
# What a candidate {m} other than a mail address can be; national phone numbers go without their first digits.
FITS = {
    "ip": "{m} RLIKE {quad}",
    "card": f"length({_digits('{m}')}) BETWEEN 12 AND 19",
    "phone": f"length({_digits('{m}')}) BETWEEN {MIN_DIGITS} AND 15",
}


def spans_sql(text: str, pattern: str, valid: str) -> str:
    """SQL for the valid matches of ``pattern`` in column ``text``, as structs (s, e, m); invalid
    ones leave no entry and are not tried again."""
    return f"transform(filter({located_sql(text, pattern)}, x -> {valid.format(m='x.m')}), x -> struct(x.s AS s, x.e AS e, x.m AS m))"


def base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``base``: array of (s, e, k, m), k the kind's place, ordered by start, then kind."""
    none = "CAST(array() AS array<struct<s:int,e:int,m:string>>)"
    columns = {}
    for kind in KINDS:
        pattern = quoted(PATTERNS[kind])
        hint = f"contains({text}, '{HINTS[kind]}')" if HINTS[kind] else "true"
        if kind != "email":
            hint += f" AND {text} RLIKE '[0-9]'"
        columns["__" + kind] = F.expr(f"CASE WHEN {hint} THEN {spans_sql(text, pattern, VALID[kind])} ELSE {none} END")
    parts = ", ".join(f"transform(__{kind}, x -> struct(x.s AS s, {k} AS k, x.e AS e, x.m AS m))" for k, kind in enumerate(KINDS))
    return docs.withColumns(columns).withColumn("base", F.expr(f"array_sort(concat({parts}))")).drop(*columns)


_LEFT = r"([\\p{L}]+)[^\\p{L}]*$"
_RIGHT = r"^[^\\p{L}]*([\\p{L}]+)"


def instances(scanned: DataFrame) -> DataFrame:
    """Seeds and candidates with their words: one row per occurrence in distinct texts
    (key, s, e, value, kind or null, fits, before, after), fits the kinds a candidate can be.
    Candidates that overlap a seed, and numbers that overlap a mail candidate, are left out:
    by the greatest end before and the least start behind them, over a text's rows in order."""
    hint = quoted(MAIL_HINT)
    holders = scanned.where(f"size(base) > 0 OR text RLIKE '[0-9]' OR text RLIKE {hint}")
    quad = quoted(f"^{_QUAD}$")
    none = "CAST(array() AS array<struct<s:int,e:int,m:string>>)"
    mails = f"CASE WHEN text RLIKE {hint} THEN {spans_sql('text', quoted(MAIL_CANDIDATE), 'true')} ELSE {none} END"
    numbers = spans_sql("text", quoted(CANDIDATE), f"(length({_digits('{m}')}) >= {MIN_DIGITS} OR {{m}} RLIKE {quad.replace('{', '{{').replace('}', '}}')})")
    numbers = f"CASE WHEN text RLIKE '[0-9]' THEN {numbers} ELSE {none} END"
    kinds = ", ".join(f"IF({sql.format(m='c.m', quad=quad)}, {KINDS.index(kind)}, NULL)" for kind, sql in FITS.items())
    no_kind = "CAST(NULL AS int)"
    spans = f"""
      concat(transform(base, b -> struct(b.s AS s, b.e AS e, b.m AS m, b.k AS k, CAST(array() AS array<int>) AS fits, 0 AS rank)),
             transform(mails, c -> struct(c.s AS s, c.e AS e, c.m AS m, {no_kind} AS k, array({KINDS.index('email')}) AS fits, 1 AS rank)),
             transform(numbers, c -> struct(c.s AS s, c.e AS e, c.m AS m, {no_kind} AS k, array_compact(array({kinds})) AS fits, 2 AS rank)))"""
    before, after = cut_sql("chunks", "greatest(0, c.s - 64)", "least(64, c.s)"), cut_sql("chunks", "c.e", "64")
    placed = holders.select("key", F.expr(mails).alias("mails"), F.expr(numbers).alias("numbers"), "base", "text").withColumn(
        "spans", F.expr(spans)
    ).where("size(spans) > 0").withColumn("chunks", F.expr(chunks_sql("text")))
    worded = f"""transform(spans, c -> struct(c.s AS s, c.e AS e, c.m AS m, c.k AS k, c.fits AS fits, c.rank AS rank,
      lower(regexp_extract({before}, '{_LEFT}', 1)) AS before, lower(regexp_extract({after}, '{_RIGHT}', 1)) AS after))"""
    # Equal rows have equal spans: one of each is enough for the graph and for what is added.
    rows = placed.select("key", F.explode(F.expr(worded)).alias("x")).select("key", "x.*").distinct()
    up_to = Window.partitionBy("key").orderBy("s").rangeBetween(Window.unboundedPreceding, 0)
    # From the end: a frame that shrinks with every row would be summed anew for each.
    from_here = Window.partitionBy("key").orderBy(F.col("s").desc()).rangeBetween(Window.unboundedPreceding, 0)

    def overlapped(which):
        ends, starts = F.max(F.when(which, F.col("e"))).over(up_to), F.min(F.when(which, F.col("s"))).over(from_here)
        return F.coalesce(ends > F.col("s"), F.lit(False)) | F.coalesce(starts < F.col("e"), F.lit(False))

    rows = rows.withColumn("hit", (F.col("rank") > 0) & overlapped(F.col("rank") == 0)).where("NOT hit")
    rows = rows.withColumn("hit", (F.col("rank") > 1) & overlapped(F.col("rank") == 1)).where("NOT hit")
    return rows.select("key", "s", "e", F.col("m").alias("value"), F.col("k").alias("kind"), "fits", "before", "after")


def trusted_patterns(found: DataFrame, rounds: int, min_seeds: int, threshold: float) -> DataFrame:
    """(side, word, kind): patterns whose score over the pattern-instance graph is high enough."""
    spark = found.sparkSession
    words = F.explode(F.array(F.struct(F.lit("before").alias("side"), F.col("before").alias("word")), F.struct(F.lit("after").alias("side"), F.col("after").alias("word"))))
    edges = found.select("value", "kind", "fits", words.alias("p")).select("value", "kind", "fits", "p.side", "p.word").where("word != ''").distinct()
    edges = store(spark, edges, "pii-graph")
    seeds = edges.where("kind IS NOT NULL").select("side", "word", F.col("kind").alias("of"), "value")
    unseen = edges.where("kind IS NULL").select("side", "word", F.explode("fits").alias("of"), "value")
    belief, scores, z2 = None, None, f"{SIGMAS * SIGMAS}D"
    for _ in range(rounds):
        # What a pattern can bring in: kinds of which it has seeds, or identifiers found by now.
        known = seeds if belief is None else seeds.unionByName(unseen.join(belief.where(F.col("confidence") >= threshold), ["of", "value"], "left_semi").select(*seeds.columns))
        patterns = known.groupBy("side", "word", "of").agg(F.countDistinct("value").alias("n")).where(F.col("n") >= min_seeds)
        patterns = store(spark, patterns.select("side", "word", "of"), "pii-patterns")
        around = edges.join(patterns, ["side", "word"]).select(
            "side", "word", "of", "value", F.coalesce(F.col("kind") == F.col("of"), F.lit(False)).alias("seed"),
            F.col("kind").isNull().alias("unseen"), F.expr("array_contains(fits, of)").alias("fits"),
        )
        around = store(spark, around, "pii-around")
        judged = around.withColumn("confidence", F.lit(0.0)) if belief is None else around.join(belief, ["of", "value"], "left")
        sure = F.when(F.col("seed"), 1.0).when(F.col("unseen"), F.coalesce(F.col("confidence"), F.lit(0.0))).otherwise(0.0)
        per_value = judged.groupBy("side", "word", "of", "value").agg(F.max(sure).alias("sure"))
        scores = per_value.groupBy("side", "word", "of").agg(F.avg("sure").alias("p"), F.count("*").alias("n")).selectExpr(
            "side", "word", "of", f"(p + {z2} / (2 * n) - {SIGMAS}D * sqrt(p * (1 - p) / n + {z2} / (4 * n * n))) / (1 + {z2} / n) AS score"
        )
        scores = store(spark, scores, "pii-scores")
        belief = store(
            spark,
            around.where("unseen AND fits").join(scores, ["side", "word", "of"]).groupBy("of", "value").agg(F.max("score").alias("confidence")),
            "pii-belief",
        )
    return scores.where(F.col("score") >= threshold).select("side", "word", F.col("of").alias("kind"))


def find_personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 3, min_seeds: int = 5, threshold: float = 0.8
) -> DataFrame:
    """One row per row of ``docs``: doc_id, base (seed spans) and spans (all spans),
    arrays of (s, k, e, m) ordered by start, then kind."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    # Equal rows share a key and get equal spans; the second hash tells null ids apart.
    scanned = base_spans(plain.withColumn("key", F.struct("doc_id", F.xxhash64("text").alias("h"), F.hash("text").alias("g"))))
    found = store(spark, instances(scanned), "pii-instances")
    trusted = trusted_patterns(found.drop("key", "s", "e"), rounds, min_seeds, threshold)
    unseen = found.where("kind IS NULL").withColumn("kind", F.explode("fits"))
    by_side = [
        unseen.withColumn("word", F.col(side)).join(trusted.where(F.col("side") == side), ["word", "kind"]).select("key", "s", "kind", "e", "value")
        for side in ("before", "after")
    ]
    added = by_side[0].unionByName(by_side[1]).distinct().groupBy("key").agg(
        F.collect_list(F.struct("s", F.col("kind").alias("k"), "e", F.col("value").alias("m"))).alias("added")
    )
    added = added.selectExpr("key.doc_id AS a_id", "key.h AS a_h", "key.g AS a_g", "added")
    spanned = scanned.select("doc_id", "key.h", "key.g", "base")
    joined = spanned.join(added, spanned["doc_id"].eqNullSafe(added["a_id"]) & (spanned["h"] == added["a_h"]) & (spanned["g"] == added["a_g"]), "left")
    return joined.select("doc_id", "base", F.expr("array_sort(concat(base, coalesce(added, slice(base, 1, 0))))").alias("spans"))


def _listed(column: str) -> str:
    names = "element_at(array(" + ", ".join(f"'{k}'" for k in KINDS) + "), x.k + 1)"
    return f"array_join(transform({column}, x -> concat_ws(':', {names}, x.s, x.e)), ',')"


def digest(found: DataFrame) -> DataFrame:
    """Counts per kind, the base spans' SHA-256 and all spans as text."""
    counts = [F.expr(f"CAST(size(filter(base, x -> x.k = {k})) AS long)").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.expr(f"sha2({_listed('base')}, 256)").alias("base_sha256"), F.expr(_listed("spans")).alias("spans"))
