"""Registered queries over the driver's tables.

Every query reads whole tables (see ``plans.invoices`` for the mapping onto
the invoice model). Five queries are about keys a dictionary lacks and join a
part of ``supplier``; every other one joins all of it. ``plans.oracles`` holds,
per query, the independent SQL statement it is checked against. Most queries
return a lazy plan; those that write files or tables first, check a broadcast's
size or count hot keys run jobs when called, and write below the session's
shared checkpoint folder, from where the files go when the application ends.
"""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import sinks
from ..functions.metrics import INVOICE_STATUSES, count_rows, invoice_metrics, max_of, sum_if, sum_of
from ..operators import combine, fanout, joins, lattice, quality, reshape, reuse, totals
from ..schemas import INVOICE, all_strings
from ..session import drop_at_exit, scratch_path
from ..sources import files, tables, warehouse
from . import invoices as inv
from . import report
from .pipeline import ENTITY_METRICS, Pipeline, entity_summary

DIMS = list(inv.DIMS)


def enriched(spark: SparkSession, sf_dir: str, **join_options) -> DataFrame:
    return joins.enrich(inv.invoices(spark, sf_dir), inv.tiers(spark, sf_dir), "counter_party", **join_options)


def partly_enriched(spark: SparkSession, sf_dir: str, **join_options) -> DataFrame:
    """Invoices whose counter party the partial dictionary knows."""
    return joins.enrich(inv.invoices(spark, sf_dir), inv.partial_tiers(spark, sf_dir), "counter_party", **join_options)


def written(spark: SparkSession, path: str) -> str:
    """``path``, now that it holds files: they go when the application ends."""
    drop_at_exit(spark, path)
    return path


# --- enrichment -------------------------------------------------------------


def enrich_inner(spark, sf_dir):
    return partly_enriched(spark, sf_dir)


def enrich_broadcast(spark, sf_dir):
    return partly_enriched(spark, sf_dir, broadcast=True)


# Fixed value: the share of all fact rows that makes a join key hot.
HOT_FRACTION = 0.001


def enrich_salted(spark, sf_dir):
    # The dictionary is broadcast while it passes the size check; beyond that, a
    # key holding 0.1% of the fact rows or more is salted.
    return partly_enriched(spark, sf_dir, salt=8, hot_fraction=HOT_FRACTION)


def enrich_lookup_dedup(spark, sf_dir):
    dictionary = inv.suppliers_by_nation(spark, sf_dir).select(
        "nationkey", "suppkey", F.col("name").alias("supplier_name")
    )
    return joins.lookup(inv.customers(spark, sf_dir), dictionary, "nationkey", order_by="suppkey")


def enrich_first_match(spark, sf_dir):
    return joins.merge_right_wins(
        inv.customers(spark, sf_dir), inv.suppliers_by_nation(spark, sf_dir), "nationkey", order_by="suppkey"
    )


# The line number whose counter party is blanked, and the tier of
# the dictionary's unknown member (the row with a null key).
NULL_KEY_LINE = 7
UNKNOWN_TIER = -1


def enrich_null_safe(spark, sf_dir):
    fact = inv.invoices(spark, sf_dir).withColumn(
        "counter_party", F.when(F.col("rating") != NULL_KEY_LINE, F.col("counter_party"))
    )
    unknown = spark.range(1).select(
        F.lit(None).cast("bigint").alias("counter_party"), F.lit(UNKNOWN_TIER).cast("bigint").alias("tier")
    )
    dictionary = inv.partial_tiers(spark, sf_dir).unionByName(unknown)
    # The null key holds a seventh of the fact: salted where the dictionary is too large to broadcast.
    return joins.enrich(fact, dictionary, "counter_party", null_safe=True, salt=8, hot_fraction=HOT_FRACTION)


def key_in_dictionary(spark, sf_dir):
    return joins.keys_in_dictionary(inv.invoices(spark, sf_dir), inv.partial_tiers(spark, sf_dir), "counter_party")


def key_in_dictionary_filtered(spark, sf_dir):
    """The same by a shuffle join, as for a dictionary too large to broadcast: a Bloom filter of
    its keys keeps nearly all other invoices out of the shuffle."""
    dictionary = inv.partial_tiers(spark, sf_dir).hint("merge")
    return joins.keys_in_dictionary(inv.invoices(spark, sf_dir), dictionary, "counter_party", broadcast=False, bloom=True)


# --- metrics at one level ---------------------------------------------------


def joined_level(spark, sf_dir, keys, metrics):
    """One grouping level of invoices enriched by tiers, aggregated before the join."""
    return totals.group_over_join(inv.invoices(spark, sf_dir), inv.tiers(spark, sf_dir), "counter_party", keys, metrics)


def metrics_by_one_key(spark, sf_dir):
    return joined_level(spark, sf_dir, ["legal_entity"], invoice_metrics())


def metrics_by_two_keys(spark, sf_dir):
    return joined_level(spark, sf_dir, ["legal_entity", "counter_party"], invoice_metrics())


def metrics_by_three_keys(spark, sf_dir):
    return joined_level(spark, sf_dir, DIMS, invoice_metrics())


def entity_summary_query(spark, sf_dir):
    return joined_level(spark, sf_dir, ["legal_entity", "counter_party"], ENTITY_METRICS)


def value_variance(spark, sf_dir):
    """A user-defined combiner: the variance of values by mergeable second moments."""
    moments = combine.combine_by(inv.invoices(spark, sf_dir), ["legal_entity", "rating"], ["value"], combine.second_moment(), "variance")
    return moments.withColumn("variance", F.round("variance", 4))


def keyed_fan_out(spark, sf_dir):
    """Every joined invoice sent to each of its six keys by a generator, and totalled per key."""
    rows = enriched(spark, sf_dir)
    keyed = fanout.fan_out(rows, fanout.keyed_levels, "level string, key string", DIMS, keep=["rating", "value"])
    return keyed.groupBy("level", "key").agg(F.count(F.lit(1)).alias("n_rows"), F.max("rating").alias("max_rating"), F.sum("value").alias("sum_value"))


# --- multi-level totals -----------------------------------------------------


def joined_totals(spark, sf_dir, sets, label, fact=None, metrics=None, **options):
    """Totals of invoices enriched by tiers, aggregated before the join."""
    fact = inv.invoices(spark, sf_dir) if fact is None else fact
    metrics = invoice_metrics() if metrics is None else metrics
    tiers = inv.tiers(spark, sf_dir)
    return totals.totals_over_join(fact, tiers, "counter_party", DIMS, metrics, sets, label, **options)


def totals_count_label(spark, sf_dir):
    return joined_totals(spark, sf_dir, "pairs", "count")


def totals_singles(spark, sf_dir):
    return joined_totals(spark, sf_dir, "singles", "count")


def totals_cube_label(spark, sf_dir):
    return joined_totals(spark, sf_dir, "cube", "total")


def totals_rollup_label(spark, sf_dir):
    return joined_totals(spark, sf_dir, "rollup", "total")


def totals_by_status(spark, sf_dir):
    # Filtered on the stored flag, so the scan prunes.
    fact = inv.invoices(spark, sf_dir, statuses=INVOICE_STATUSES)
    metrics = [count_rows("n_rows"), max_of("rating", "max_rating"), sum_of("value", "sum_value")]
    return joined_totals(
        spark, sf_dir, "pairs", "null", fact=fact, metrics=metrics, keys=["status"], grouping_id="grouping_id"
    )


def _invoices_with_null_entity(spark, sf_dir):
    # Line 7 loses its legal entity, so null data values meet rolled-up rows.
    return inv.invoices(spark, sf_dir).withColumn(
        "legal_entity", F.when(F.col("rating") != NULL_KEY_LINE, F.col("legal_entity"))
    )


def totals_null_dims_cube(spark, sf_dir):
    """Total-labelled cube where some dimension values are null: a null value
    stays null, only rolled-up columns read Total, and grouping_id tells them apart."""
    fact = _invoices_with_null_entity(spark, sf_dir)
    return joined_totals(spark, sf_dir, "cube", "total", fact=fact, grouping_id="grouping_id")


def totals_null_dims_count(spark, sf_dir):
    """Count-labelled six sets where some dimension values are null: the
    labels count non-null values only."""
    return joined_totals(spark, sf_dir, "pairs", "count", fact=_invoices_with_null_entity(spark, sf_dir))


# Fixed value: the rating that splits invoices into two arriving batches.
BATCH_SPLIT_RATING = 3


def totals_from_batches(spark, sf_dir):
    """The Total-labelled cube maintained incrementally: invoices arrive in two
    complementary batches (every row in exactly one); each batch's partial rows
    are appended to the other's, compacted, and rolled up."""
    fact, tiers = inv.invoices(spark, sf_dir), inv.tiers(spark, sf_dir)
    metrics = invoice_metrics()
    later = F.col("rating") > BATCH_SPLIT_RATING
    batches = [fact.filter(F.col("rating") <= BATCH_SPLIT_RATING), fact.filter(later | F.col("rating").isNull())]
    stored = None
    for batch in batches:
        part = totals.partial_totals(batch, tiers, "counter_party", DIMS, metrics)
        stored = part if stored is None else stored.unionByName(part)
    return totals.totals_from_partials(totals.compact_partials(stored, metrics), DIMS, metrics, "cube", "total")


# The rating bounds that split invoices into arrivals (every row
# falls in exactly one).
ARRIVAL_BOUNDS = (2, 4, 6)


def _arrivals(rating):
    lows = (None,) + ARRIVAL_BOUNDS
    highs = ARRIVAL_BOUNDS + (None,)
    out = []
    for lo, hi in zip(lows, highs):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (rating > lo)
        if hi is not None:
            cond = cond & (rating <= hi)
        out.append(cond if hi is not None else cond | rating.isNull())
    return out


def totals_streamed(spark, sf_dir):
    """The Total-labelled cube kept by a stream: invoices arrive as files in a
    folder in four arrivals; after each one the stream runs on the same
    checkpoint and turns only the new files into stored partial rows; the
    totals are rolled up from the stored table."""
    from ..streaming import read_partials, stream_partials

    incoming = scratch_path(spark, "incoming-invoices")
    partials_path = scratch_path(spark, "streamed-partials")
    invoices, tiers, metrics = inv.invoices(spark, sf_dir), inv.tiers(spark, sf_dir), invoice_metrics()
    for arrival in _arrivals(F.col("rating")):
        # Each arrival keeps the input's partitioning: no task holds more than its split.
        invoices.filter(arrival).write.mode("append").option("header", True).csv(incoming)
        facts = spark.readStream.schema(invoices.schema).option("header", True).csv(incoming)
        query = stream_partials(
            facts, tiers, "counter_party", DIMS, metrics, partials_path, available_now=True
        )
        query.awaitTermination()  # raises if the stream failed
    for path in (incoming, partials_path):
        drop_at_exit(spark, path)
    return totals.totals_from_partials(read_partials(spark, partials_path), DIMS, metrics, "cube", "total")


def totals_after_join(spark, sf_dir):
    """The same cube aggregated after the join: one Expand over enriched rows."""
    return totals.totals(enriched(spark, sf_dir), DIMS, invoice_metrics(), sets="cube", label="total")


def totals_union_form(spark, sf_dir):
    return totals.totals_union(enriched(spark, sf_dir), DIMS, invoice_metrics(), sets="pairs", label="count")


def totals_preaggregated(spark, sf_dir):
    rows = enriched(spark, sf_dir)
    return totals.totals(rows, DIMS, invoice_metrics(), sets="cube", label="total", preaggregate=True)


def totals_sql(spark, sf_dir):
    """The six-set totals written in Spark SQL over temporary views of the
    invoice and tier frames; Catalyst plans it like the DataFrame form."""
    tables.register_views(tw_invoices=inv.invoices(spark, sf_dir), tw_tiers=inv.tiers(spark, sf_dir))
    return spark.sql(_TOTALS_SQL_SPARK)


# Spark SQL over the views; the aggregate before the join is written as a
# subquery, so the plan matches totals_over_join.
_TOTALS_SQL_SPARK = """
SELECT CASE WHEN grouping(legal_entity) = 1 THEN CAST(coalesce(sum(CASE WHEN legal_entity IS NOT NULL THEN n END), 0) AS STRING)
            ELSE legal_entity END AS legal_entity,
       CASE WHEN grouping(counter_party) = 1 THEN CAST(coalesce(sum(CASE WHEN counter_party IS NOT NULL THEN n END), 0) AS STRING)
            ELSE CAST(counter_party AS STRING) END AS counter_party,
       CASE WHEN grouping(tier) = 1 THEN CAST(coalesce(sum(CASE WHEN tier IS NOT NULL THEN n END), 0) AS STRING)
            ELSE CAST(tier AS STRING) END AS tier,
       max(max_rating) AS max_rating,
       coalesce(sum(arap), 0) AS sum_value_ARAP,
       coalesce(sum(accr), 0) AS sum_value_ACCR
FROM (
  SELECT p.legal_entity, p.counter_party, t.tier, p.n, p.max_rating, p.arap, p.accr
  FROM (
    SELECT legal_entity, counter_party, count(1) AS n, max(rating) AS max_rating,
           sum(CASE WHEN status = 'ARAP' THEN value END) AS arap,
           sum(CASE WHEN status = 'ACCR' THEN value END) AS accr
    FROM tw_invoices GROUP BY legal_entity, counter_party
  ) p JOIN tw_tiers t ON p.counter_party = t.counter_party
)
GROUP BY GROUPING SETS ((legal_entity), (legal_entity, counter_party), (legal_entity, tier),
                        (counter_party), (counter_party, tier), (tier))
"""


# --- validation ---------------------------------------------------------------

REJECT_KEYS = ["invoice_id", "counter_party", "rating"]


def validate_rows(spark, sf_dir):
    checked = quality.validate(inv.invoice_text(spark, sf_dir), INVOICE)
    return quality.invalid_rows(checked, REJECT_KEYS)


def validate_missing_column(spark, sf_dir):
    """Invoice text without its rating column: every row is invalid, and the
    missing column is the first reason."""
    checked = quality.validate(inv.invoice_text(spark, sf_dir).drop("rating"), INVOICE)
    return quality.invalid_rows(checked, ["invoice_id", "counter_party"])


def reject_reasons(spark, sf_dir):
    checked = quality.validate(inv.invoice_text(spark, sf_dir), INVOICE)
    return quality.rejects(checked, REJECT_KEYS)


def validated_totals(spark, sf_dir):
    """Validation, enrichment and totals as one plan: invalid text rows are
    left out, valid ones typed, then the Total-labelled cube."""
    checked = quality.validate(inv.invoice_text(spark, sf_dir), INVOICE)
    valid = quality.valid_rows(checked, INVOICE)
    dictionary = inv.tiers(spark, sf_dir).withColumn("counter_party", F.col("counter_party").cast("string"))
    return totals.totals_over_join(valid, dictionary, "counter_party", DIMS, invoice_metrics(), "cube", "total")


# What the derived over-long records carry beyond their six fields:
# lines numbered 7 an empty seventh field, those numbered 5 three more fields.
EXTRA_EMPTY, EXTRA_FIELDS = ",", ",1,,junk"
LONG_LINES = {7: EXTRA_EMPTY, 5: EXTRA_FIELDS}


def _written_invoice_lines(spark, sf_dir) -> str:
    """Invoice text written by the CSV writer without a header, legal entities with
    a comma in them, and faults appended: lines of ``LONG_LINES`` are too long."""
    path = scratch_path(spark, "tolerant")
    text = inv.invoice_text(spark, sf_dir).withColumn("legal_entity", F.concat(F.col("legal_entity"), F.lit(", Inc")))
    line = F.to_csv(F.struct(*text.columns), {"nullValue": "", "emptyValue": ""})
    for rating, extra in LONG_LINES.items():
        line = F.when(F.col("rating") == rating, F.concat(line, F.lit(extra))).otherwise(line)
    sinks.write_lines(text.select(line.alias("value")), path)
    return written(spark, path)


def tolerant_read_rows(spark, sf_dir):
    read = files.read_csv_tolerant(spark, _written_invoice_lines(spark, sf_dir), INVOICE, header=False)
    good, _ = files.split_corrupt(read)
    return good


def tolerant_read_bad_lines(spark, sf_dir):
    read = files.read_csv_tolerant(spark, _written_invoice_lines(spark, sf_dir), INVOICE, header=False)
    _, bad = files.split_corrupt(read)
    return bad


# What the records with line breaks carry in their second field, and behind it in broken ones.
BREAK, QUOTED, BROKEN_LINE = "\n", '""Inc"", Ltd', 5


def _written_multiline(spark, sf_dir) -> str:
    """Invoice text without a header whose legal entities hold a line break, quotes and a
    separator; lines numbered 5 have text behind the closing quote, lines numbered 7 three more fields."""
    path = scratch_path(spark, "multiline")
    text = inv.invoice_text(spark, sf_dir)
    rating = F.col("rating").cast("int")
    behind = F.when(rating == BROKEN_LINE, "x").otherwise("")
    entity = F.concat(F.lit('"'), "legal_entity", F.lit(BREAK + QUOTED + '"'), behind)
    fields = [entity if c == "legal_entity" else F.coalesce(F.col(c), F.lit("")) for c in text.columns]
    line = F.concat(F.concat_ws(",", *fields), F.when(rating == 7, EXTRA_FIELDS).otherwise(""))
    sinks.write_lines(text.select(line.alias("value")), path)
    return written(spark, path)


def tolerant_multiline(spark, sf_dir):
    """Records over several lines, read by byte ranges: the well-formed ones."""
    return files.split_corrupt(files.read_csv_multiline(spark, _written_multiline(spark, sf_dir), INVOICE, header=False))[0]


def tolerant_multiline_bad(spark, sf_dir):
    """Of the same records those with broken quotes or too many fields, as they stand in the files."""
    read = files.read_csv_multiline(spark, _written_multiline(spark, sf_dir), INVOICE, header=False)
    return files.split_corrupt(read)[1].select("raw_line")


def flat_endless_line(spark, sf_dir):
    """Files of one endless line each: cells only, some quoted with the separator inside, read by byte ranges."""
    path = scratch_path(spark, "endless")
    rows = inv.invoices(spark, sf_dir)
    quoted = F.concat(F.lit('"'), "legal_entity", F.lit(', Inc"'))
    line = F.concat_ws(",", *[quoted if c == "legal_entity" else F.col(c).cast("string") for c in rows.columns])
    # Every record is followed by the cell separator, none by a line break.
    rows.select(line.alias("value")).write.option("lineSep", ",").text(path)
    return reshape.split_endless_line(spark, written(spark, path), INVOICE, header=False)[0]


def validate_positions(spark, sf_dir):
    """Invoice text written in order, read back and validated with 1-based
    positions: the invalid rows with the place they have in the files."""
    path = scratch_path(spark, "positions")
    text = inv.invoice_text(spark, sf_dir)
    order = [F.col(c).cast("bigint") for c in ("invoice_id", "rating", "counter_party")]
    text.orderBy(*order, "legal_entity", "status", "value").write.option("header", True).csv(path)
    read = files.read_csv(spark, written(spark, path), all_strings(INVOICE))
    checked = quality.validate(quality.with_position(read), INVOICE)
    return quality.invalid_rows(checked, ["position", "invoice_id", "rating"])


# --- reshaping, formatting, sinks, pipeline --------------------------------------


def flat_cell_reshape(spark, sf_dir):
    """Invoices written as header + ``\\r``-separated records, read back as rows."""
    path = scratch_path(spark, "flat-cells")
    rows = inv.invoices(spark, sf_dir).withColumn("counter_party", F.col("counter_party").cast("string"))
    rows.write.option("header", True).option("lineSep", "\r").csv(path)
    return reshape.read_flat_records(spark, written(spark, path), INVOICE)


# Fixed value: how many invoices one flat line holds.
RECORDS_PER_LINE = 5


def flat_line_chunks(spark, sf_dir):
    """Several invoices' cells on one line, records separated by ``\r``: each line is
    cut into cells and the cells into rows of six."""
    fields = ["invoice_id", "legal_entity", "counter_party", "rating", "status", "value"]
    record = F.concat_ws(",", *[F.col(c).cast("string") for c in fields])
    # Lines are made per invoice number and bucket, so none grows with the data.
    bucket = F.pmod(F.xxhash64(*fields), F.lit(RECORDS_PER_LINE))
    lines = inv.invoices(spark, sf_dir).groupBy("invoice_id", bucket.alias("bucket")).agg(
        F.concat_ws("\r", F.collect_list(record)).alias("text")
    )
    path = scratch_path(spark, "flat-lines")
    lines.select(F.concat(F.lit(",".join(fields) + "\r"), "text").alias("text")).write.parquet(path)
    stored = spark.read.parquet(written(spark, path))
    rows = reshape.records_from_cells(stored, "text", fields, skip=len(fields))
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in INVOICE.fields])


def rekeyed_rows(spark, sf_dir):
    """Invoices as (key, value) records, read back through both structs."""
    keyed = reshape.reshape_record(
        inv.invoices(spark, sf_dir), ["legal_entity", "counter_party"], ["rating", "status", "value"]
    )
    return keyed.select("key.legal_entity", "key.counter_party", "value.rating", "value.status", "value.value")


def format_rows(spark, sf_dir):
    """Per (legal_entity, counter_party): tier, max rating and the two status sums,
    printed as one line with eleven spaces between fields."""
    per_entity = joined_level(
        spark,
        sf_dir,
        ["legal_entity", "counter_party"],
        [
            max_of("tier", "tier"),
            max_of("rating", "max_rating"),
            sum_if("value", F.col("status") == "ARAP", "sum_of_ARAP"),
            sum_if("value", F.col("status") == "ACCR", "sum_of_ACCR"),
        ],
    )
    return sinks.format_lines(
        per_entity, ["legal_entity", "counter_party", "tier", "max_rating", "sum_of_ARAP", "sum_of_ACCR"]
    )


TOTALS_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in DIMS]
    + [T.StructField(c, T.LongType()) for c in ("max_rating", "sum_value_ARAP", "sum_value_ACCR")]
)


def sink_roundtrip_csv(spark, sf_dir):
    path = scratch_path(spark, "totals-csv")
    sinks.write_csv(totals_count_label(spark, sf_dir), path)
    return files.read_csv(spark, written(spark, path), TOTALS_SCHEMA)


def table_roundtrip(spark, sf_dir):
    """The Total-labelled cube saved through the table sink (a data-source
    format, default save mode) and read back through the table source."""
    path = scratch_path(spark, "totals-table")
    sinks.write_table(totals_cube_label(spark, sf_dir), path, format="parquet")
    return tables.read_table(spark, format="parquet", path=written(spark, path))


def joined_to_table(spark, sf_dir):
    """Every joined invoice written to a table, as the warehouse procedure does, and read back."""
    path = scratch_path(spark, "joined-table")
    sinks.write_table(enriched(spark, sf_dir), path, format="parquet")
    return tables.read_table(spark, format="parquet", path=written(spark, path))


def catalog_table(spark, sf_dir):
    """The joined invoices saved as a catalog table and read back by its name."""
    name = f"joined_{uuid.uuid4().hex[:12]}"
    sinks.write_table(enriched(spark, sf_dir), name)
    df = tables.read_table(spark, name)
    atexit.register(_drop_table, spark, name)
    return df


def _drop_table(spark, name):
    if spark.getActiveSession() is not None:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def csv_inferred_totals(spark, sf_dir):
    """Invoices written as CSV, scanned with inferred types, and totalled by tier."""
    path = scratch_path(spark, "inferred-csv")
    inv.invoices(spark, sf_dir).write.option("header", True).csv(path)
    fact = files.read_csv(spark, written(spark, path), infer=True)
    fact = fact.select(*[F.col(c).cast("bigint") if c in ("rating", "value") else F.col(c) for c in fact.columns])
    return joined_totals(spark, sf_dir, "cube", "total", fact=fact)


# Fixed value: about how many records a JSON array holds at most.
RECORDS_PER_ARRAY = 10_000


def pipeline_csv_json(spark, sf_dir):
    """The scripted pipeline: invoices from CSV, the dictionary from a JSON array
    of records, merged, summarised, and written as CSV."""
    base = scratch_path(spark, "csv-json")
    facts, dictionary, out = f"{base}/facts", f"{base}/dictionary", f"{base}/summary"
    sinks.write_csv(inv.invoices(spark, sf_dir), facts)
    tiers = inv.tiers(spark, sf_dir)
    # Each file is one JSON array. A tier's records are dealt into buckets whose number follows the
    # dictionary's size, so that no array, and no task that reads one, grows with it.
    buckets = 1 + tiers.count() // RECORDS_PER_ARRAY
    bucket = F.pmod(F.xxhash64("counter_party"), F.lit(buckets)).alias("bucket")
    records = tiers.groupBy(F.col("tier").alias("part"), bucket).agg(F.to_json(F.collect_list(F.struct("counter_party", "tier"))).alias("value"))
    records.write.partitionBy("part", "bucket").text(dictionary)
    written(spark, base)
    invoices = inv.invoices(spark, sf_dir).schema
    Pipeline(
        sources=[
            lambda: files.read_csv(spark, facts, invoices),
            lambda: files.read_json_records(spark, dictionary, tiers.schema, recursiveFileLookup=True),
        ],
        transformations=[entity_summary],
        sink=lambda df: sinks.write_csv(df, out),
    ).run(merge_on="counter_party")
    return files.read_csv(spark, out, ENTITY_SCHEMA)


ENTITY_SCHEMA = T.StructType([
    T.StructField("legal_entity", T.StringType()), T.StructField("counter_party", T.LongType()),
    T.StructField("count_rating", T.LongType()), T.StructField("max_tier", T.LongType()), T.StructField("sum_value", T.LongType()),
])


def enrich_strict(spark, sf_dir):
    """A merge that fails on a missing key: the whole dictionary has every key."""
    return enriched(spark, sf_dir, strict=True)


def cached_reuse(spark, sf_dir):
    """Two levels of totals from one input that is computed and stored once."""
    rows = reuse.materialize(enriched(spark, sf_dir), "checkpoint")
    by_tier = totals.group_metrics(rows, ["tier"], invoice_metrics()).withColumn("level", F.lit("tier"))
    by_status = totals.group_metrics(rows, ["rating"], invoice_metrics()).withColumn("level", F.lit("rating"))
    return by_tier.withColumnRenamed("tier", "key").unionByName(by_status.withColumnRenamed("rating", "key"))


def totals_outer_join(spark, sf_dir):
    """A cube over a right join: counter parties without any invoice count, too. Each
    supplier has a dormant twin under the negative key, which no invoice has."""
    tiers = inv.tiers(spark, sf_dir)
    dictionary = tiers.unionByName(tiers.withColumn("counter_party", -F.col("counter_party") - 1))
    return totals.totals_over_join(
        inv.invoices(spark, sf_dir), dictionary, "counter_party", DIMS, invoice_metrics() + [count_rows("n_rows")], "cube", "total",
        how="right", grouping_id="grouping_id",
    )


def totals_decimal(spark, sf_dir):
    """Sums of decimals through partial rows keep the type of a direct sum; as text, with its scale."""
    fact = inv.invoices(spark, sf_dir).withColumn("amount", F.col("value").cast("decimal(12,2)"))
    summed = joined_totals(spark, sf_dir, "rollup", "total", fact=fact, metrics=[sum_of("amount")])
    return summed.withColumn("sum_amount", F.col("sum_amount").cast("string"))


LATTICE_DIMS = ["legal_entity", "status", "first_line", "large", "taxed", "discounted", "year", "quarter"]


def totals_lattice(spark, sf_dir):
    """The cube of eight dimensions, 256 sets, each rolled up from a small parent."""
    li = inv.table(spark, sf_dir, "lineitem")
    rows = li.select(
        F.col("l_linestatus").alias("legal_entity"), inv.status_from_returnflag(F.col("l_returnflag")).alias("status"),
        (F.col("l_linenumber") == 1).cast("int").alias("first_line"), (F.col("l_quantity") > 25).cast("int").alias("large"),
        (F.col("l_tax") > 0).cast("int").alias("taxed"), (F.col("l_discount") > 0).cast("int").alias("discounted"),
        F.year("l_shipdate").alias("year"), F.quarter("l_shipdate").alias("quarter"),
        F.col("l_quantity").cast("bigint").alias("value"), F.col("l_linenumber").cast("bigint").alias("rating"),
    )
    metrics = [count_rows("n_rows"), max_of("rating"), sum_of("value")]
    return lattice.totals_by_lattice(rows, LATTICE_DIMS, metrics, "cube", "total", grouping_id="grouping_id")


def run_report(spark, sf_dir):
    """Read, too long, rejected, unmatched and written rows of a job, counted by its one action."""
    dictionary = inv.partial_tiers(spark, sf_dir).withColumn("counter_party", F.col("counter_party").cast("string"))
    out = scratch_path(spark, "reported")
    report_rows = report.reported_run(
        spark, _written_invoice_lines(spark, sf_dir), INVOICE, dictionary, "counter_party", lambda df: sinks.write_parquet(df, out), header=False
    )
    written(spark, out)
    return report_rows


# Fixed value: the line number whose partition is written again.
REPLAYED_LINE = 3


def replayed_partition(spark, sf_dir):
    """A partitioned table of invoices of which one partition is written anew, twice: the others stay."""
    path = scratch_path(spark, "replayed")
    rows = inv.invoices(spark, sf_dir).withColumn("day", F.col("rating"))
    sinks.replace_partitions(rows, path, "day")
    for _ in range(2):
        sinks.replace_partitions(rows.filter(F.col("day") == REPLAYED_LINE).withColumn("value", F.col("value") + 1), path, "day")
    return spark.read.schema(rows.schema).parquet(written(spark, path))


def warehouse_table(spark, sf_dir):
    """Joined invoices appended to a warehouse table in two commits and read back by filters that skip files."""
    warehouse.register(spark)
    path = scratch_path(spark, "warehouse")
    rows = enriched(spark, sf_dir)
    for part in (rows.filter(F.col("rating") <= BATCH_SPLIT_RATING), rows.filter(F.col("rating") > BATCH_SPLIT_RATING)):
        sinks.write_table(part, path, format=warehouse.FORMAT, mode="append")
    kept = warehouse.where(("rating", ">=", 2), ("value", "<", 40), ("status", "in", list(INVOICE_STATUSES)))
    return tables.read_table(spark, format=warehouse.FORMAT, path=written(spark, path), where=kept)


def pipeline_run(spark, sf_dir):
    path = scratch_path(spark, "pipeline")
    Pipeline(
        sources=[lambda: inv.invoices(spark, sf_dir), lambda: inv.tiers(spark, sf_dir)],
        transformations=[entity_summary],
        sink=lambda df: sinks.write_parquet(df, path),
    ).run(merge_on="counter_party")
    return spark.read.parquet(written(spark, path))


QUERIES = {
    "enrich_inner": enrich_inner,
    "enrich_broadcast": enrich_broadcast,
    "enrich_salted": enrich_salted,
    "enrich_lookup_dedup": enrich_lookup_dedup,
    "enrich_first_match": enrich_first_match,
    "enrich_null_safe": enrich_null_safe,
    "key_in_dictionary": key_in_dictionary,
    "metrics_by_one_key": metrics_by_one_key,
    "metrics_by_two_keys": metrics_by_two_keys,
    "metrics_by_three_keys": metrics_by_three_keys,
    "entity_summary": entity_summary_query,
    "totals_count_label": totals_count_label,
    "totals_singles": totals_singles,
    "totals_cube_label": totals_cube_label,
    "totals_rollup_label": totals_rollup_label,
    "totals_by_status": totals_by_status,
    "totals_after_join": totals_after_join,
    "totals_from_batches": totals_from_batches,
    "totals_streamed": totals_streamed,
    "totals_null_dims_cube": totals_null_dims_cube,
    "totals_null_dims_count": totals_null_dims_count,
    "totals_sql": totals_sql,
    "totals_union_form": totals_union_form,
    "totals_preaggregated": totals_preaggregated,
    "validate_rows": validate_rows,
    "reject_reasons": reject_reasons,
    "validate_missing_column": validate_missing_column,
    "validated_totals": validated_totals,
    "tolerant_read_rows": tolerant_read_rows,
    "tolerant_read_bad_lines": tolerant_read_bad_lines,
    "flat_cell_reshape": flat_cell_reshape,
    "format_rows": format_rows,
    "sink_roundtrip_csv": sink_roundtrip_csv,
    "table_roundtrip": table_roundtrip,
    "pipeline_run": pipeline_run,
    "validate_positions": validate_positions,
    "flat_line_chunks": flat_line_chunks,
    "rekeyed_rows": rekeyed_rows,
    "joined_to_table": joined_to_table,
    "catalog_table": catalog_table,
    "csv_inferred_totals": csv_inferred_totals,
    "pipeline_csv_json": pipeline_csv_json,
    "enrich_strict": enrich_strict,
    "cached_reuse": cached_reuse,
    "totals_outer_join": totals_outer_join,
    "totals_decimal": totals_decimal,
    "tolerant_multiline": tolerant_multiline,
    "tolerant_multiline_bad": tolerant_multiline_bad,
    "flat_endless_line": flat_endless_line,
    "key_in_dictionary_filtered": key_in_dictionary_filtered,
    "value_variance": value_variance,
    "keyed_fan_out": keyed_fan_out,
    "totals_lattice": totals_lattice,
    "run_report": run_report,
    "replayed_partition": replayed_partition,
    "warehouse_table": warehouse_table,
}
