"""The invoice data model over the driver's TPC-H-style tables.

The exercise's fact table (invoices) and dictionary (tiers) are mapped onto
``lineitem`` and ``supplier``:

=================  ================================  ==========================
invoice column     source                            note
=================  ================================  ==========================
invoice_id         l_orderkey                        not unique per line
legal_entity       l_linestatus                      2 values
counter_party      l_suppkey                         join key, kept numeric
rating             l_linenumber                      1..7
status             l_returnflag A/R/N                ARAP / ACCR / N (a third)
value              l_quantity as bigint              integral, so sums exact
tier               s_nationkey of suppliers          every supplier; the queries
                                                     about missing keys take those
                                                     with s_acctbal > 5000 only
=================  ================================  ==========================

The join key stays numeric through the join; totals cast dimensions to
string only at the end. Every loader selects just the columns it needs, so
the parquet scan reads only those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# How return flags map to invoice statuses, and the balance
# above which a supplier belongs to the partial tier dictionary.
STATUS_BY_RETURNFLAG = {"A": "ARAP", "R": "ACCR"}
TIER_MIN_ACCTBAL = 5000

DIMS = ("legal_entity", "counter_party", "tier")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def status_from_returnflag(flag: Column) -> Column:
    expr = None
    for code, status in STATUS_BY_RETURNFLAG.items():
        expr = F.when(flag == code, F.lit(status)) if expr is None else expr.when(flag == code, F.lit(status))
    return expr.otherwise(flag)


def invoices(spark: SparkSession, sf_dir: str, statuses=None) -> DataFrame:
    """Invoices; ``statuses`` filters on the stored flags, so that the scan prunes."""
    li = table(spark, sf_dir, "lineitem")
    if statuses is not None:
        flags = {status: flag for flag, status in STATUS_BY_RETURNFLAG.items()}
        li = li.filter(F.col("l_returnflag").isin(*[flags.get(x, x) for x in statuses]))
    return li.select(
        F.col("l_orderkey").alias("invoice_id"),
        F.col("l_linestatus").alias("legal_entity"),
        F.col("l_suppkey").alias("counter_party"),
        F.col("l_linenumber").cast("bigint").alias("rating"),
        status_from_returnflag(F.col("l_returnflag")).alias("status"),
        F.col("l_quantity").cast("bigint").alias("value"),
    )


def tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole dictionary: every supplier."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("counter_party"), F.col("s_nationkey").cast("bigint").alias("tier")
    )


def partial_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary that lacks keys of the fact, for the queries about missing keys."""
    s = table(spark, sf_dir, "supplier")
    return s.filter(F.col("s_acctbal") > TIER_MIN_ACCTBAL).select(
        F.col("s_suppkey").alias("counter_party"), F.col("s_nationkey").cast("bigint").alias("tier")
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact for the order-dependent lookups: customers keyed by nation."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("custkey"),
        F.col("c_nationkey").alias("nationkey"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("acctbal"),
    )


def suppliers_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary with duplicate keys: suppliers keyed by nation."""
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_nationkey").alias("nationkey"),
        F.col("s_suppkey").alias("suppkey"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("acctbal"),
    )


# Line numbers whose value text is made dirty for validation.
NULL_VALUE_LINE = 6
BAD_VALUE_LINE = 7


def invoice_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices as untyped text, with derived faults: line 6 has no value and
    line 7's value reads like ``10e``. All other fields are clean."""
    inv = invoices(spark, sf_dir)
    value_text = F.col("value").cast("string")
    return inv.select(
        F.col("invoice_id").cast("string").alias("invoice_id"),
        "legal_entity",
        F.col("counter_party").cast("string").alias("counter_party"),
        F.col("rating").cast("string").alias("rating"),
        "status",
        F.when(F.col("rating") == NULL_VALUE_LINE, F.lit(None).cast("string"))
        .when(F.col("rating") == BAD_VALUE_LINE, F.concat(value_text, F.lit("e")))
        .otherwise(value_text)
        .alias("value"),
    )
