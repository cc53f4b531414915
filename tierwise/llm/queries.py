"""The registered queries of the subpackage: each applies one operator, with its
production parameters, to its whole table and returns the full result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (
    conversations, decontaminate, mixing, neighbours, packing, periodic, pii, quality, repeats, secret_scan, simhash, token_files, toxicity,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents, learnt from the labels outside the held-out fold."""
    return toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of 2048 tokens, a row per piece."""
    return packing.pack(_table(spark, sf_dir, "documents"), capacity=2048, end_id=0)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences of benchmark items in all documents, up to 5 percent of edits."""
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids written as patched frame-of-reference segments and read back."""
    return token_files.round_trip(_table(spark, sf_dir, "documents"), end_id=2)


def op5_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of repeated 400-byte strings removed from every document."""
    return repeats.remove_repeats(_table(spark, sf_dir, "documents"), length=400)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores and decisions for all documents, learnt without labels."""
    return quality.classify(_table(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed and bootstrapped spans of personal data in every document."""
    return pii.digest(pii.find_personal_data(_table(spark, sf_dir, "documents")))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash near-duplicate components of 3-word shingles at 2 bits."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents after the forest's false-positive removal."""
    return secret_scan.scan(_table(spark, sf_dir, "documents"))


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every vector whose id is divisible by 50."""
    return neighbours.nearest_neighbours(_table(spark, sf_dir, "embeddings"), query_every=50, top=5)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of at least six words and four periods in all documents, a tenth of them made periodic."""
    return periodic.periodic_runs(periodic.with_planted_periods(_table(spark, sf_dir, "documents")), min_length=6, exponent=4)


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often every document is taken so that its source meets its share of all words."""
    mixed = mixing.plan(_table(spark, sf_dir, "documents"), weights=(1, 2, 3), max_repeats=3)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after the contract's damage."""
    return conversations.repair(conversations.damaged(_table(spark, sf_dir, "conversations")), present="present")


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_best_fit_packing, op3_decontamination, op4_token_files, op5_repeated_strings, op6_quality,
        op7_personal_data, op8_simhash, op9_secrets, op10_nearest_neighbours, op11_periodic_runs, op12_source_mix,
        op13_conversation_repair,
    )
}

# The others are not expressible in the check's SQL: tests compare them with brute force.
ORACLE_SQL: dict[str, str] = {"op12_source_mix": mixing.ORACLE_SQL}
