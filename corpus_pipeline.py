"""The training-data pipeline: documents through five operators, one stage each.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir), works
on all rows its predecessor kept and returns a DataFrame. ``run`` writes each
stage's rows as Parquet to the shared folder (``spark.checkpoint.dir``) and
reads them back as the next one's documents, so a lost executor costs a re-read.
All stages but the last return the columns of ``documents``.

Each stage handles nulls, empty texts, repeated rows and extra columns as its
operator's docstring says: null and empty texts are rejected by the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierwise.llm import decontaminate, packing, quality, secret_scan, simhash
from tierwise.session import store


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that of the smallest id."""
    return simhash.deduplicate(docs, shingle=3, max_bits=2)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; every document stays."""
    return secret_scan.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences of at most 2048 tokens."""
    return packing.pack(docs, capacity=2048, end_id=0)


STAGES = [
    ("quality classifier", keep_quality),
    ("SimHash near-dedup", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("best-fit packing", packed),
]

# A trained scorer, fingerprints, edit distances and token ids are not SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents in ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = store(spark, docs, f"pipeline-stage-{number}")
    return docs
