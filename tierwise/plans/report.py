"""A job's own counters, from the one action that does its work.

``Observation`` counters are accumulated by the tasks as rows stream through a point of
the plan: no second pass, no count per step. A stage that is run again after a lost
executor may add its rows again, so they are a report, not an audit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import quality
from ..operators.joins import enrich
from ..sources import files


def reported_run(
    spark: SparkSession, path, schema, dictionary: DataFrame, on: str, sink, rules: dict | None = None, header: bool = True, **join_options
) -> DataFrame:
    """Tolerant read, validation, enrichment and ``sink`` as one action; returns (step, n) with the
    records read, those too long, the rows rejected by validation, the rows whose key the
    dictionary lacks, and the rows written. ``dictionary``'s keys are text and distinct."""
    steps = [Observation(), Observation(), Observation()]
    read = files.read_csv_tolerant(spark, path, schema, header=header).observe(
        steps[0], F.count(F.lit(1)).alias("read"), F.count_if(F.col(files.EXTRA).isNotNull()).alias("too_long")
    )
    good, _ = files.split_corrupt(read)
    checked = quality.validate(good, schema, rules).observe(steps[1], F.count_if(~F.col("valid")).alias("rejected"))
    known = dictionary.withColumn("__known", F.lit(True))
    joined = enrich(quality.valid_rows(checked, schema), known, on, how="left", **join_options).observe(
        steps[2], F.count_if(F.col("__known").isNull()).alias("unmatched"), F.count_if(F.col("__known").isNotNull()).alias("written")
    )
    sink(joined.filter(F.col("__known").isNotNull()).drop("__known"))
    counts = {name: n for step in steps for name, n in step.get.items()}
    return spark.createDataFrame([(name, int(n)) for name, n in counts.items()], "step string, n long")
