"""Micro-batches of fact rows into a stored table of partial totals.

Each micro-batch's partial rows are written to ``<partials_path>/batch_id=<n>``
with overwrite, so a batch replayed after a failure (Structured Streaming
replays the last uncommitted batch) rewrites the same folder instead of
appending twice: the table stays exactly-once. The stream's checkpoint lives in
``<partials_path>/_checkpoint`` unless one is given, so a stream started again
on the same table goes on where it stopped; a new checkpoint on a table that
holds batches already is refused, as it would number and count them anew.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..functions.metrics import Metric
from ..operators.totals import partial_totals

BATCH_COLUMN = "batch_id"


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def stream_partials(
    facts: DataFrame,
    dictionary: DataFrame,
    on,
    dims: Sequence[str],
    metrics: Sequence[Metric],
    partials_path: str,
    keys: Sequence[str] = (),
    checkpoint: str | None = None,
    available_now: bool = False,
    processing_time: str | None = None,
    **join_options,
) -> StreamingQuery:
    """Start a query that appends each micro-batch's partial rows to ``partials_path``.

    ``facts`` is a streaming DataFrame (for example ``spark.readStream`` over a
    folder of CSV files); ``dictionary`` is a static DataFrame. With
    ``available_now=True`` the query processes what has arrived and stops.
    """
    spark = facts.sparkSession
    checkpoint = checkpoint or f"{partials_path}/_checkpoint"
    if not _exists(spark, f"{checkpoint}/offsets") and _exists(spark, f"{partials_path}/{BATCH_COLUMN}=0"):
        raise ValueError(f"{partials_path} holds batches of another checkpoint than {checkpoint}")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        part = partial_totals(batch, dictionary, on, dims, metrics, keys, **join_options)
        part.write.mode("overwrite").parquet(f"{partials_path}/{BATCH_COLUMN}={batch_id}")

    writer = facts.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def read_partials(spark: SparkSession, partials_path: str) -> DataFrame:
    """The stored partial rows of all batches, without the batch column."""
    return spark.read.parquet(partials_path).drop(BATCH_COLUMN)
