"""Sinks: delimited files, tables, console, and fixed-separator text lines.

Writers keep the input's partitioning: one file per partition, no coalesce to
a single file, so a large result is written by every executor in parallel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", header: bool = True, **options) -> None:
    """A directory of CSV parts with a header row each; no index column."""
    df.write.mode(mode).option("header", header).options(**options).csv(path)


def write_table(
    df: DataFrame,
    target: str,
    format: str | None = None,
    mode: str | None = None,
    bucket_by=None,
    buckets: int | None = None,
    **options,
) -> None:
    """Save into a catalog table (``format=None``) or through a connector.

    The default mode is Spark's ``errorifexists``: an existing target fails.
    ``bucket_by`` with ``buckets`` stores a catalog table hash-bucketed on the
    given columns: a fact and a dictionary bucketed alike on the join key are
    later joined, and aggregated by groups that include the key, without a
    shuffle. A bucketed scan reads each bucket in one task, so do not bucket
    a fact on a key that holds a large share of its rows.
    """
    if bucket_by and format is not None:
        raise ValueError("bucketing needs a catalog table (format=None): Spark buckets only saveAsTable output")
    writer = df.write
    if mode:
        writer = writer.mode(mode)
    if bucket_by:
        cols = [bucket_by] if isinstance(bucket_by, str) else list(bucket_by)
        writer = writer.bucketBy(buckets, *cols)
    if format is None:
        writer.options(**options).saveAsTable(target)
    else:
        writer.format(format).options(**options).save(target)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", partition_by=None) -> None:
    """A directory of parquet parts, optionally partitioned by columns."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by, **options) -> None:
    """Write ``df`` so that it can be written again: each value of ``partition_by`` that it holds
    replaces what the table has for that value, and nothing else changes.

    Spark's dynamic partition overwrite: files are staged below the target and moved into
    their partitions when the job commits, so a run that fails leaves the table as it was.
    A job whose rows are a function of its day is thereby replayable.
    """
    cols = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**options)
    writer.partitionBy(*cols).parquet(path)


def show(df: DataFrame, n: int = 20, truncate: bool = True) -> None:
    """Print the first ``n`` rows; only those rows reach the driver."""
    df.show(n, truncate)


# Fixed value: eleven spaces between fields of a formatted row.
ROW_SEPARATOR = " " * 11


def format_lines(df: DataFrame, columns=None, sep: str = ROW_SEPARATOR, name: str = "line") -> DataFrame:
    """One text column: the chosen columns as text, joined by ``sep``.

    Nulls print as empty fields rather than vanishing, so field positions hold.
    """
    cols = columns or df.columns
    return df.select(F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]).alias(name))


def write_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a single-string-column DataFrame as text files."""
    df.write.mode(mode).text(path)
