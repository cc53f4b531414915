"""Catalog and connector sources, and temporary views.

A warehouse table is read either from the session catalog by name or through
any installed data-source connector by format name. Connector jars are not
bundled; a missing connector surfaces as Spark's own error when the read is
planned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession, table: str | None = None, format: str | None = None, path: str | None = None, **options
) -> DataFrame:
    """A catalog table by name, or a data source by format.

    * ``read_table(spark, "db.t")``: the session catalog;
    * ``read_table(spark, "project.dataset.t", format=...)``: a connector that
      takes the table as its ``table`` option;
    * ``read_table(spark, format=..., path=...)``: a path-based source.
    """
    if format is None:
        return spark.read.options(**options).table(table)
    reader = spark.read.format(format).options(**options)
    if table is not None:
        reader = reader.option("table", table)
    return reader.load(path) if path is not None else reader.load()


def register_views(**frames: DataFrame) -> None:
    """Expose DataFrames to SQL under the given names."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
