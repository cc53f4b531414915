"""Running sums over a whole ordered table without a one-task window.

Two levels: the rows are ranged by their order into buckets and stored in the
shared folder, so a bucket's rows stay where they are if a task is run again;
sums within a bucket are a window per bucket; the sums before each bucket are a
table of one row per bucket, that is per task of the range shuffle, which is
all the driver sees. Equal order values are told apart by the remaining columns;
rows equal in every column may swap places.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import store


def running_sum(df: DataFrame, order: Sequence[str | Column], amount: Column, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``amount`` (whole numbers; null counts 0) over all
    rows before this one in ``order``.

    A table of any size and any number of equal order values: those are spread by a
    hash of the row, so one value holding a third of the rows fills several buckets.
    """
    spark = df.sparkSession
    amount_col, bucket, spread = (_free(df, n) for n in ("amount", "bucket", "spread"))
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    hashed = df.select("*", F.coalesce(amount.cast("bigint"), F.lit(0)).alias(amount_col), F.xxhash64(*df.columns).alias(spread))
    keys = [f"{bucket}_{i}" for i in range(len(order))]
    ranged = hashed.select("*", *[c.alias(k) for c, k in zip(order, keys)]).repartitionByRange(*keys, spread)
    placed = store(spark, ranged.withColumn(bucket, F.spark_partition_id()), "running-sum")
    sums, before = [], 0
    for row in placed.groupBy(bucket).agg(F.sum(amount_col).alias("n")).sort(bucket).toLocalIterator():  # a row per task
        sums.append((row[bucket], before))
        before += row["n"]
    base = spark.createDataFrame(sums, f"{bucket} int, {name} long")
    within = Window.partitionBy(bucket).orderBy(*keys, spread).rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumn(amount_col, F.coalesce(F.sum(amount_col).over(within), F.lit(0)))
    joined = summed.join(base, bucket)  # a few rows from the driver: Spark broadcasts them itself
    return joined.select(*df.columns, (F.col(name) + F.col(amount_col)).alias(name))


def _free(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    name = f"__{name}"
    while any(c.lower() == name or c.lower().startswith(f"{name}_") for c in df.columns):
        name = "_" + name
    return name
