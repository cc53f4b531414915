"""Reusing one input across several plans.

A single totals plan reads its input once, so nothing needs caching. When the
same enriched input feeds several plans, compute it once:

* ``"cache"``       keep it in executor memory/disk (lost with an executor,
                    then recomputed from lineage);
* ``"checkpoint"``  write it to the shared ``spark.checkpoint.dir`` and cut
                    the lineage, so a lost executor costs a re-read, not a
                    recomputation.

A machine-local checkpoint is never used: its blocks die with the executor.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from ..session import checkpoint_dir


def materialize(df: DataFrame, mode: str = "checkpoint") -> DataFrame:
    """``df`` computed once: cached (``"cache"``) or written to the shared checkpoint folder."""
    if mode == "cache":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if mode == "checkpoint":
        checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    raise ValueError("mode must be 'cache' or 'checkpoint'")
