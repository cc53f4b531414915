"""Source → merge → transformations → sink, as one lazy plan and one action.

Sources are callables returning DataFrames (or DataFrames themselves); any
number of them are merged by folding inner joins on the shared key. Each
transformation is a ``DataFrame -> DataFrame`` function applied with
``DataFrame.transform``. The sink is the only action.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from typing import Callable, Sequence

from pyspark.sql import DataFrame

from ..functions.metrics import count_of, max_of, sum_of
from ..operators import quality
from ..operators.joins import enrich
from ..operators.totals import group_metrics, totals_over_join
from ..sources import files


@dataclass
class Pipeline:
    sources: Sequence
    transformations: Sequence[Callable[[DataFrame], DataFrame]] = field(default_factory=list)
    sink: Callable[[DataFrame], object] | None = None

    def plan(self, merge_on, how: str = "inner") -> DataFrame:
        frames = [s() if callable(s) else s for s in self.sources]
        data = reduce(lambda left, right: enrich(left, right, merge_on, how), frames)
        for step in self.transformations:
            data = data.transform(step)
        return data

    def run(self, merge_on, how: str = "inner") -> DataFrame:
        data = self.plan(merge_on, how)
        if self.sink is not None:
            self.sink(data)
        return data


ENTITY_METRICS = [count_of("rating", "count_rating"), max_of("tier", "max_tier"), sum_of("value", "sum_value")]


def entity_summary(df: DataFrame) -> DataFrame:
    """Per (legal_entity, counter_party): count_rating, max_tier, sum_value."""
    return group_metrics(df, ["legal_entity", "counter_party"], ENTITY_METRICS)


def validated_rows(spark, path, schema, rules: dict | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Read delimited text tolerantly and validate it against ``schema`` (and
    optional domain ``rules``, see ``operators.quality.validate``).

    Returns ``(typed valid rows, reject table, bad lines)``. The reject table
    has the row's file position, the failing column, its raw text and the
    reason; bad lines are records with more fields than the schema.
    """
    raw = files.read_csv_tolerant(spark, path, schema)
    good, bad_lines = files.split_corrupt(raw)
    valid = quality.valid_rows(quality.validate(good, schema, rules), schema)
    # Only the reject table needs file positions (a second read of the file).
    rejected = quality.rejects(quality.validate(quality.with_position(good), schema, rules), ["position"])
    return valid, rejected, bad_lines


def validated_totals(spark, path, schema, dictionary, on, dims, metrics, sets="pairs", label="count", **options):
    """The whole job as one lazy plan: tolerant read → validation → enrichment →
    totals. Invalid rows are left out of the totals; see ``validated_rows`` for
    the reject table."""
    valid, _, _ = validated_rows(spark, path, schema)
    return totals_over_join(valid, dictionary, on, dims, metrics, sets, label, **options)
