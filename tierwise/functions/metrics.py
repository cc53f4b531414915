"""Aggregate metrics: max, count, row count, sum and conditional sum.

A ``Metric`` names one aggregate and knows three forms of it:

* ``column()``   the aggregate over raw rows;
* ``partial()``  the aggregate at a finer grain;
* ``final()``    how finer-grain partials merge into the same answer.

The last two let a totals plan aggregate once at the finest grain and then
roll the (much smaller) partial rows up, because every metric here is
decomposable: max of maxes, sum of sums, and a count becomes a sum of counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


@dataclass(frozen=True)
class Metric:
    name: str
    kind: str  # max | min | sum | sum0 | count | rows
    source: object = None  # column name or Column expression

    def _partial_name(self) -> str:
        return f"__p_{self.name}"

    def input(self) -> Column | None:
        """The per-row expression the aggregate reads (None for a row count)."""
        return None if self.kind == "rows" else _col(self.source)

    def on(self, column: str) -> "Metric":
        """The same metric reading an already projected input column."""
        return Metric(self.name, self.kind, None if self.kind == "rows" else column)

    def column(self) -> Column:
        if self.kind == "max":
            agg = F.max(_col(self.source))
        elif self.kind == "min":
            agg = F.min(_col(self.source))
        elif self.kind == "sum":
            agg = F.sum(_col(self.source))
        elif self.kind == "sum0":
            # A group with no matching row, or only null values, totals 0.
            agg = F.coalesce(F.sum(_col(self.source)), F.lit(0))
        elif self.kind == "count":
            agg = F.count(_col(self.source))
        elif self.kind == "rows":
            agg = F.count(F.lit(1))
        else:
            raise ValueError(f"unknown metric kind {self.kind!r}")
        return agg.alias(self.name)

    def partial(self) -> Column:
        if self.kind == "sum0":
            agg = F.sum(_col(self.source))
        else:
            agg = Metric(self._partial_name(), self.kind, self.source).column()
        return agg.alias(self._partial_name())

    def merge(self) -> Column:
        """Partials merged into coarser partials (same column name): used to
        compact stored partial rows without finishing the metric."""
        p = F.col(self._partial_name())
        if self.kind == "max":
            agg = F.max(p)
        elif self.kind == "min":
            agg = F.min(p)
        elif self.kind in ("sum", "sum0", "count", "rows"):
            agg = F.sum(p)
        else:
            raise ValueError(f"unknown metric kind {self.kind!r}")
        return agg.alias(self._partial_name())

    def final(self) -> Column:
        p = F.col(self._partial_name())
        if self.kind == "max":
            agg = F.max(p)
        elif self.kind == "min":
            agg = F.min(p)
        elif self.kind == "sum":
            agg = F.sum(p)
        elif self.kind in ("sum0", "count", "rows"):
            agg = F.coalesce(F.sum(p), F.lit(0))
        else:
            raise ValueError(f"unknown metric kind {self.kind!r}")
        return agg.alias(self.name)


def _name(prefix: str, source, name: str | None) -> str:
    if name:
        return name
    if not isinstance(source, str):
        raise ValueError("a metric over a column expression needs a name")
    return f"{prefix}_{source}"


def max_of(source, name: str | None = None) -> Metric:
    """Largest value of ``source``; named ``max_<source>`` unless ``name`` is given."""
    return Metric(_name("max", source, name), "max", source)


def min_of(source, name: str | None = None) -> Metric:
    """Smallest value of ``source``; named ``min_<source>`` unless ``name`` is given."""
    return Metric(_name("min", source, name), "min", source)


def sum_of(source, name: str | None = None) -> Metric:
    """Sum of ``source`` (null when every value is null); named ``sum_<source>`` by default."""
    return Metric(_name("sum", source, name), "sum", source)


def count_of(source, name: str | None = None) -> Metric:
    """Non-null count of a column."""
    return Metric(_name("count", source, name), "count", source)


def count_rows(name: str = "n_rows") -> Metric:
    """Number of rows in the group."""
    return Metric(name, "rows")


def sum_if(source, condition: Column, name: str) -> Metric:
    """Sum of ``source`` over rows where ``condition`` holds; 0 when none do."""
    return Metric(name, "sum0", F.when(condition, _col(source)))


def metric_set(max_col: str, sum_col: str, filter_col: str, *conditions: str) -> list[Metric]:
    """``max_{max_col}`` plus ``sum_{sum_col}_{c}`` for each value ``c`` of ``filter_col``.

    Any number of condition values is accepted, not just two.
    """
    out = [max_of(max_col)]
    for value in conditions:
        out.append(sum_if(sum_col, F.col(filter_col) == F.lit(value), f"sum_{sum_col}_{value}"))
    return out


# The two invoice statuses the exercise totals by.
INVOICE_STATUSES = ("ARAP", "ACCR")


def invoice_metrics(statuses=INVOICE_STATUSES) -> list[Metric]:
    """max_rating, sum_value_ARAP, sum_value_ACCR."""
    return metric_set("rating", "value", "status", *statuses)
