"""Totals over many grouping sets, each rolled up from a small parent.

One ``Expand`` over n sets multiplies every input row n times: 256 times for a cube of
eight dimensions. Here the input is aggregated once at the finest grain and stored.
Distinct counts of the dimensions, sketched in one pass over those rows
(``approx_count_distinct``), bound how many rows each set would make. By them a few sets are
chosen to be stored, too, in order of what they save (the greedy choice for view
lattices): every other set is rolled up from the smallest stored set that holds its
dimensions. Sets of one parent share an ``Expand``. Sketches steer only the cost; the
answer is that of ``totals``.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import Metric
from ..session import store
from .totals import _check_columns, _label, _narrow, _partials, grouping_sets


def choose_parents(sizes: dict[frozenset, int], finest: frozenset, max_views: int = 6) -> tuple[list[frozenset], dict[frozenset, frozenset]]:
    """The sets to store, coarser ones after their parents, and every set's parent among them.

    A set's cost is its parent's rows. The set that lowers the total cost most, beyond what it
    costs itself, is stored next, while one does.
    """
    stored, parent = [finest], {s: finest for s in sizes}
    while len(stored) <= max_views:
        best, gain = None, 0
        for view in sizes:
            if view in stored:
                continue
            saved = sum(max(0, sizes[parent[s]] - sizes[view]) for s in sizes if s < view)
            if saved - sizes[view] > gain:  # it is written and read once more
                best, gain = view, saved - sizes[view]
        if best is None:
            break
        stored.append(best)
        for s in sizes:
            if s < best and sizes[best] < sizes[parent[s]]:
                parent[s] = best
    return sorted(stored, key=lambda v: -len(v)), parent


def expand_rows(sizes: dict[frozenset, int], parent: dict[frozenset, frozenset]) -> int:
    """Rows that the sets' ``Expand`` nodes make by these sizes."""
    return sum(sizes[parent[s]] for s in sizes)


def _rolled(source: DataFrame, dims: list[str], kept: list[str], keys: list[str], metrics, sets, counts: bool) -> DataFrame:
    """Partial rows of ``sets`` (of ``kept``) from partial rows at ``kept``: dimensions, keys, flags,
    partial metrics, ``__rows`` and, for each dimension, its non-null count."""
    merges = [m.merge().cast(source.schema[m._partial_name()].dataType).alias(m._partial_name()) for m in metrics]
    rows = F.sum("__rows").alias("__rows")
    tallies = []
    for c in dims if counts else []:
        n = F.when(F.col(c).isNotNull(), F.col("__rows")).otherwise(0) if c in kept else F.col(f"__n_{c}")
        tallies.append(F.sum(n).alias(f"__n_{c}"))
    flags = [F.grouping(c).cast("int").alias(f"__g_{c}") for c in kept]
    if kept or keys:
        rolled = source.groupingSets([[c for c in kept if c in s] + keys for s in sets], *kept, *keys).agg(*merges, rows, *tallies, *flags)
    else:
        rolled = source.groupBy().agg(*merges, rows, *tallies)
    gone = [c for c in dims if c not in kept]
    return rolled.withColumns({f"__g_{c}": F.lit(1) for c in gone}) if gone else rolled


def totals_by_lattice(
    df: DataFrame, dims: Sequence[str], metrics: Sequence[Metric], sets="cube", label: str = "total", keys: Sequence[str] = (),
    total_label: str = "Total", grouping_id: str | None = None, max_views: int = 6,
) -> DataFrame:
    """``totals(df, dims, metrics, sets, ...)``, planned over the lattice of its sets."""
    dims, keys = list(dims), list(keys)
    _check_columns(dims, keys, metrics, label)
    spark, wanted = df.sparkSession, [frozenset(s) for s in grouping_sets(dims, sets)]
    narrow, metrics = _narrow(df, dims + keys, metrics)
    finest = store(spark, _partials(narrow, dims + keys, metrics), "lattice-finest")
    whole = frozenset(dims)
    distinct = [(F.approx_count_distinct(c) + F.max(F.col(c).isNull().cast("int"))).alias(f"s{i}") for i, c in enumerate(dims)]
    held = F.approx_count_distinct(F.xxhash64(*keys)) if keys else F.lit(1)
    row = finest.agg(F.count(F.lit(1)).alias("n"), held.alias("k"), *distinct).first()
    # A set makes no more rows than the product of its dimensions' values, nor than the finest grain has.
    sizes = {}
    for s in [whole, *wanted]:
        values = reduce(lambda a, b: a * b, [max(1, row[f"s{i}"] or 1) for i, c in enumerate(dims) if c in s], max(1, row["k"]))
        sizes[s] = max(1, min(row["n"], values))
    stored, parent = choose_parents(sizes, whole, max_views)
    counts = label == "count"
    tables = {whole: finest}
    for view in stored[1:]:
        above = min((v for v in tables if v > view), key=lambda v: sizes[v])
        kept = [c for c in dims if c in above]
        rolled = _rolled(tables[above], dims, kept, keys, metrics, [view], counts)
        gone = [c for c in dims if c not in view]
        tables[view] = store(spark, rolled.drop(*[c for c in gone if c in rolled.columns], *[f"__g_{c}" for c in dims]), "lattice-view")
    parts = []
    for view in stored:
        mine = [s for s in wanted if (s == view or (s not in tables and parent[s] == view))]
        if not mine:
            continue
        kept = [c for c in dims if c in view]
        rolled = _rolled(tables[view], dims, kept, keys, metrics, [s for s in mine], counts)
        if not keys and frozenset() in mine and kept:
            # Of no rows there is a grand total, too: an aggregate without groups has always one.
            rolled = rolled.filter(" OR ".join(f"__g_{c} = 0" for c in kept))
            nothing = _rolled(tables[view], [c for c in dims], [], keys, metrics, [()], False) if not counts else _grand(tables[view], dims, kept, metrics)
            rolled = rolled.unionByName(nothing, allowMissingColumns=True)
        for c in [c for c in dims if c not in rolled.columns]:
            rolled = rolled.withColumn(c, F.lit(None).cast(df.schema[c].dataType))
        parts.append(rolled.select(*dims, *keys, *[c for c in rolled.columns if c.startswith("__")]))
    rolled = reduce(DataFrame.unionByName, parts)
    bits = len(dims) + len(keys)
    gid = reduce(lambda a, b: a + b, [F.col(f"__g_{c}").cast("bigint") * (1 << (bits - 1 - i)) for i, c in enumerate(dims)])
    finals = [_final(m) for m in metrics]
    for c in dims if counts else []:
        rolled = rolled.withColumn(f"__n_{c}", F.coalesce(F.col(f"__n_{c}"), F.lit(0)))
    return rolled.select(
        *[_label(c, label, total_label) for c in dims], *keys, *finals, *([gid.alias(grouping_id)] if grouping_id else [])
    )


def _grand(source: DataFrame, dims: list[str], kept: list[str], metrics) -> DataFrame:
    """The grand total with the non-null count of every dimension."""
    counted = source.withColumns({f"__n_{c}": F.when(F.col(c).isNotNull(), F.col("__rows")).otherwise(0) for c in kept})
    return _rolled(counted, dims, [], [], metrics, [()], True)


def _final(m: Metric):
    """The metric of one merged partial row."""
    value = F.col(m._partial_name())
    return (F.coalesce(value, F.lit(0)) if m.kind in ("sum0", "count", "rows") else value).alias(m.name)
