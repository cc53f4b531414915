"""Multi-level totals over grouping sets.

``totals`` answers every grouping level in one plan: one scan of the input,
one ``Expand`` that feeds a partial (map-side) hash aggregate, and one shuffle
keyed by the grouping columns plus the grouping id. A hot key, or the grand
total that every row rolls into, costs one partial row per map task, never a
hot reduce task.

``totals_over_join`` (and ``group_over_join`` for one level) computes the
totals of a fact enriched by a dictionary while aggregating the fact before
the join, so only partial rows meet the dictionary. ``partial_totals``,
``totals_from_partials`` and ``compact_partials`` expose those partial rows
as a table that can be stored and appended to batch by batch. ``totals_union``
keeps the one-aggregate-per-set shape for comparison.

Rolled-up dimension columns are labelled in one of three ways:

* ``"count"``  the non-null count of that column in the group (the labelled
               form of the scripted variants);
* ``"total"``  a fixed text, ``Total`` by default (the brief's form);
* ``"null"``   SQL null; pass ``grouping_id`` to tell it from a null value.

Rolled-up rows are found with ``grouping()``, never by testing for null, so a
null or a literal ``Total`` in the data is never mistaken for a total row.
Every dimension is returned as a string because a label shares its column.
"""

from __future__ import annotations

import itertools
from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import Metric
from .joins import enrich

LABELS = ("count", "total", "null")
SHAPES = ("pairs", "singles", "cube", "rollup", "detail")


def grouping_sets(dims: Sequence[str], sets="pairs") -> list[tuple[str, ...]]:
    """Expand a set description into explicit grouping sets.

    ``sets`` is a shape name, an iterable of set sizes (``[1, 2]``), or an
    explicit list of column lists. ``"pairs"`` is every single and every pair
    of ``dims`` with neither the full set nor the grand total; sets come in the
    order {a}, {a,b}, {a,c}, {b}, {b,c}, {c}.
    """
    dims = list(dims)
    if isinstance(sets, str):
        if sets == "pairs":
            return subsets_of_sizes(dims, (1, 2))
        if sets == "singles":
            return subsets_of_sizes(dims, (1,))
        if sets == "detail":
            return [tuple(dims)]
        if sets == "cube":
            return subsets_of_sizes(dims, range(len(dims), -1, -1))
        if sets == "rollup":
            return [tuple(dims[:i]) for i in range(len(dims), -1, -1)]
        raise ValueError(f"unknown set shape {sets!r}; expected one of {SHAPES}")
    sets = list(sets)
    if all(isinstance(s, int) for s in sets):
        return subsets_of_sizes(dims, sets)
    out = []
    for s in sets:
        s = (s,) if isinstance(s, str) else tuple(s)
        unknown = [c for c in s if c not in dims]
        if unknown:
            raise ValueError(f"grouping set {s} names columns outside the dimensions: {unknown}")
        out.append(s)
    return out


def subsets_of_sizes(dims: Sequence[str], sizes: Iterable[int]) -> list[tuple[str, ...]]:
    sizes = set(sizes)
    chosen = [
        combo
        for r in sorted(sizes)
        for combo in itertools.combinations(range(len(dims)), r)
    ]
    chosen.sort()
    return [tuple(dims[i] for i in combo) for combo in chosen]


def complements(dims: Sequence[str], sets) -> list[tuple[tuple[str, ...], tuple[str, ...]]]:
    """Each set with the dimensions it rolls up."""
    return [(s, tuple(c for c in dims if c not in s)) for s in grouping_sets(dims, sets)]


def _check_columns(dims, keys, metrics, label) -> None:
    if label not in LABELS:
        raise ValueError(f"unknown label {label!r}; expected one of {LABELS}")
    if len(set(dims)) != len(dims):
        raise ValueError(f"dimensions repeat: {dims}")
    if set(dims) & set(keys):
        raise ValueError(f"columns are both dimensions and keys: {sorted(set(dims) & set(keys))}")
    names = [m.name for m in metrics]
    clash = [n for n in names if names.count(n) > 1 or n in dims or n in keys]
    if clash:
        raise ValueError(f"metric names must be unique and differ from grouping columns: {sorted(set(clash))}")


def _label(c: str, label: str, total_label: str) -> Column:
    rolled = F.col(f"__g_{c}") == 1
    if label == "count":
        shown = F.col(f"__n_{c}").cast("string")
    elif label == "total":
        shown = F.lit(total_label)
    elif label == "null":
        shown = F.lit(None).cast("string")
    else:
        raise ValueError(f"unknown label {label!r}; expected one of {LABELS}")
    return F.when(rolled, shown).otherwise(F.col(c).cast("string")).alias(c)


def totals(
    df: DataFrame,
    dims: Sequence[str],
    metrics: Sequence[Metric],
    sets="pairs",
    label: str = "count",
    keys: Sequence[str] = (),
    preaggregate: bool = False,
    total_label: str = "Total",
    grouping_id: str | None = None,
) -> DataFrame:
    """Totals of ``metrics`` at every grouping set of ``dims``.

    ``keys`` are grouped in every set (for example a status column), so the
    totals are repeated per key value. With ``preaggregate=True`` the rows are
    first reduced to one per distinct ``dims + keys`` combination and the sets
    are rolled up from those partials: two shuffles instead of one, but the
    ``Expand`` multiplies partial rows instead of input rows, which pays off
    when the input has many rows per finest group.

    Output columns: ``dims`` (strings, labelled), ``keys``, metric names, and
    ``grouping_id`` when named.
    """
    dims, keys = list(dims), list(keys)
    _check_columns(dims, keys, metrics, label)
    group_cols = dims + keys
    # Project each metric's input once, before the Expand multiplies the rows,
    # so the Expand carries only grouping columns and narrow inputs.
    narrow, metrics = _narrow(df, group_cols, metrics)
    if preaggregate:
        partials = _partials(narrow, group_cols, metrics)
        return _roll_partials(partials, dims, keys, metrics, sets, label, total_label, grouping_id)

    flags = [F.grouping(c).alias(f"__g_{c}") for c in dims]
    gid = [F.grouping_id().alias(grouping_id)] if grouping_id else []
    # count(c) reads the input column, not the copy Expand nulls for the set.
    counts = [F.count(c).alias(f"__n_{c}") for c in dims] if label == "count" else []
    gsets = [list(s) + keys for s in grouping_sets(dims, sets)]
    if _has_grand_total(dims, keys, sets):
        narrow = _with_blank(narrow, F.lit(1))
        weight = F.sum("__weight")
        aggs = [weight.alias(m.name) if m.kind == "rows" else m.column() for m in metrics]
        rolled = narrow.groupingSets(gsets, *group_cols).agg(*aggs, *flags, *counts, *gid, weight.alias("__weight"))
        rolled = _without_blank(rolled, dims)
    else:
        rolled = narrow.groupingSets(gsets, *group_cols).agg(*[m.column() for m in metrics], *flags, *counts, *gid)
    return _labelled(rolled, dims, keys, metrics, label, total_label, grouping_id)


def _has_grand_total(dims, keys, sets) -> bool:
    return not keys and () in grouping_sets(dims, sets)


def _with_blank(df: DataFrame, weight: Column) -> DataFrame:
    """``df`` and one blank row of weight 0: it makes the grand-total row appear also
    when there are no rows, as SQL's empty grouping set gives it, and adds nothing
    to any metric. Groups it is alone in are dropped by ``_without_blank``."""
    blank = [F.lit(0).cast("bigint").alias(f.name) if f.name == "__rows" else F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    alone = df.sparkSession.range(1).select(*blank, F.lit(0).cast("bigint").alias("__weight"))
    return df.withColumn("__weight", weight.cast("bigint")).unionByName(alone)


def _without_blank(rolled: DataFrame, dims) -> DataFrame:
    total = F.lit(True)
    for c in dims:
        total = total & (F.col(f"__g_{c}") == 1)
    return rolled.filter((F.col("__weight") > 0) | total)


def _labelled(rolled, dims, keys, metrics, label, total_label, grouping_id) -> DataFrame:
    return rolled.select(
        *[_label(c, label, total_label) for c in dims],
        *keys,
        *[m.name for m in metrics],
        *([grouping_id] if grouping_id else []),
    )


def _narrow(df: DataFrame, group_cols: Sequence[str], metrics: Sequence[Metric]):
    inputs, rebound = [], []
    for i, m in enumerate(metrics):
        expr = m.input()
        if expr is None:
            rebound.append(m.on(None))
            continue
        inputs.append(expr.alias(f"__in{i}"))
        rebound.append(m.on(f"__in{i}"))
    return df.select(*group_cols, *inputs), rebound


def _partials(narrow: DataFrame, grain: Sequence[str], metrics: Sequence[Metric]) -> DataFrame:
    """One row per distinct ``grain``: each metric's partial plus the row count."""
    return narrow.groupBy(*grain).agg(*[m.partial() for m in metrics], F.count(F.lit(1)).alias("__rows"))


def _roll_partials(source, dims, keys, metrics, sets, label, total_label, grouping_id, merged=None) -> DataFrame:
    """Grouping sets over partial rows, merging partials with ``Metric.final``.

    ``merged`` optionally maps a metric name to a ready merge expression (used
    for metrics over dictionary columns that only exist after the join).
    """
    merged = merged or {}
    group_cols = list(dims) + list(keys)
    flags = [F.grouping(c).alias(f"__g_{c}") for c in dims]
    gid = [F.grouping_id().alias(grouping_id)] if grouping_id else []
    # Inside one partial row a dimension is constant, so its non-null count is
    # either all the rows behind it or none.
    counts = (
        [F.sum(F.when(F.col(c).isNotNull(), F.col("__rows")).otherwise(0)).alias(f"__n_{c}") for c in dims]
        if label == "count"
        else []
    )
    aggs = _final_metrics(source, metrics, merged)
    gsets = [list(s) + list(keys) for s in grouping_sets(dims, sets)]
    if _has_grand_total(dims, keys, sets):
        source = _with_blank(source, F.col("__rows"))
        rolled = source.groupingSets(gsets, *group_cols).agg(*aggs, *flags, *counts, *gid, F.sum("__weight").alias("__weight"))
        rolled = _without_blank(rolled, dims)
    else:
        rolled = source.groupingSets(gsets, *group_cols).agg(*aggs, *flags, *counts, *gid)
    return _labelled(rolled, dims, keys, metrics, label, total_label, grouping_id)


def _final_metrics(source: DataFrame, metrics: Sequence[Metric], merged: dict) -> list[Column]:
    """Each metric merged from partial rows, in the type it has over raw rows (a
    sum of decimal sums would otherwise be wider)."""
    out = []
    for m in metrics:
        if m.name in merged:
            kind = source.agg(m.column()).schema[m.name].dataType
            out.append(merged[m.name].cast(kind).alias(m.name))
        else:
            kind = source.schema[m._partial_name()].dataType
            out.append(m.final().cast(kind).alias(m.name))
    return out


def _reads_only(df: DataFrame, expr: Column) -> bool:
    try:
        df.select(expr).schema
        return True
    except Exception:
        return False


def _dictionary_merge(m: Metric) -> Column:
    """How a metric over a dictionary column merges joined partial rows, each
    standing for ``__rows`` fact rows that share the column's value."""
    c = F.col(m.source)
    if m.kind == "max":
        return F.max(c)
    if m.kind == "min":
        return F.min(c)
    if m.kind == "sum":
        return F.sum(c * F.col("__rows"))
    if m.kind == "count":
        return F.coalesce(F.sum(F.when(c.isNotNull(), F.col("__rows")).otherwise(0)), F.lit(0))
    raise ValueError(f"a {m.kind!r} metric over a dictionary column cannot be aggregated before the join")


class _JoinFirst(Exception):
    """A metric needs columns of both tables in one row, or the join keeps
    dictionary rows no fact row meets: join before aggregating."""


def _prepare_join_aggregation(fact, dictionary, on, group_cols, metrics, how="inner"):
    """Split metrics by side, reduce the fact to partial rows, and return
    (partial fact rows, dictionary columns to join, fact-side metrics rebound
    to the partial columns, merge expressions for dictionary-side metrics)."""
    if how not in ("inner", "left", "left_outer", "leftouter"):
        # An unmatched dictionary row stands for one joined row without fact
        # values, which no partial row can say.
        raise _JoinFirst(f"under a {how} join")
    on = [on] if isinstance(on, str) else list(on)
    fact_side = [c for c in group_cols if c in fact.columns]
    dict_cols = [c for c in group_cols if c not in fact.columns]
    fact_metrics, merged = [], {}
    for m in metrics:
        named = isinstance(m.source, str)
        if m.kind == "rows" or (m.source in fact.columns if named else _reads_only(fact, m.input())):
            fact_metrics.append(m)
        elif named and m.source in dictionary.columns and m.kind in ("max", "min", "sum", "count"):
            merged[m.name] = _dictionary_merge(m)
            dict_cols.append(m.source)
        else:
            raise _JoinFirst(m.name)
    missing = [c for c in dict_cols if c not in dictionary.columns]
    if missing:
        raise ValueError(f"columns in neither table: {missing}")
    grain = list(dict.fromkeys(fact_side + on))
    narrow, rebound = _narrow(fact, grain, fact_metrics)
    partial = _partials(narrow, grain, rebound)
    dict_keep = list(dict.fromkeys(on + [c for c in dict_cols if c not in on]))
    by_name = {m.name: m for m in rebound}
    ordered = [by_name.get(m.name, m) for m in metrics]
    return partial, dictionary.select(*dict_keep), on, ordered, merged


def totals_over_join(
    fact: DataFrame,
    dictionary: DataFrame,
    on,
    dims: Sequence[str],
    metrics: Sequence[Metric],
    sets="pairs",
    label: str = "count",
    keys: Sequence[str] = (),
    how: str = "inner",
    total_label: str = "Total",
    grouping_id: str | None = None,
    **join_options,
) -> DataFrame:
    """Totals of ``fact`` enriched by ``dictionary``, aggregating before the join.

    The fact rows are first reduced to one partial row per distinct
    (fact-side dimensions, join key); only those partial rows meet the
    dictionary, and the grouping sets roll the joined partials up. The result
    equals ``totals(enrich(fact, dictionary, on), ...)``, including the row
    multiplication an inner join gives duplicate dictionary keys, because each
    partial row is duplicated exactly as its member rows would have been.

    At scale this is the plan to use: the map-side partial aggregate collapses
    a hot join key (one key holding a third of the rows becomes one row per
    map task) before any shuffle, and the join then moves partial rows, not
    fact rows. Dimensions may come from either side. Metrics over fact columns
    may be any expression; metrics over a dictionary column may be max, min,
    sum or count of that column. A metric that needs both tables in one row
    (say a sum of a fact value under a condition on a dictionary column) makes
    the plan join first and aggregate after, with the same result, and so does
    a right or full outer join. Result types are those of the direct plan.
    """
    dims, keys = list(dims), list(keys)
    _check_columns(dims, keys, metrics, label)
    try:
        partial, dict_cols, on, rebound, merged = _prepare_join_aggregation(fact, dictionary, on, dims + keys, metrics, how)
    except _JoinFirst:
        joined_rows = enrich(fact, dictionary, on, how, **join_options)
        return totals(joined_rows, dims, metrics, sets, label, keys, total_label=total_label, grouping_id=grouping_id)
    joined = enrich(partial, dict_cols, on, how, **join_options)
    return _roll_partials(joined, dims, keys, rebound, sets, label, total_label, grouping_id, merged)


def group_over_join(
    fact: DataFrame,
    dictionary: DataFrame,
    on,
    keys: Sequence[str],
    metrics: Sequence[Metric],
    how: str = "inner",
    **join_options,
) -> DataFrame:
    """One grouping level of ``fact`` enriched by ``dictionary``, aggregating
    before the join (see ``totals_over_join``); no ``Expand`` is involved."""
    keys = list(keys)
    try:
        partial, dict_cols, on, rebound, merged = _prepare_join_aggregation(fact, dictionary, on, keys, metrics, how)
    except _JoinFirst:
        return group_metrics(enrich(fact, dictionary, on, how, **join_options), keys, metrics)
    joined = enrich(partial, dict_cols, on, how, **join_options)
    return joined.groupBy(*keys).agg(*_final_metrics(joined, rebound, merged))


def partial_totals(
    fact: DataFrame,
    dictionary: DataFrame,
    on,
    dims: Sequence[str],
    metrics: Sequence[Metric],
    keys: Sequence[str] = (),
    how: str = "inner",
    **join_options,
) -> DataFrame:
    """The partial rows ``totals_over_join`` rolls up, as a table of their own.

    One row per distinct (fact-side dimensions and keys, join key) joined to
    its dictionary row: the grouping columns, any dictionary columns the
    metrics read, ``__p_<metric>`` partials and ``__rows``. Because every
    metric here is decomposable, partial tables of different batches can be
    stored, appended and rolled up together with ``totals_from_partials``, so
    a day's update costs in proportion to the day's rows, not the history.
    """
    dims, keys = list(dims), list(keys)
    try:
        partial, dict_cols, on, _, _ = _prepare_join_aggregation(fact, dictionary, on, dims + keys, metrics, how)
    except _JoinFirst as e:
        raise ValueError(f"metric {e}: needs both tables in one row, it has no partial form") from e
    return enrich(partial, dict_cols, on, how, **join_options)


def _partial_merges(partials: DataFrame, metrics: Sequence[Metric]) -> dict:
    merged = {}
    for m in metrics:
        if m._partial_name() in partials.columns:
            continue
        if isinstance(m.source, str) and m.source in partials.columns:
            merged[m.name] = _dictionary_merge(m)
        else:
            raise ValueError(f"partial rows carry nothing for metric {m.name!r}")
    return merged


def totals_from_partials(
    partials: DataFrame,
    dims: Sequence[str],
    metrics: Sequence[Metric],
    sets="pairs",
    label: str = "count",
    keys: Sequence[str] = (),
    total_label: str = "Total",
    grouping_id: str | None = None,
) -> DataFrame:
    """Totals rolled up from (any union of) ``partial_totals`` tables."""
    dims, keys = list(dims), list(keys)
    _check_columns(dims, keys, metrics, label)
    merged = _partial_merges(partials, metrics)
    return _roll_partials(partials, dims, keys, list(metrics), sets, label, total_label, grouping_id, merged)


def compact_partials(partials: DataFrame, metrics: Sequence[Metric]) -> DataFrame:
    """Merge partial rows that share their grain (for example after appending
    a batch), keeping the partial-table shape."""
    value_cols = {m._partial_name() for m in metrics} | {"__rows"}
    grain = [c for c in partials.columns if c not in value_cols]
    merges = [
        m.merge().cast(partials.schema[m._partial_name()].dataType).alias(m._partial_name())
        for m in metrics if m._partial_name() in partials.columns
    ]
    return partials.groupBy(*grain).agg(*merges, F.sum("__rows").alias("__rows")).select(*partials.columns)


def totals_union(
    df: DataFrame,
    dims: Sequence[str],
    metrics: Sequence[Metric],
    sets="pairs",
    label: str = "count",
    keys: Sequence[str] = (),
    total_label: str = "Total",
) -> DataFrame:
    """The same result built as one aggregate per set, unioned by name.

    This is the shape the scripted variants use. It reads the input once per
    set, so ``totals`` is preferred; it stays as a reference form for tests and
    benches. Dimensions are cast to string before the union, so a count label
    and a text value never have to be reconciled by the union's type coercion.
    """
    dims, keys = list(dims), list(keys)
    parts = []
    for kept, rolled in complements(dims, sets):
        agg = df.groupBy(*kept, *keys).agg(
            *[m.column() for m in metrics], *[F.count(c).alias(f"__n_{c}") for c in rolled]
        )
        shown = []
        for c in dims:
            if c in kept:
                shown.append(F.col(c).cast("string").alias(c))
            elif label == "count":
                shown.append(F.col(f"__n_{c}").cast("string").alias(c))
            elif label == "total":
                shown.append(F.lit(total_label).alias(c))
            else:
                shown.append(F.lit(None).cast("string").alias(c))
        parts.append(agg.select(*shown, *keys, *[m.name for m in metrics]))
    return reduce(DataFrame.unionByName, parts)


def group_metrics(df: DataFrame, keys: Sequence[str], metrics: Sequence[Metric]) -> DataFrame:
    """One grouping level: ``keys`` followed by the metrics."""
    return df.groupBy(*keys).agg(*[m.column() for m in metrics])


def grand_total(df: DataFrame, metrics: Sequence[Metric]) -> DataFrame:
    """The metrics over all rows: one row."""
    return df.agg(*[m.column() for m in metrics])
