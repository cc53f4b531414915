"""User-defined combiners: create, add, merge and extract, as Arrow partials and merges.

For aggregates that no built-in expresses. A combiner's accumulator is a row of a
declared schema, so partials are typed Arrow columns, not pickled objects:

1. every task keeps an accumulator per key it meets, adds its rows batch by batch (all
   rows of a key in a batch in one call, as arrays) and hands on a partial row per
   key, at the end or when ``max_groups`` keys are held: a hot key costs a row per
   task, and memory does not grow with the number of keys;
2. partial rows are shuffled by key, sorted, and merged as they stream by.

``merge`` must not care for order or grouping. Null keys are keys like any others.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Combiner:
    """``create()`` gives an accumulator (a tuple of ``state``'s fields); ``add(acc, columns)``
    adds a key's rows, given as a list of Arrow arrays, one per input column;
    ``merge(a, b)`` joins two accumulators; ``extract(acc)`` gives the result, a value
    of ``result``. Both types are DDL text or Spark types."""

    create: Callable[[], tuple]
    add: Callable[[tuple, list[pa.Array]], tuple]
    merge: Callable[[tuple, tuple], tuple]
    extract: Callable[[tuple], object]
    state: object
    result: object


def _fields(state) -> list[T.StructField]:
    kind = T.StructType.fromDDL(state) if isinstance(state, str) else state
    return [T.StructField(f"__a{i}", f.dataType) for i, f in enumerate(kind.fields)]


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _batch(rows, schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _partial(combiner: Combiner, n_keys: int, schema: pa.Schema, max_groups: int):
    def run(batches):
        held: dict[tuple, tuple] = {}
        for batch in batches:
            keys = list(zip(*[batch.column(i).to_pylist() for i in range(n_keys)])) if n_keys else [()] * batch.num_rows
            codes: dict[tuple, int] = {}
            code = np.fromiter((codes.setdefault(k, len(codes)) for k in keys), np.int64, len(keys))
            order = np.argsort(code, kind="stable")
            cuts = np.searchsorted(code[order], np.arange(len(codes) + 1))
            sorted_rows = batch.take(pa.array(order))
            columns = [sorted_rows.column(i) for i in range(n_keys, batch.num_columns)]
            for key, at in codes.items():
                a, b = int(cuts[at]), int(cuts[at + 1])
                acc = held[key] if key in held else combiner.create()
                held[key] = combiner.add(acc, [c.slice(a, b - a) for c in columns])
            if len(held) >= max_groups:
                yield _batch([(*k, *acc) for k, acc in held.items()], schema)
                held = {}
        if held:
            yield _batch([(*k, *acc) for k, acc in held.items()], schema)

    return run


def _merged(combiner: Combiner, n_keys: int, schema: pa.Schema):
    def run(batches):
        now, acc, out = None, None, []
        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(batch.num_columns)]):
                key, part = row[:n_keys], row[n_keys:]
                if acc is not None and key == now:
                    acc = combiner.merge(acc, part)
                    continue
                if acc is not None:
                    out.append((*now, combiner.extract(acc)))
                now, acc = key, part
                if len(out) >= 10_000:
                    yield _batch(out, schema)
                    out = []
        if acc is not None:
            out.append((*now, combiner.extract(acc)))
        if out:
            yield _batch(out, schema)

    return run


def combine_by(
    df: DataFrame, keys: Sequence[str] | str, inputs: Sequence[str], combiner: Combiner, name: str, max_groups: int = 100_000
) -> DataFrame:
    """``keys`` and ``name``, the combiner's result over ``inputs``, one row per distinct key."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if not keys:
        raise ValueError("combine_by needs a key column")
    key_fields = [df.schema[k] for k in keys]
    partial = T.StructType(key_fields + _fields(combiner.state))
    result = combiner.result if isinstance(combiner.result, T.DataType) else T.DataType.fromDDL(combiner.result)
    final = T.StructType([*key_fields, T.StructField(name, result)])
    parts = df.select(*keys, *inputs).mapInArrow(_partial(combiner, len(keys), _arrow(partial), max_groups), partial)
    sorted_parts = parts.repartition(*keys).sortWithinPartitions(*keys)
    return sorted_parts.mapInArrow(_merged(combiner, len(keys), _arrow(final)), final)


def _second_moment_add(acc, columns):
    values = columns[0].drop_null().to_numpy(zero_copy_only=False).astype(np.float64)
    if not len(values):
        return acc
    mean = float(values.mean())
    return _second_moment_merge(acc, (len(values), mean, float(((values - mean) ** 2).sum())))


def _second_moment_merge(a, b):
    n = a[0] + b[0]
    if not n:
        return a
    gap = b[1] - a[1]
    return n, a[1] + gap * b[0] / n, a[2] + b[2] + gap * gap * a[0] * b[0] / n


def second_moment() -> Combiner:
    """Population variance of one column by mergeable (count, mean, squared distances from the
    mean), which does not lose digits as sums of squares do; null for no values."""
    return Combiner(
        create=lambda: (0, 0.0, 0.0), add=_second_moment_add, merge=_second_moment_merge,
        extract=lambda acc: acc[2] / acc[0] if acc[0] else None, state="n long, mean double, m2 double", result="double",
    )
