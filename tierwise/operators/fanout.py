"""One row to many through a user's generator, where no array expression fits.

``explode`` over an array expression stays inside the JVM and is the form to use wherever
an expression can say which rows come out. A generator in Python is for the rest: it
runs row by row inside ``mapInArrow``, so it keeps the scan's partitioning and shuffles
nothing; rows go to Python and back in Arrow batches, never one batch per row, and a task
holds ``BATCH`` made rows at a time, however many one row yields.

Plain values (see ``PLAIN``) are the same in Arrow and Spark. Where a generator takes or
makes others, as timestamps, arrays or structs, a lateral join with a table function lets
Spark convert them, pickled, at about twice the time a row.
"""

from __future__ import annotations

from itertools import repeat
from typing import Callable, Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

BATCH = 10_000
PLAIN = (T.BooleanType, T.IntegralType, T.FloatType, T.DoubleType, T.DecimalType, T.StringType, T.BinaryType, T.DateType)
CARRIED = (*PLAIN, T.TimestampType, T.TimestampNTZType)


def fan_out(df: DataFrame, generator: Callable[..., Iterable[tuple]], returns: str, inputs: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` of every row beside each tuple of ``returns`` (DDL) that ``generator(*inputs)`` yields;
    rows for which it yields none are dropped."""
    made, taken, kept = T.StructType.fromDDL(returns), df.select(*inputs).schema, df.select(*keep).schema
    plain = all(isinstance(f.dataType, PLAIN) for f in [*made, *taken])
    if not plain or not all(isinstance(f.dataType, CARRIED) for f in kept):
        return _fan_out_joined(df, generator, returns, inputs, keep)
    columns = [F.col(c).alias(f"__{i}") for i, c in enumerate([*inputs, *keep])]
    return df.select(*columns).mapInArrow(_generate(generator, made, len(inputs)), T.StructType([*kept.fields, *made.fields]))


def _values(column: pa.Array) -> list:
    """A column's values in Python: through numpy where that gives the same ones, as it is faster."""
    number = pa.types.is_integer(column.type) or pa.types.is_floating(column.type)
    if pa.types.is_string(column.type) or number and not column.null_count:
        return column.to_numpy(zero_copy_only=False).tolist()
    return column.to_pylist()


def _generate(generator: Callable[..., Iterable[tuple]], made: T.StructType, n_inputs: int):
    types = [to_arrow_type(f.dataType) for f in made]

    def run(batches):
        def out(kept, rows, tuples):
            columns = [pa.array(c, t) for c, t in zip(zip(*tuples, strict=True), types, strict=True)]
            columns = [*kept.take(pa.array(rows, pa.int64())).columns, *columns]
            return pa.RecordBatch.from_arrays(columns, [f"__{i}" for i in range(len(columns))])

        for batch in batches:
            kept = batch.select(list(range(n_inputs, batch.num_columns)))
            inputs = [_values(batch.column(i)) for i in range(n_inputs)]
            rows: list[int] = []
            tuples: list[tuple] = []
            for row, values in enumerate(zip(*inputs) if inputs else repeat((), batch.num_rows)):
                for made_row in generator(*values):
                    rows.append(row)
                    tuples.append(made_row)
                    if len(rows) == BATCH:
                        yield out(kept, rows, tuples)
                        rows, tuples = [], []
            if rows:
                yield out(kept, rows, tuples)

    return run


def _fan_out_joined(df, generator, returns, inputs, keep) -> DataFrame:
    class Generate:
        def eval(self, *values):
            yield from generator(*values)

    made = F.udtf(Generate, returnType=returns, useArrow=False)
    joined = df.lateralJoin(made(*[F.col(c).outer() for c in inputs]))
    names = [c for c in joined.columns if c not in df.columns]
    return joined.select(*keep, *names)


def keyed_levels(*dims) -> Iterable[tuple]:
    """(level, key) of a record at every single dimension and every pair, dimensions that are null left out."""
    for i, a in enumerate(dims):
        if a is None:
            continue
        yield str(i), str(a)
        for j in range(i + 1, len(dims)):
            if dims[j] is not None:
                yield f"{i}{j}", f"{a}|{dims[j]}"
