"""Row validation into a reject table.

Validation is structural, as in the typed-record check it mirrors: integer
fields must hold integer text, text fields are not checked, and a required
column missing from the input makes every row invalid. Fields of any other
type must be present and cast cleanly to it (reason ``not a <type>``). All rules are column
expressions evaluated inside the scan's code-generated stage; no row goes
through Python.

Integer rule: the trimmed text matches ``^[+-]?[0-9]+$`` and fits the
field's integer type (64 bits for the invoice record). (Python's ``int()`` also accepts ``1_0`` and non-ASCII digits;
this rule does not.)

Output of ``validate``: the input columns plus

* ``valid``         true when no rule fails;
* ``first_reason``  the first failing field's reason in schema order (the one
                    a record constructor stops at), or null;
* ``errors``        array of ``struct(column, raw_value, reason)`` in schema
                    field order, empty for a valid row.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import store
from .joins import checked_broadcast
from .numbering import running_sum

# The integer-text pattern, what is trimmed, and the reason texts.
INTEGER_TEXT = r"^[+-]?[0-9]+$"
WHITE_SPACE = " \t\n\r\x0b\x0c"
REASON_MISSING_VALUE = "missing value"
REASON_NOT_INTEGER = "not an integer"
REASON_OUT_OF_RANGE = "integer out of range"
REASON_MISSING_COLUMN = "missing column"
REASON_NOT_ALLOWED = "not an allowed value"

ERROR = T.StructType(
    [
        T.StructField("column", T.StringType()),
        T.StructField("raw_value", T.StringType()),
        T.StructField("reason", T.StringType()),
    ]
)


def integer_reason(text: Column, target: T.DataType = T.LongType()) -> Column:
    """Null when ``text`` is valid integer text for ``target``, else the reason it is not.

    The pattern test runs first and guards the bigint cast, so the cast only
    ever sees well-formed digits and merely catches values out of range. (A
    failing cast throws inside the JVM: casting first is faster on clean data
    but twice as slow once a sizeable share of rows is dirty; testing the
    pattern first costs the same either way.)
    """
    trimmed = F.btrim(text, F.lit(WHITE_SPACE))
    return (
        F.when(text.isNull(), F.lit(REASON_MISSING_VALUE))
        .when(~trimmed.rlike(INTEGER_TEXT), F.lit(REASON_NOT_INTEGER))
        .when(trimmed.try_cast(target).isNull(), F.lit(REASON_OUT_OF_RANGE))
    )


def typed_reason(text: Column, target: T.DataType) -> Column:
    """Null when ``text`` casts to ``target`` (after trimming), else the reason."""
    return F.when(text.isNull(), F.lit(REASON_MISSING_VALUE)).when(
        F.btrim(text, F.lit(WHITE_SPACE)).try_cast(target).isNull(), F.lit(f"not a {target.simpleString()}")
    )


def _is_integer_type(dt: T.DataType) -> bool:
    return isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def _checked_fields(df: DataFrame, schema: T.StructType, rules: dict | None = None):
    """(field, raw text column, reason expression) for every field with a rule."""
    rules = rules or {}
    unknown = [name for name in rules if name not in schema.fieldNames()]
    if unknown:
        raise ValueError(f"rules name fields outside the schema: {unknown}")
    out = []
    for field in schema.fields:
        if field.name not in df.columns:
            out.append((field.name, F.lit(None).cast("string"), F.lit(REASON_MISSING_COLUMN)))
            continue
        raw = F.col(field.name).cast("string")
        if _is_integer_type(field.dataType):
            reason = integer_reason(raw, field.dataType)
        elif not isinstance(field.dataType, T.StringType):
            reason = typed_reason(raw, field.dataType)
        else:
            reason = None
        if field.name in rules:
            # A domain rule is checked once the field's type is right; a null
            # rule result (for example on a null value) counts as a failure.
            broken = F.when(F.coalesce(rules[field.name], F.lit(False)), F.lit(None)).otherwise(F.lit(REASON_NOT_ALLOWED))
            reason = broken if reason is None else F.coalesce(reason, broken)
        if reason is not None:
            out.append((field.name, raw, reason))
    return out


def validate(df: DataFrame, schema: T.StructType, rules: dict | None = None) -> DataFrame:
    """Attach ``valid``, ``first_reason`` and ``errors`` to every row of ``df``.

    ``df`` holds the fields as text (see ``sources.read_csv_tolerant``).
    ``rules`` optionally maps a field name to a condition that must hold (a
    domain set such as ``F.col("status").isin("ARAP", "ACCR")``); validation
    stays structural without it. The flag reads the reasons only, so rows that
    a filter on ``valid`` drops never build the error array.
    """
    checked = _checked_fields(df, schema, rules)
    reason_cols = [f"_reason_{name}" for name, _, _ in checked]
    with_reasons = df.select("*", *[reason.alias(rc) for (_, _, reason), rc in zip(checked, reason_cols)])
    errors = [
        F.when(
            F.col(rc).isNotNull(),
            F.struct(F.lit(name).alias("column"), raw.alias("raw_value"), F.col(rc).alias("reason")),
        )
        for (name, raw, _), rc in zip(checked, reason_cols)
    ]
    valid = F.lit(True)
    for rc in reason_cols:
        valid = valid & F.col(rc).isNull()
    return with_reasons.select(
        *df.columns,
        valid.alias("valid"),
        (F.coalesce(*[F.col(rc) for rc in reason_cols]) if reason_cols else F.lit(None).cast("string")).alias(
            "first_reason"
        ),
        (F.array_compact(F.array(*errors)) if errors else F.array().cast(T.ArrayType(ERROR))).alias("errors"),
    )


def valid_rows(validated: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows without errors, cast to ``schema``."""
    ok = validated.filter(F.col("valid"))
    typed = []
    for f in schema.fields:
        c = F.col(f.name) if isinstance(f.dataType, T.StringType) else F.btrim(F.col(f.name), F.lit(WHITE_SPACE))
        typed.append(c.cast(f.dataType).alias(f.name))
    return ok.select(*typed)


def invalid_rows(validated: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per invalid input row: ``keys``, ``n_errors``, ``first_reason``."""
    bad = validated.filter(~F.col("valid"))
    return bad.select(*keys, F.size("errors").alias("n_errors"), "first_reason")


def rejects(validated: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The reject table: one row per failing field, ``keys`` + column, raw value, reason."""
    # Exploded without a filter on the flag first, which would check every field once more.
    return validated.select(*keys, F.explode_outer("errors").alias("e")).filter(F.col("e").isNotNull()).select(
        *keys,
        F.col("e.column").alias("column"),
        F.col("e.raw_value").alias("raw_value"),
        F.col("e.reason").alias("reason"),
    )


def with_position(df: DataFrame, name: str = "position") -> DataFrame:
    """Add the 1-based position of each row in file order (files by path).

    ``df`` must be a file read, possibly filtered, with no shuffle in between:
    positions count the rows that are left, as a reader that skips bad lines
    numbers its rows. Rows are tagged in the scan stage with a hash of their
    file split (``_metadata``) and a per-partition counter. Rows per split are
    counted by one aggregate; a two-level running sum over the files
    (``operators.numbering``; no window over all of them in one task) and one
    within each file give every split's offset, a narrow table that is
    broadcast if it passes the size check.
    """
    try:
        df.select("_metadata.file_path").schema
    except Exception as e:
        raise ValueError("with_position needs rows read from files (a file scan, possibly filtered)") from e
    file, start = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    split = [F.xxhash64(file, start).alias("__split"), F.hash(start, file).alias("__check")]
    rowid = F.monotonically_increasing_id().alias("__rowid")
    counted = store(df.sparkSession, df.select(file.alias("__file"), start.alias("__start"), *split, rowid).groupBy(
        "__file", "__start", "__split", "__check"
    ).agg(F.count(F.lit(1)).alias("__n"), F.min("__rowid").alias("__first")), "split-counts")
    per_file = counted.groupBy("__file").agg(F.sum("__n").alias("__rows"))
    before_file = running_sum(per_file, ["__file"], F.col("__rows"), "__files").select("__file", "__files")
    within = Window.partitionBy("__file").orderBy("__start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.join(before_file, "__file").select(
        "__split", "__check",
        (F.col("__files") + F.coalesce(F.sum("__n").over(within), F.lit(0)) - F.col("__first") + 1).alias("__offset"),
    )
    offsets, _ = checked_broadcast(offsets)
    tagged = df.select("*", *split, rowid)
    return tagged.join(offsets, ["__split", "__check"]).withColumn(name, F.col("__offset") + F.col("__rowid")).drop(
        "__split", "__check", "__rowid", "__offset"
    )
