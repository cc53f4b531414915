"""File sources: delimited text, JSON records, and tolerant reads.

Every reader takes a declared schema. Schema inference stays available
(``infer=True``) but costs an extra pass over the data, so it is off by default.
CSV records may end in ``\\n``, ``\\r\\n`` or a bare ``\\r``; Spark's reader
accepts all three.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import all_strings
from .pieces import read_pieces

EXTRA = "_extra"


def read_csv(
    spark: SparkSession,
    path,
    schema: T.StructType | None = None,
    header: bool = True,
    infer: bool = False,
    mode: str | None = None,
    **options,
) -> DataFrame:
    """Delimited text with a header row, typed by ``schema`` (or inferred).

    With a declared schema the read fails on a field that does not parse
    (``FAILFAST``) instead of silently turning it into null; dirty input goes
    through ``read_csv_tolerant`` and the validator, which report every fault.
    """
    reader = spark.read.option("header", header)
    if schema is not None:
        reader = reader.schema(schema).option("mode", mode or "FAILFAST")
    elif mode:
        reader = reader.option("mode", mode)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.options(**options).csv(path)


def read_json_records(spark: SparkSession, path, schema: T.StructType | None = None, **options) -> DataFrame:
    """A JSON document holding an array of records (one document per file)."""
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**options).json(path)


def read_json_lines(spark: SparkSession, path, schema: T.StructType | None = None, **options) -> DataFrame:
    """One JSON record per line; splittable, the form to use for large inputs."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**options).json(path)


def field_pattern(sep: str = ",", escape: str = "\\") -> str:
    """Regular expression of one field behind its separator, quoted or plain;
    ``escape`` is what makes a quote part of a quoted field."""
    s, e = re.escape(sep), re.escape(escape)
    inside = '[^"]|""' if escape == '"' else f'[^"{e}]|{e}.'
    return f'(?s){s}("(?:{inside})*+"(?:(?!{s}).)*+|(?:(?!{s}).)*+)'


def count_fields(line: Column, sep: str = ",", escape: str = "\\") -> Column:
    """Number of fields of a delimited record; separators inside quotes do not count."""
    plain = F.length(line) - F.length(F.replace(line, F.lit(sep), F.lit(""))) + len(sep)
    quoted = F.regexp_count(F.concat(F.lit(sep), line), F.lit(field_pattern(sep, escape)))
    return F.when(F.contains(line, F.lit('"')), quoted).otherwise((plain / len(sep)).cast("int"))


def well_quoted(record: Column, sep: str = ",") -> Column:
    """Whether every field is plain without a quote, or quoted as a whole with inner quotes doubled."""
    s = re.escape(sep)
    field = f'(?:"[^"]*+(?:""[^"]*+)*+"|[^"{s}]*+)'
    return ~F.contains(record, F.lit('"')) | record.rlike(f"(?s)\\A{field}(?:{s}{field})*+\\z")


def read_csv_multiline(
    spark: SparkSession, path, schema: T.StructType, header: bool = True, sep: str = ",", line_sep: str = "\n", **options
) -> DataFrame:
    """``read_csv_tolerant`` for files whose quoted fields hold line breaks, still read by
    byte ranges in many tasks (see ``sources.pieces``; Spark's own ``multiLine`` reads a
    file in one).

    Quotes are doubled inside quoted fields and are paired from a file's beginning, as
    in any such reader. A record is bad, and kept whole in ``_extra``, if it has too many
    fields, if a field's quotes are broken (text before or behind a quoted field, or a
    quote that is not closed), or if it spans more byte ranges than a record may: then
    each of its fragments is a bad record. Empty records and, with ``header``, those
    that are the field names are dropped. ``\\r`` before a record's end is not part of it.
    """
    pieces = read_pieces(spark, path, line_sep, '"')
    value = F.when(F.right("value", F.lit(1)) == "\r", F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    records = pieces.select(value.alias("value"), "broken").filter(F.col("value") != "")
    if header:
        records = records.filter(F.col("value") != sep.join(schema.fieldNames()))
    fields = F.from_csv(
        F.col("value"), ", ".join(f"`{n}` string" for n in schema.fieldNames()),
        {"mode": "PERMISSIVE", "sep": sep, "escape": '"', "multiLine": "true", **options},
    )
    bad = F.col("broken") | ~well_quoted(F.col("value"), sep) | (count_fields(F.col("value"), sep, '"') > len(schema))
    return records.select(F.when(~bad, fields).alias("__r"), F.when(bad, F.col("value")).alias(EXTRA)).select(
        *[F.col(f"__r.`{c}`") for c in schema.fieldNames()], EXTRA
    )


def read_csv_tolerant(spark: SparkSession, path, schema: T.StructType, header: bool = True, **options) -> DataFrame:
    """Every field as text plus ``_extra``: the whole raw line of a record with more
    fields than the schema, which makes it a bad line, else null.

    Lines are read as text and their fields counted before they are parsed, so
    an empty last field counts and nothing of a bad line is lost. A record with
    fewer fields is padded with nulls and left to the validator, as a reader
    that only skips over-long lines would do. Type errors are not detected here;
    fields stay text so a validator can report them. Empty lines and, with
    ``header``, lines that are the field names are dropped. Quoted fields may hold
    separators, not line breaks: ``read_csv_multiline`` takes those.
    """
    sep = options.get("sep", options.get("delimiter", ","))
    text_schema = all_strings(schema)
    lines = spark.read.text(path).filter(F.col("value") != "")
    if header:
        lines = lines.filter(F.col("value") != sep.join(schema.fieldNames()))
    parsed = F.from_csv(F.col("value"), text_schema.simpleString()[len("struct<"):-1].replace(":", " "), {"mode": "PERMISSIVE", **options})
    fields = count_fields(F.col("value"), sep, options.get("escape", "\\"))
    long = F.when(fields > len(schema), F.col("value"))
    return lines.select(parsed.alias("__r"), long.alias(EXTRA)).select(*[F.col(f"__r.{c}") for c in schema.fieldNames()], EXTRA)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(well_formed_rows, bad_lines)`` of a tolerant read.

    Bad lines keep their first fields, parsed, and ``raw_line``, the line as it stands in the file.
    """
    fields = [c for c in df.columns if c != EXTRA]
    good = df.filter(F.col(EXTRA).isNull()).drop(EXTRA)
    bad = df.filter(F.col(EXTRA).isNotNull()).select(*fields, F.col(EXTRA).alias("raw_line"))
    return good, bad


def read_records_text(spark: SparkSession, path, record_sep: str = "\r") -> DataFrame:
    """Raw records split on ``record_sep``, one row each (column ``value``)."""
    return spark.read.option("lineSep", record_sep).text(path)
