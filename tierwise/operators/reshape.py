"""Flat-cell reshaping: text holding many records' cells becomes typed rows.

Two forms:

* ``records_from_cells`` works on a text column. Record separators are turned
  into cell separators, the text is split into cells, the first ``skip`` cells
  (a header) are dropped, and of the rest every ``width`` cells are one output
  row. The cells are made once per text, and its rows take theirs by place
  (``replace``, ``split``, ``explode`` over the row numbers, ``get``).
* ``read_flat_records`` reads files whose records are separated by a bare
  ``\\r`` (or any separator) as a splittable text source, one record per row,
  so no file is ever held as one value. Header records are recognised by
  their text and dropped.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.files import count_fields, field_pattern, read_records_text
from ..sources.pieces import read_pieces


def cells(text: Column, sep: str = ",", record_sep: str = "\r") -> Column:
    """All cells of ``text`` as one array, records joined end to end.

    ``record_sep`` is a regular expression; separators at the very end of the
    text are dropped first, as a line reader drops the final line break.
    """
    body = F.regexp_replace(text, f"(?:{record_sep})+$", "")
    if not record_sep or _regex_literal(record_sep) != record_sep:
        return F.split(F.regexp_replace(body, record_sep, sep), _regex_literal(sep))
    # A plain separator needs no expression, and ``$``, which may stand before a final
    # line break of one or two characters, finds none that the text's end does not show.
    end = F.right(text, F.lit(len(record_sep) + 2))
    body = F.when(F.contains(end, F.lit(record_sep)), body).otherwise(text)
    return F.split(F.replace(body, F.lit(record_sep), F.lit(sep)), _regex_literal(sep))


def _regex_literal(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch for ch in s)


def chunks(cell_array: Column, width: int, skip: int = 0) -> Column:
    """``cell_array`` without its first ``skip`` cells, cut into arrays of ``width``.

    A trailing chunk shorter than ``width`` is kept as it is; ``to_rows`` pads
    it with nulls.
    """
    n = F.size(cell_array) - F.lit(skip)
    count = F.greatest(F.ceil(n / F.lit(width)).cast("int"), F.lit(0))
    starts = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.slice(cell_array, i * width + skip + 1, width))


def to_rows(df: DataFrame, chunk_col: str, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Explode an array-of-chunks column into one row per chunk with named fields."""
    exploded = df.select(*keep, F.explode(chunk_col).alias("__cells"))
    return exploded.select(*keep, *[F.get(F.col("__cells"), i).alias(n) for i, n in enumerate(names)])


def records_from_cells(
    df: DataFrame,
    text_col: str,
    names: Sequence[str],
    skip: int = 0,
    sep: str = ",",
    record_sep: str = "\r",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Reshape the flat text in ``text_col`` into rows of ``len(names)`` text fields.

    Works per value: over a whole-file text column (``wholetext``) each file is
    one value held by one task, so for large files use ``read_flat_records``,
    which splits on record separators while reading.
    """
    width = len(names)
    cut = df.select(*keep, cells(F.col(text_col), sep, record_sep).alias("__cells"))
    count = F.ceil((F.size("__cells") - F.lit(skip)) / F.lit(width)).cast("int")
    numbered = cut.select(*keep, "__cells", F.explode(F.when(count > 0, F.sequence(F.lit(0), count - 1))).alias("__row"))
    first = F.col("__row") * width + skip
    return numbered.select(*keep, *[F.get(F.col("__cells"), first + i).alias(n) for i, n in enumerate(names)])


def _record_cells(record: Column, sep: str) -> Column:
    """A record's cells; quoted ones may hold the separator and lose their quotes."""
    found = F.regexp_extract_all(F.concat(F.lit(sep), record), F.lit(field_pattern(sep)), F.lit(1))
    bare = F.transform(
        found,
        lambda c: F.when(c.rlike('^".*"$'), F.regexp_replace(F.substring(c, F.lit(2), F.length(c) - 2), r"\\\\(.)", "$1")).otherwise(c),
    )
    return F.when(F.contains(record, F.lit('"')), bare).otherwise(F.split(record, _regex_literal(sep)))


def split_flat_records(
    spark: SparkSession,
    path,
    schema: T.StructType,
    sep: str = ",",
    record_sep: str = "\r",
    header: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)`` of records separated by ``record_sep`` with cells separated by ``sep``.

    A record holding several rows' worth of cells is cut into
    ``len(schema)``-cell chunks, typed by ``schema``. Header records (the field
    names joined by ``sep``) are dropped wherever they occur. Rejects are
    (``record``, ``reason``): records whose number of cells is no multiple of the
    schema's, and rows with a cell that does not cast.
    """
    names = [f.name for f in schema.fields]
    width = len(names)
    text = read_records_text(spark, path, record_sep)
    # A final line break left on the last record is not part of its text.
    value = F.rtrim(F.col("value"), F.lit("\r\n"))
    text = text.select(value.alias("value")).filter(F.length("value") > 0)
    if header:
        text = text.filter(F.col("value") != F.lit(sep.join(names)))
    n = count_fields(F.col("value"), sep)
    arr = _record_cells(F.col("value"), sep)
    per_row = F.when(n <= width, F.array(arr)).otherwise(chunks(arr, width))
    whole = text.filter(n % width == 0)
    cut = to_rows(whole.select(per_row.alias("__chunks")), "__chunks", names)
    cast = {f.name: F.nullif(F.col(f.name), F.lit("")).try_cast(f.dataType) for f in schema.fields if not isinstance(f.dataType, T.StringType)}
    wrong = F.lit(False)
    for name, typed in cast.items():
        wrong = wrong | ((F.col(name) != "") & typed.isNull())
    rows = cut.filter(~F.coalesce(wrong, F.lit(False))).select(*[cast.get(c, F.col(c)).alias(c) for c in names])
    bad_rows = cut.filter(F.coalesce(wrong, F.lit(False))).select(
        F.concat_ws(sep, *names).alias("record"), F.lit("a cell does not cast").alias("reason")
    )
    bad_width = text.filter(n % width != 0).select(F.col("value").alias("record"), F.lit("wrong number of cells").alias("reason"))
    return rows, bad_width.unionByName(bad_rows)


def read_flat_records(
    spark: SparkSession, path, schema: T.StructType, sep: str = ",", record_sep: str = "\r", header: bool = True
) -> DataFrame:
    """The rows of ``split_flat_records``."""
    return split_flat_records(spark, path, schema, sep, record_sep, header)[0]


def _bare(cell: Column) -> Column:
    """A cell without the quotes around it, inner ones no longer doubled."""
    whole = F.startswith(cell, F.lit('"')) & ((F.endswith(cell, F.lit('"')) & (F.length(cell) > 1)) | cell.rlike('(?s)^".*"$'))
    return F.when(whole, F.replace(F.substring(cell, F.lit(2), F.length(cell) - 2), F.lit('""'), F.lit('"'))).otherwise(cell)


def split_endless_line(
    spark: SparkSession, path, schema: T.StructType, sep: str = ",", header: bool = True, quote: str = '"', **options
) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)`` of files that are one endless line of cells: no separator parts
    the records, every ``len(schema)`` cells of a file are one (the header, if any, the first).

    The line is read by byte ranges in many tasks; cells number themselves by prefix sums
    over the ranges, so no task holds a line (see ``sources.pieces``). Cells may be quoted,
    with inner quotes doubled, and then hold the separator. Rejects are (``record``,
    ``reason``): a file's last record if it has too few cells, records with a cell that
    does not cast, and fragments of a quoted cell that is never closed. A line break at a
    file's end is dropped.
    """
    names = [f.name for f in schema.fields]
    width = len(names)
    records = read_pieces(spark, path, sep, quote, width, **options).filter(F.col("number") >= (1 if header else 0))
    records = records.select(F.rtrim("value", F.lit("\r\n")).alias("value"), "broken")
    found = F.regexp_extract_all(F.concat(F.lit(sep), F.col("value")), F.lit(field_pattern(sep, '"')), F.lit(1))
    cell_array = F.when(F.contains("value", F.lit('"')), F.transform(found, _bare)).otherwise(F.split("value", _regex_literal(sep)))
    # Exploded from an array of one, so that the filters below read the cells and don't cut them again.
    records = records.select("value", "broken", F.explode(F.array(cell_array)).alias("__cells"))
    right = ~F.col("broken") & (F.size("__cells") == width)
    cut = records.filter(right).select(
        F.col("value").alias("__record"), *[F.get(F.col("__cells"), i).alias(n) for i, n in enumerate(names)]
    )
    cast = {f.name: F.nullif(F.col(f.name), F.lit("")).try_cast(f.dataType) for f in schema.fields if not isinstance(f.dataType, T.StringType)}
    wrong = F.lit(False)
    for name, typed in cast.items():
        wrong = wrong | ((F.col(name) != "") & typed.isNull())
    wrong = F.coalesce(wrong, F.lit(False))
    rows = cut.filter(~wrong).select(*[cast.get(c, F.col(c)).alias(c) for c in names])
    bad_rows = cut.filter(wrong).select(F.col("__record").alias("record"), F.lit("a cell does not cast").alias("reason"))
    bad_width = records.filter(~right & (F.col("value") != "")).select(F.col("value").alias("record"), F.lit("wrong number of cells").alias("reason"))
    return rows, bad_width.unionByName(bad_rows)


def reshape_record(df: DataFrame, key: Sequence[str] | str, value: Sequence[str]) -> DataFrame:
    """Re-key a row as ``(key struct, value struct)``, the keyed-tuple shape."""
    key = [key] if isinstance(key, str) else list(key)
    return df.select(F.struct(*key).alias("key"), F.struct(*value).alias("value"))
