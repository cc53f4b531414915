"""Records that no line break delimits, read by byte ranges in many tasks.

Two shapes of text cannot be cut into records by looking at one line alone: records
whose quoted fields hold line breaks, and one endless line of cells where every
``width`` cells are a record. Both are cut here by what lies before a place in its
file, without reading a file in one task:

1. Spark's text reader splits the files by byte ranges and cuts them at ``sep`` (a
   line break, or the cell separator). A first scan leaves one row per range: the
   parity of its quotes, and how many pieces begin in it if it is entered outside
   quotes, or inside.
2. Prefix sums over the ranges of each file give the state and the number of pieces
   at every range's beginning.
3. A second scan cuts each range into records. Those that lie within a range, all but
   one or so, are emitted where they are read; nothing of them is shuffled.
4. A record cut by a range's end leaves a fragment per range; fragments are grouped by
   record and joined. A record over more than ``max_ranges`` ranges, as a quote that
   is never closed makes, is not held in one task: each fragment is a broken record.

Quotes are doubled inside quoted fields, which keeps the parity; every quote counts.
The ranges' table has one row per byte range (``spark.sql.files.maxPartitionBytes``
or a file) and is broadcast behind a size check. Pieces may be a few bytes each, so
the longest is looked up first: where no batch of them can reach Spark's limit in
bytes, it is not measured once per piece (see ``session.short_rows``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.joins import checked_broadcast
from ..session import short_rows, store

_RANGES = "file long, start long, odd boolean, begins_outside long, begins_inside long"
_RECORDS = "file long, number long, start long, value string, whole boolean"


def _inside_before(lines: pa.Array, quote: str, inside: bool) -> tuple[np.ndarray, bool]:
    """Whether each line begins inside quotes, and whether the next one will."""
    if not quote:
        return np.zeros(len(lines), bool), False
    odd = pc.count_substring(lines, quote).to_numpy(zero_copy_only=False) % 2 == 1
    state = np.logical_xor.accumulate(np.concatenate([[inside], odd]))
    return state[:-1], bool(state[-1])


def _by_range(batch: pa.RecordBatch):
    """(file, start, from, to) of the stretches of a batch that come from one byte range."""
    file, start = batch.column("file").to_numpy(), batch.column("start").to_numpy()
    cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(start) != 0)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(file)]):
        if b > a:
            yield int(file[a]), int(start[a]), a, b


def _summarise(quote: str):
    def run(batches):
        now, sums = None, [0, 0, 0]

        def row():
            return pa.RecordBatch.from_pydict(
                {"file": [now[0]], "start": [now[1]], "odd": [bool(sums[0])], "begins_outside": [sums[1]], "begins_inside": [sums[2]]},
                schema=pa.schema([("file", pa.int64()), ("start", pa.int64()), ("odd", pa.bool_()), ("begins_outside", pa.int64()), ("begins_inside", pa.int64())]),
            )

        for batch in batches:
            for file, start, a, b in _by_range(batch):
                if (file, start) != now:
                    if now:
                        yield row()
                    now, sums = (file, start), [0, 0, 0]
                before, after = _inside_before(batch.column("value").slice(a, b - a), quote, bool(sums[0]))
                inside = int(before.sum())  # had the range been entered outside quotes
                sums = [int(after), sums[1] + (b - a) - inside, sums[2] + inside]
        if now:
            yield row()

    return run


def _cut(sep: str, quote: str, width: int):
    names = ["file", "number", "start", "value", "whole"]
    schema = pa.schema([("file", pa.int64()), ("number", pa.int64()), ("start", pa.int64()), ("value", pa.string()), ("whole", pa.bool_())])

    def run(batches):
        now, inside, pieces = None, False, 0  # the byte range, its state and the pieces of its file begun so far
        number, begun, parts = None, False, []  # the record that is open

        def opened(whole):
            return pa.RecordBatch.from_arrays(
                [pa.array([now[0]]), pa.array([number], pa.int64()), pa.array([now[1]]), pa.array([sep.join(parts)]), pa.array([whole])], schema=schema
            )

        def ended():
            """The record open at a range's end is whole if nothing of it can follow."""
            return begun and not inside and pieces % width == 0

        for batch in batches:
            for file, start, a, b in _by_range(batch):
                if (file, start) != now:
                    if parts:
                        yield opened(ended())
                    now, parts, number = (file, start), [], None
                    inside, pieces = bool(batch.column("inside")[a].as_py()), batch.column("pieces")[a].as_py()
                lines = batch.column("value").slice(a, b - a).cast(pa.string())
                before, after = _inside_before(lines, quote, inside)
                count = pieces + np.cumsum(~before)
                record = (count - 1) // width
                head = ~before & ((count - 1) % width == 0)
                cuts = np.concatenate([[0], np.flatnonzero(np.diff(record)) + 1, [b - a]])
                first = 0
                if parts and record[0] == number:  # the open record goes on
                    parts += lines[: cuts[1]].to_pylist()
                    first = 1
                if first < len(cuts) - 1:
                    if parts:
                        yield opened(begun)  # a new record begins behind it in the same range
                    done = cuts[first:-1]
                    if len(done) > 1:
                        values = pc.binary_join(pa.ListArray.from_arrays(pa.array(done, pa.int32()), lines), sep)
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.full(len(values), file)), pa.array(record[done[:-1]]), pa.array(np.full(len(values), start)), values, pa.array(head[done[:-1]]),
                        ], names)
                    last = int(done[-1])
                    number, begun = int(record[last]), bool(head[last])
                    parts = lines[last:].to_pylist()
                inside, pieces = after, int(count[-1])
        if parts:
            yield opened(ended())

    return run


def read_pieces(
    spark: SparkSession, path, sep: str = "\n", quote: str = '"', width: int = 1, max_ranges: int = 16
) -> DataFrame:
    """Records of ``width`` pieces parted by ``sep`` outside quotes: file (a hash of its
    path), number (from 0 in its file), value (the text between the record's separators)
    and broken (a fragment of a record over more than ``max_ranges`` byte ranges)."""
    lines = spark.read.option("lineSep", sep).text(path)
    raw = lines.select(
        "value", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )
    longest = lines.agg(F.max(F.octet_length("value"))).first()[0] or 0
    with short_rows(spark, longest + 24):
        ranges = store(spark, raw.mapInArrow(_summarise(quote), _RANGES), "piece-ranges")
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    state = ranges.withColumn("inside", F.coalesce(F.sum(F.col("odd").cast("int")).over(earlier), F.lit(0)) % 2 == 1)
    begins = F.when(F.col("inside"), F.col("begins_inside")).otherwise(F.col("begins_outside"))
    entered = state.select("file", "start", "inside", F.coalesce(F.sum(begins).over(earlier), F.lit(0)).alias("pieces"))
    entered = store(spark, entered, "piece-states")
    entered, small = checked_broadcast(entered, max_rows=4_000_000)
    if not small:  # a shuffle join would lose the lines' order
        raise ValueError("over four million byte ranges: read with a larger spark.sql.files.maxPartitionBytes")
    records = raw.join(entered, ["file", "start"]).select("file", "start", "value", "inside", "pieces").mapInArrow(
        _cut(sep, quote, width), _RECORDS
    )
    # The few fragments are stored beside the whole records, so that the text is cut once.
    with short_rows(spark, longest + 24):
        cut = store(spark, records, "piece-records")
    part = F.struct("start", "value")
    grouped = cut.where("NOT whole").groupBy("file", "number")
    sizes = grouped.agg(F.count("*").alias("n"))
    fragments = cut.where("NOT whole").join(sizes, ["file", "number"])
    joined = fragments.where(F.col("n") <= max_ranges).groupBy("file", "number").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda p: p["value"]), sep).alias("value")
    )
    too_long = fragments.where(F.col("n") > max_ranges)
    return (
        cut.where("whole").select("file", "number", "value", F.lit(False).alias("broken"))
        .unionByName(joined.select("file", "number", "value", F.lit(False).alias("broken")))
        .unionByName(too_long.select("file", "number", "value", F.lit(True).alias("broken")))
    )
