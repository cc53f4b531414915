"""Best-fit packing by hierarchical residual packing.

1. Each scan task tokenizes its documents, cuts those longer than the capacity
   and packs its pieces best-fit decreasing, window by window. A piece row
   carries its bin, its place there and the bin's fill. Nothing is shuffled.
2. Bins with little room left are final. The underfull ones become items
   (bin, fill) of a tree: ``fan_in`` neighbouring nodes are merged per level,
   each parent packs the bins of its children best-fit, and what is still
   underfull goes on, until one node is left.
3. The merges (bin to root bin, shift) are composed level by level; pieces take
   their root's number and add the shift. Only merged bins are in that table.

What a node hands on is bounded without loss. A best-fit packing leaves at most
one bin at or under half of the capacity, and every later merge uses up one
such bin of the level. So a parent keeps, of each fill above half, at most as
many bins as there are bins at or under half in the whole level; the others
could never all be merged and are final. A bin with which not even the level's
smallest bin fits is final too.

Null and empty texts are the end id alone. Null or repeated document ids are
packed like any others, row by row. Extra columns are not read. An empty table
gives no rows. Ties keep the scan's order.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import store
from .tokens import default_tokenizer, shared_encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, offset long, fill long"
WINDOW = 131_072  # pieces packed together in one local round


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: each item's bin and offset, and each bin's fill."""
    n = len(lengths)
    where, offset, fills = np.zeros(n, np.int64), np.zeros(n, np.int64), []
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by room left
    rooms = 0  # bit r set: some bin has exactly r left
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms &= ~(1 << room)
        else:
            b, room = len(fills), capacity
            fills.append(0)
        where[i], offset[i] = b, fills[b]
        fills[b] += size
        room -= size
        if room:
            open_bins[room].append(b)
            rooms |= 1 << room
    return where, offset, np.array(fills, np.int64)


def pack_pieces(docs: DataFrame, id_col: str, text_col: str, capacity: int, end_id: int, tokenizer: str, with_ids: bool):
    """Step 1: pieces with their local bins, in one pass over the scan."""

    def run(batches):
        from pyspark import TaskContext

        base, made = TaskContext.get().partitionId() << 40, 0
        encoder, end = shared_encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        rows: list[tuple] = []

        def flush():
            nonlocal made, rows
            lengths = np.array([r[3] for r in rows], np.int64)
            where, offset, fills = best_fit(lengths, capacity)
            cols = list(zip(*rows))
            out = {
                "doc_id": pa.array(cols[0], pa.int64()), "piece": pa.array(cols[1], pa.int32()), "start": pa.array(cols[2], pa.int64()),
                "length": pa.array(lengths), "ids_crc32": pa.array(cols[4], pa.int64()), "bin": pa.array(base + made + where),
                "offset": pa.array(offset), "fill": pa.array(fills[where]),
            }
            if with_ids:
                out["ids"] = pa.array(cols[5], pa.binary())
            made += len(fills)
            rows = []
            table = pa.table(out)
            return table.to_batches(max_chunksize=10_000)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.ids(text.as_py()) + end
                total = len(ids) // 4
                at, piece, length = 0, 0, total % capacity or min(total, capacity)
                while at < total:
                    part = ids[4 * at : 4 * (at + length)]
                    rows.append((doc_id, piece, at, length, zlib.crc32(part), part if with_ids else None))
                    at, piece, length = at + length, piece + 1, capacity
            if len(rows) >= WINDOW:
                yield from flush()
        if rows:
            yield from flush()

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, PIECES + (", ids binary" if with_ids else ""))


def _merge_node(capacity: int, slack: int, smallest: int, halves: int):
    """Best-fit of one node's bins; rows (bin, root, shift, fill, going_on)."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("fill", "descending"), ("bin", "ascending")])
        bins, fills = table["bin"].to_numpy(), table["fill"].to_numpy()
        where, shift, total = best_fit(fills, capacity)
        first = np.full(len(total), -1, np.int64)
        for i in range(len(bins) - 1, -1, -1):
            if shift[i] == 0:
                first[where[i]] = bins[i]
        keep = (total < capacity - slack) & (total + smallest <= capacity)
        seen: dict[int, int] = {}
        for b in range(len(total)):
            if keep[b] and 2 * total[b] > capacity:
                seen[int(total[b])] = seen.get(int(total[b]), 0) + 1
                keep[b] = seen[int(total[b])] <= halves
        node = table["node"].to_numpy()
        return pa.table({
            "node": node, "bin": bins, "root": first[where], "shift": shift, "fill": total[where], "going_on": keep[where] & (shift == 0),
        })

    return run


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = 0,
    tokenizer: str | None = None, slack: int | None = None, fan_in: int = 8, with_ids: bool = False,
) -> DataFrame:
    """Documents packed into sequences of at most ``capacity`` tokens: one row per
    piece with ``sequence_id`` and ``offset`` (and, on request, the piece's ids as
    little-endian uint32 bytes in ``ids``).

    ``slack`` is the room below which a bin counts as nearly full (default
    capacity / 128); ``fan_in`` the children merged per tree node.
    """
    spark = docs.sparkSession
    slack = capacity // 128 if slack is None else slack
    pieces = store(spark, pack_pieces(docs, id_col, text_col, capacity, end_id, tokenizer or default_tokenizer(), with_ids), "pack-pieces")
    # A bin has exactly one piece at its start, which stands for it.
    items = pieces.where((F.col("offset") == 0) & (F.col("fill") < capacity - slack)).select(
        "bin", "fill", F.shiftright("bin", 40).alias("node")
    )
    merged, level = None, 0
    while True:
        level += 1
        seen = items.agg(
            F.max("node").alias("last"), F.min("fill").alias("smallest"), F.count_if(F.col("fill") * 2 <= capacity).alias("halves")
        ).first()
        if seen["last"] is None:
            break
        packed = items.withColumn("node", F.expr(f"node div {fan_in}")).groupBy("node").applyInArrow(
            _merge_node(capacity, slack, int(seen["smallest"]), int(seen["halves"])),
            "node long, bin long, root long, shift long, fill long, going_on boolean",
        )
        packed = store(spark, packed, f"pack-level-{level}")
        moved = packed.where("bin != root").select("bin", "root", "shift")
        if merged is None:
            merged = moved
        else:
            step = moved.select(F.col("bin").alias("root"), F.col("root").alias("next"), F.col("shift").alias("more"))
            merged = merged.join(step, "root", "left").select(
                "bin", F.coalesce("next", "root").alias("root"), (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift")
            ).unionByName(moved)
        if seen["last"] < fan_in:  # all of them were one node's children
            break
        items = packed.where("going_on").select("bin", "fill", "node")
    out = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] + ["ids"] * with_ids
    if merged is None:
        return pieces.withColumn("sequence_id", F.col("bin")).select(*out)
    placed = pieces.join(merged.withColumnRenamed("shift", "__shift"), "bin", "left")
    return placed.withColumn("sequence_id", F.coalesce("root", "bin")).withColumn(
        "offset", F.col("offset") + F.coalesce("__shift", F.lit(0))
    ).select(*out)
