"""Token-id files in patched frame-of-reference blocks.

Documents are ranged by id over the tasks; each task encodes its range in order
and writes segments: whole documents, closed once ``segment_ids`` ids are in.
A segment is one row of a Parquet table in the shared folder, so that a lost
task is simply run again and any store Spark can write to will do. Columns:
shard, segment, first_id (ids of the shard before it), n_ids, doc_ids,
doc_lengths, and the payload, which is the binary format proper:

    magic "PFOR", block size uint32, ids uint32, blocks uint32
    block index: start of every block in the payload's body, uint32 each
    per block: minimum uint32, width uint8, exceptions uint16,
               the deltas' low ``width`` bits, packed,
               exceptions' positions uint16, then their high bits uint32

The width of a block is the percentile of its deltas' widths that makes the
block smallest; deltas beyond it leave their high bits in the exception list.
``read`` decodes whole segments, ``decode_block`` a single block by the index.

Null and empty texts are the end id alone. Rows are ordered by doc_id, nulls
first, equal ids by their text's hash and then the text. Extra columns are not
read; an empty table gives an empty file table and no rows.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import drop_at_exit, scratch_path
from .tokens import default_tokenizer, shared_encoder

BLOCK = 256
_SEGMENT = "shard int, segment int, first_id long, n_ids long, doc_ids array<long>, doc_lengths array<int>, payload binary"


def _lanes(width: int):
    """Of 64 values of ``width`` bits, which fill ``width`` words of 64 bits: each value's first
    word, its place there, and whether it goes on in the next word."""
    for k in range(64):
        word, shift = divmod(k * width, 64)
        yield k, word, np.uint64(shift), np.uint64(64 - shift) if shift + width > 64 else None


def _pack_bits(values: np.ndarray, width: int) -> bytes:
    """Each value, of ``width`` bits at most, least significant bit first; 64 values at a time
    (a last group is filled up with zeros and cut to whole bytes)."""
    if not width:
        return b""
    count = len(values)
    lanes = np.pad(values, (0, -count % 64)).reshape(-1, 64).T.astype(np.uint64)
    words = np.zeros((width, lanes.shape[1]), np.uint64)
    for k, word, shift, rest in _lanes(width):
        words[word] |= lanes[k] << shift
        if rest is not None:
            words[word + 1] |= lanes[k] >> rest
    return words.T.astype("<u8").tobytes()[: -(-count * width // 8)]


def _unpack_bits(data: bytes, count: int, width: int) -> np.ndarray:
    if not width:
        return np.zeros(count, np.uint32)
    data += bytes(-len(data) % (8 * width))
    words = np.frombuffer(data, "<u8").reshape(-1, width).T.astype(np.uint64)
    lanes = np.empty((64, words.shape[1]), np.uint64)
    for k, word, shift, rest in _lanes(width):
        lanes[k] = words[word] >> shift
        if rest is not None:
            lanes[k] |= words[word + 1] << rest
    return (lanes & np.uint64((1 << width) - 1)).T.astype(np.uint32).reshape(-1)[:count]


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    return np.frexp(values.astype(np.float64))[1]


def encode(ids: np.ndarray, block: int = BLOCK) -> bytes:
    """``ids`` (uint32) in the payload format above."""
    ids = ids.astype(np.uint32)
    n = len(ids)
    blocks = -(-n // block)
    body, starts, at = [], np.zeros(blocks, "<u4"), 0
    if n:
        whole = np.pad(ids, (0, blocks * block - n), mode="edge").reshape(blocks, block)
        low = whole.min(axis=1)
        delta = whole - low[:, None]
        # Per block, how many deltas fit each width: its percentiles.
        need = _bit_lengths(delta) + 33 * np.arange(blocks)[:, None]
        fitting = np.cumsum(np.bincount(need.reshape(-1), minlength=33 * blocks).reshape(blocks, 33), axis=1)
        width = np.argmin(np.arange(33) * block + 48 * (block - fitting), axis=1)
        over = block - fitting[np.arange(blocks), width]
        packed: dict[int, bytes] = {}
        for w in np.unique(width).tolist():  # one vectorised packing per width
            rows = np.flatnonzero(width == w)
            size = block * w // 8
            data = _pack_bits((delta[rows] & np.uint32((1 << w) - 1)).reshape(-1), w)
            packed.update((r, data[k * size : (k + 1) * size]) for k, r in enumerate(rows.tolist()))
        high = (delta.astype(np.uint64) >> width[:, None].astype(np.uint64)).astype(np.uint32)
        for b in range(blocks):
            outliers = np.flatnonzero(high[b]) if over[b] else ()
            part = struct.pack("<IBH", int(low[b]), int(width[b]), len(outliers)) + packed[b]
            if len(outliers):
                part += outliers.astype("<u2").tobytes() + high[b][outliers].astype("<u4").tobytes()
            body.append(part)
            starts[b] = at
            at += len(part)
    return b"PFOR" + struct.pack("<III", block, n, blocks) + starts.tobytes() + b"".join(body)


def decode_block(payload: bytes, index: int) -> np.ndarray:
    """Block ``index`` alone, found by the block index."""
    block, n, blocks = struct.unpack_from("<III", payload, 4)
    body = 16 + 4 * blocks
    at = body + struct.unpack_from("<I", payload, 16 + 4 * index)[0]
    low, width, outliers = struct.unpack_from("<IBH", payload, at)
    at += 7
    size = block * width // 8
    values = _unpack_bits(payload[at : at + size], block, width)
    if outliers:
        at += size
        places = np.frombuffer(payload, "<u2", outliers, at).astype(np.int64)
        values[places] |= np.frombuffer(payload, "<u4", outliers, at + 2 * outliers) << np.uint32(width)
    return (values + np.uint32(low))[: min(block, n - index * block)]


def decode(payload: bytes) -> np.ndarray:
    """All ids of a payload."""
    if payload[:4] != b"PFOR":
        raise ValueError("not a token-id payload")
    block, n, blocks = struct.unpack_from("<III", payload, 4)
    values, body = np.zeros((blocks, block), np.uint32), 16 + 4 * blocks
    starts = np.frombuffer(payload, "<u4", blocks, 16).tolist()
    heads = [struct.unpack_from("<IBH", payload, body + at) for at in starts]
    widths = np.array([h[1] for h in heads], np.int64)
    for w in np.unique(widths).tolist():  # one vectorised unpacking per width
        rows, size = np.flatnonzero(widths == w), block * w // 8
        data = b"".join(payload[body + starts[r] + 7 : body + starts[r] + 7 + size] for r in rows.tolist())
        values[rows] = _unpack_bits(data, len(rows) * block, w).reshape(len(rows), block)
    for b, (_, width, outliers) in enumerate(heads):
        if outliers:
            at = body + starts[b] + 7 + block * width // 8
            places = np.frombuffer(payload, "<u2", outliers, at).astype(np.int64)
            values[b, places] |= np.frombuffer(payload, "<u4", outliers, at + 2 * outliers) << np.uint32(width)
    values += np.array([h[0] for h in heads], np.uint32)[:, None]
    return values.reshape(-1)[:n]


def write(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2,
    tokenizer: str | None = None, segment_ids: int = 1 << 18, block: int = BLOCK,
) -> None:
    """Encode every text, append ``end_id`` and write the segments to ``path``."""
    tokenizer = tokenizer or default_tokenizer()

    def run(batches):
        from pyspark import TaskContext

        shard, encoder, end = TaskContext.get().partitionId(), shared_encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        segment, before, held, parts, doc_ids, lengths = 0, 0, 0, [], [], []

        def close():
            nonlocal segment, before, held, parts, doc_ids, lengths
            payload = encode(np.frombuffer(b"".join(parts), "<u4"), block)
            row = pa.RecordBatch.from_arrays([
                pa.array([shard], pa.int32()), pa.array([segment], pa.int32()), pa.array([before], pa.int64()), pa.array([held], pa.int64()),
                pa.array([doc_ids], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int32())), pa.array([payload], pa.binary()),
            ], ["shard", "segment", "first_id", "n_ids", "doc_ids", "doc_lengths", "payload"])
            segment, before, held, parts, doc_ids, lengths = segment + 1, before + held, 0, [], [], []
            return row

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.ids(text.as_py()) + end
                parts.append(ids)
                doc_ids.append(doc_id)
                lengths.append(len(ids) // 4)
                held += len(ids) // 4
                if held >= segment_ids:
                    yield close()
        if doc_ids:
            yield close()

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # The hash spreads rows that share an id (or lack one) over several tasks.
    ranged = chosen.withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie")
    ordered = ranged.sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text")
    ordered.mapInArrow(run, _SEGMENT).write.parquet(path)


def read(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """The documents in a file table: doc_id, start, n_tokens, ids_crc32 and, on
    request, ids (little-endian uint32 bytes)."""
    segments = spark.read.schema(_SEGMENT).parquet(path)
    # One row per shard, that is per task of the write: its ids, then those before it.
    totals = segments.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    bases, before = [], 0
    for row in totals.orderBy("shard").toLocalIterator():
        bases.append((row["shard"], before))
        before += row["ids"]
    base = spark.createDataFrame(bases, "shard int, base long")

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                raw = decode(row["payload"]).astype("<u4").tobytes()
                lengths = np.array(row["doc_lengths"], np.int64)
                ends = np.cumsum(lengths)
                parts = [raw[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(parts), row["shard"], np.int32)), pa.array(row["doc_ids"], pa.int64()),
                    pa.array(row["first_id"] + ends - lengths), pa.array(lengths),
                    pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                    *([pa.array(parts, pa.binary())] if with_ids else []),
                ], ["shard", "doc_id", "first", "n_tokens", "ids_crc32"] + ["ids"] * with_ids)

    read_back = segments.select("shard", "first_id", "doc_ids", "doc_lengths", "payload").mapInArrow(
        run, "shard int, doc_id long, first long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    )
    return read_back.join(F.broadcast(base), "shard").select(
        "doc_id", (F.col("first") + F.col("base")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids
    )


def round_trip(docs: DataFrame, with_ids: bool = False, **options) -> DataFrame:
    """Write ``docs`` to a fresh file table in the shared folder and read it back."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-files")
    write(docs, path, **options)
    drop_at_exit(spark, path)
    return read(spark, path, with_ids)
