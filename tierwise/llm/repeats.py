"""Removal of repeated byte strings: a depth-limited radix sort of the corpus' suffixes.

Two suffixes matter only through ``length`` bytes, so they are told apart by
most-significant-digit passes that stop there; what is equal after the last pass is
exactly the windows of ``length`` bytes that occur more than once. Every pass drops
the groups of one. Buckets are hash buckets: only equality is asked of them, not order.

Depth ``KEY``, the synchronising string. Of a window's ``KEY``-byte strings the one
with the least hash (the leftmost of equals) depends on the window's bytes alone, so
equal windows agree on it and on their distance j from it. Consecutive windows share
it, and such a run (about 2 per ``length`` bytes) is what is shuffled, never every
suffix. Runs whose string occurs once are done.

Whole runs. Runs of one string with equal spans (all their windows' bytes together)
have only repeated windows; hot spans, as of thousands of copies, are counted
map-side and never gathered. One run of every span goes on, for those that are
alone with their span but not with their string (a passage's first and last run in
a document).

Groups of up to ``IN_TASK`` runs are finished by comparing their windows, as radix
sorts finish small buckets. Larger ones go through passes of growing depth. A pass
of ``width`` w cuts the distances into stretches of w; all windows of a stretch cover
the same length - w + 1 bytes, its digit. Runs that are alone with a digit are dropped
there. Runs that agree on all bytes the stretch's windows cover have only repeated
windows there. The rest goes on to the next, narrower stretches, at last of one
window: depths 64, 352, 394, 400 at 400 bytes. A run's edge lies in one or two
stretches of a pass, so a run costs some tens of narrow rows, counted map-side.

Documents are known by 96 bits of id and text; equal rows share them, count as two
documents, are worked out once and get equal results. Strings are hashed to 64 bits,
compared with 64 more of a digit or span, windows in a task to 128. Null and empty
texts, and texts shorter than ``length``, lose nothing. Extra columns are not read.
An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import store

KEY = 64
IN_TASK = 256
WIDTHS = (49, 7, 1)  # stretches of distances per pass, each a divisor of the one before
CHUNK = 1 << 20
LONG = 1 << 22
_POSITION = np.uint64((1 << 24) - 1)
_STEP = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(20_240_601).integers(0, 2**63, 256, dtype=np.uint64)


def key_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the KEY bytes at every position, by doubling."""
    h, span, step = _BYTES[data], 1, _STEP
    while span < KEY:
        h = h[:-span] * np.uint64(step) + h[span:]
        span, step = 2 * span, step * step % 2**64
    return h


def runs(data: np.ndarray, begins: list[int], length: int):
    """Of concatenated documents (begins, and the end last): first and last window
    start, place and hash of the synchronising string of every run of windows."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none.view(np.uint64)
    keys = key_hashes(data)
    wide = length - KEY + 1
    order = (keys ^ (keys >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    order = (order & ~_POSITION) | np.arange(len(order), dtype=np.uint64)
    # Least value of each window: least to the block's end, and from the block's start.
    blocks = np.pad(order, (0, -len(order) % wide), constant_values=np.uint64(2**64 - 1)).reshape(-1, wide)
    left = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    windows = len(data) - length + 1
    least = np.minimum(right[:windows], left[wide - 1 : wide - 1 + windows])
    inside = np.ones(windows, bool)
    for b, e in zip(begins, begins[1:]):
        inside[max(b, e - length + 1) : e] = False
    starts = np.flatnonzero(inside)
    if not len(starts):
        return none, none, none, none.view(np.uint64)
    place = (least[starts] & _POSITION).astype(np.int64)
    cut = np.flatnonzero((np.diff(place) != 0) | (np.diff(starts) != 1))
    first, last = np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(starts) - 1]])
    return starts[first], starts[last], place[first], keys[place[first]]


def _segments(texts: list, length: int):
    """Groups of (row, offset in its text, bytes), a megabyte or so each; a long
    text comes in pieces that share length - 1 bytes."""
    group, held = [], 0
    for row, text in enumerate(texts):
        at = 0
        while len(text) - at >= length:
            part = text[at : at + LONG + length - 1]
            group.append((row, at, part))
            held += len(part)
            at += LONG
            if held >= CHUNK:
                yield group
                group, held = [], 0
    if group:
        yield group


def _find_runs(length: int):
    def run(batches):
        from xxhash import xxh3_64_intdigest

        for batch in batches:
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for group in _segments(batch.column(2).to_pylist(), length):
                whole = b"".join(p for _, _, p in group)
                begins = np.cumsum([0] + [len(p) for _, _, p in group])
                lo, hi, place, key = runs(np.frombuffer(whole, np.uint8), begins.tolist(), length)
                if not len(lo):
                    continue
                which = np.searchsorted(begins, lo, side="right") - 1
                row = np.array([r for r, _, _ in group])[which]
                shift = np.array([a for _, a, _ in group])[which] - begins[which]
                span = np.fromiter(
                    (xxh3_64_intdigest(whole[a : b + length], c - a) for a, b, c in zip(lo.tolist(), hi.tolist(), place.tolist())),
                    np.uint64, len(lo),
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(x)
                        for x in (
                            k1[row], k2[row], key.view(np.int64), span.view(np.int64), lo + shift, (hi - lo + 1).astype(np.int32),
                            (place - lo).astype(np.int32),
                        )
                    ],
                    ["k1", "k2", "key", "span", "start", "windows", "place"],
                )

    return run


def _outcome(text: bytes, spans) -> tuple[int, int, int, str]:
    """n_bytes, n_removed, n_spans and the SHA-256 of what is left."""
    merged: list[list[int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    kept, at = hashlib.sha256(), 0
    for a, b in merged:
        kept.update(text[at:a])
        at = b
    kept.update(text[at:])
    return len(text), sum(b - a for a, b in merged), len(merged), kept.hexdigest()


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_OPEN = "struct<start:long,windows:int,place:int,key:long,many:boolean,single:boolean>"
_INFO = f"array<{_OPEN.replace('struct<', 'struct<resolved:boolean,')}>"
_SPANS = "array<struct<start:long,end:long>>"


def _settle(length: int):
    """Documents without open runs get their result; of the others the resolved
    spans and open runs are kept beside the text."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "k1", "k2", "text", "spans", "open"]
    span, open_run = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.list_(
        pa.struct([("start", pa.int64()), ("windows", pa.int32()), ("place", pa.int32()), ("key", pa.int64()), ("many", pa.bool_()), ("single", pa.bool_())])
    )
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.binary(), span, open_run]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = []
                for r in batch.slice(at, 500).to_pylist():
                    info = r["info"] or []
                    spans = [(x["start"], x["start"] + x["windows"] - 1 + length) for x in info if x["resolved"]]
                    todo = [{n: x[n] for n in ("start", "windows", "place", "key", "many", "single")} for x in info if not x["resolved"]]
                    if todo:
                        kept = [{"start": a, "end": b} for a, b in spans]
                        rows.append((r["doc_id"], None, None, None, None, r["k1"], r["k2"], r["text"], kept, todo))
                    else:
                        rows.append((r["doc_id"], *_outcome(r["text"], spans), None, None, None, None, None))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return run


_RUNS = "key long, many boolean, k1 long, k2 int, start long, windows int, place int, single boolean, bytes binary"


def _open_runs(length: int):
    """Open runs with their bytes."""
    names = [f.split()[0] for f in _RUNS.split(", ")]
    types = [pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]

    def run(batches):
        for batch in batches:
            rows: list[tuple] = []
            for r in batch.to_pylist():
                for x in r["open"]:
                    a, n = x["start"], x["windows"]
                    rows.append((x["key"], x["many"], r["k1"], r["k2"], a, n, x["place"], x["single"], r["text"][a : a + n - 1 + length]))
                if len(rows) >= 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return run


_DIGITS = "key long, part int, digit long, span long, k1 long, k2 int, start long, first int, windows int, single boolean"


def _digits(length: int, width: int, within: int | None):
    """Of every run, or of its ``parts`` of the pass before (stretches of ``within``
    distances), the stretches of ``width`` distances: the hash of the bytes that all of a
    stretch's windows cover and, if the run has all of its windows, of all they cover;
    and the run's windows in it (``first`` after the run's start, ``windows``)."""
    names = [f.split()[0] for f in _DIGITS.split(", ")]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()]

    def run(batches):
        from xxhash import xxh3_64_intdigest

        signed = lambda h: h - (1 << 64) if h >> 63 else h
        for batch in batches:
            rows: list[tuple] = []
            for r in batch.to_pylist():
                data, far = r["bytes"], r["place"]  # the first window's distance is the greatest
                near = far - r["windows"] + 1
                if within is None:
                    parts = [(q, r["single"]) for q in range(near // width, far // width + 1)]
                else:
                    step = within // width
                    inside = [(q, p["single"]) for p in r["parts"] for q in range(p["part"] * step, (p["part"] + 1) * step)]
                    parts = [(q, single) for q, single in inside if q * width <= far and (q + 1) * width > near]
                for q, single in parts:
                    a, b = q * width, (q + 1) * width - 1
                    digit = xxh3_64_intdigest(data[far - a : far - b + length], q)
                    span = signed(xxh3_64_intdigest(data[far - b : far - a + length], q)) if a >= near and b <= far else None
                    low, high = max(a, near), min(b, far)
                    rows.append((r["key"], q, signed(digit), span, r["k1"], r["k2"], r["start"], far - high, high - low + 1, single))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return run


def _radix(runs: DataFrame, length: int) -> DataFrame:
    """Spans (k1, k2, start, end) of repeated windows of the single runs of large groups."""
    spark, found, within, todo = runs.sparkSession, None, None, runs
    for width in WIDTHS:
        nodes = store(spark, todo.mapInArrow(_digits(length, width, within), _DIGITS), "repeat-digits")
        groups = nodes.groupBy("key", "part", "digit").agg(F.count("*").alias("n"), F.bool_or("single").alias("needed"))
        groups = store(spark, groups.where("n > 1 AND needed").select("key", "part", "digit"), "repeat-groups")
        alive = nodes.join(groups, ["key", "part", "digit"], "left_semi")
        equal = nodes.where("span IS NOT NULL").groupBy("key", "part", "span").agg(
            F.count("*").alias("n"), F.min(F.struct("k1", "k2", "start")).alias("one")
        )
        equal = store(spark, equal.where("n > 1").select("key", "part", "span", "one"), "repeat-equal")
        same = equal.select("key", "part", "span")
        here = F.col("start") + F.col("first")
        spans = alive.where("single").join(same, ["key", "part", "span"], "left_semi").select(
            "k1", "k2", here.alias("start"), (here + F.col("windows") - 1 + length).alias("end")
        )
        found = spans if found is None else found.unionByName(spans)
        if width > 1:
            # What is whole and equal is settled; one of it stays for others to be compared with.
            rest = alive.join(same, ["key", "part", "span"], "left_anti").select("k1", "k2", "start", "part", "single")
            models = equal.select("one.*", "part", F.lit(False).alias("single"))
            parts = rest.unionByName(models).groupBy("k1", "k2", "start").agg(F.collect_list(F.struct("part", "single")).alias("parts"))
            todo, within = runs.join(store(spark, parts, "repeat-parts"), ["k1", "k2", "start"]).select(*runs.columns, "parts"), width
    return found


def _compare(length: int):
    """Rows sorted by string: the repeated windows of its single runs, as spans."""

    def run(batches):
        from xxhash import xxh3_128_digest

        now, held = None, []

        def compared():
            if len(held) < 2:
                return
            digests = [[xxh3_128_digest(b[i : i + length]) for i in range(len(b) - length + 1)] for *_, b in held]
            seen = Counter(d for row in digests for d in row)
            out = []
            for (k1, k2, start, single, _), row in zip(held, digests):
                begin = None
                for i, d in enumerate([*row, None] if single else []):
                    if d is not None and seen[d] > 1:
                        begin = i if begin is None else begin
                    elif begin is not None:
                        out.append((k1, k2, start + begin, start + i - 1 + length))
                        begin = None
            if out:
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["k1", "k2", "start", "end"])

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(6)]
            for key, *row in zip(*columns):
                if key != now:
                    yield from compared()
                    now, held = key, []
                held.append(tuple(row))
        yield from compared()

    return run


def _finish():
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = [
                    (r["doc_id"], *_outcome(r["text"], [(x["start"], x["end"]) for x in [*r["spans"], *(r["found"] or [])]]))
                    for r in batch.slice(at, 500).to_pylist()
                ]
                types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), types)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                )

    return run


def repeated_spans(docs: DataFrame, length: int) -> DataFrame:
    """Per document key (k1, k2): what whole runs settle, and the open runs, as ``info`` rows (see ``_INFO``)."""
    spark = docs.sparkSession
    run_table = store(
        spark,
        docs.select("k1", "k2", "text").mapInArrow(_find_runs(length), "k1 long, k2 int, key long, span long, start long, windows int, place int"),
        "repeat-runs",
    )
    # Stored, so that the join's sides are plain shuffles, whose hot partitions Spark splits.
    shared = store(spark, run_table.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "repeat-shared")
    alive = store(spark, run_table.join(shared, "key", "left_semi"), "repeat-alive")
    spans = store(
        spark,
        alive.groupBy("key", "span").agg(F.count("*").alias("n"), F.min(F.struct("k1", "k2", "start", "windows", "place")).alias("one")),
        "repeat-spans",
    )
    repeated = spans.where("n > 1").select("key", "span")
    no = F.lit(False)
    resolved = alive.join(repeated, ["key", "span"], "left_semi").select(
        "k1", "k2", F.lit(True).alias("resolved"), "start", "windows", "place", "key", no.alias("many"), no.alias("single")
    )
    several = spans.groupBy("key").agg(F.count("*").alias("spans"), F.count_if(F.col("n") == 1).alias("singles")).where(
        "spans > 1 AND singles > 0"
    )
    still_open = spans.join(store(spark, several, "repeat-several"), "key").select(
        "one.k1", "one.k2", F.lit(False).alias("resolved"), "one.start", "one.windows", "one.place", "key",
        (F.col("spans") > IN_TASK).alias("many"), (F.col("n") == 1).alias("single"),
    )
    fields = F.struct("resolved", "start", "windows", "place", "key", "many", "single")
    # A set: equal rows have equal runs, which count once each but are listed once.
    return resolved.unionByName(still_open).groupBy("k1", "k2").agg(F.collect_set(fields).cast(_INFO).alias("info"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans (maximal
    removed runs) and kept_sha256 of the bytes left, after removing every byte of
    a ``length``-byte string that also starts elsewhere."""
    if length < KEY:
        raise ValueError(f"length must be at least {KEY}")
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("t")).select(
        F.xxhash64("doc_id", "t").alias("k1"), F.hash("t", "doc_id").alias("k2"), "doc_id", F.col("t").cast("binary").alias("text")
    )
    info = repeated_spans(keyed, length)
    settled_schema = f"{_RESULT}, k1 long, k2 int, text binary, spans {_SPANS}, open array<{_OPEN}>"
    settled = store(
        spark, keyed.join(info, ["k1", "k2"], "left").select("k1", "k2", "doc_id", "text", "info").mapInArrow(_settle(length), settled_schema),
        "repeat-settled",
    )
    waiting = settled.where("open IS NOT NULL")
    opened = store(spark, waiting.select("k1", "k2", "text", "open").mapInArrow(_open_runs(length), _RUNS), "repeat-open")
    few = opened.where("NOT many").select("key", "k1", "k2", "start", "single", "bytes")
    found = few.repartition("key").sortWithinPartitions("key").mapInArrow(_compare(length), "k1 long, k2 int, start long, end long")
    many = opened.where("many")
    if not many.isEmpty():
        found = found.unionByName(_radix(many, length))
    per_doc = found.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "end")).alias("found"))
    finished = waiting.select("k1", "k2", "doc_id", "text", "spans").join(per_doc, ["k1", "k2"], "left").select(
        "doc_id", "text", "spans", "found"
    ).mapInArrow(_finish(), _RESULT)
    return settled.where("open IS NULL").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").unionByName(finished)
