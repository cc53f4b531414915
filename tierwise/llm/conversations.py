"""Conversation structure repair over a suffix-shared automaton.

A conversation is a word of symbols, one per row: the first letter of its role
(system, user, assistant or other) and its first fault (blank or duplicate;
truncated; none). The cheapest way to repair the rest of a conversation depends on
the symbols that are left and on the state of the grammar ``(s?(ua)+)?`` alone.

1. ``signatures``: rows, narrowed to a symbol and a hash of role and text, are
   sorted by conversation and turn and read as a stream; a conversation leaves its
   symbols, one byte a row, and its counts. What makes a row a duplicate is found
   by an aggregate (the first turn of each role and text of a conversation, whose
   marker is sorted in just before it), so nothing is remembered but the last row.
2. ``audits``: signatures are sorted from their ends and ranged over the tasks. Read
   in that order, they are walked through the automaton in which equal endings are
   one node: a stack holds the path of the last word, the shared ending stays, and
   cost-to-go and best first edit are computed once per new node and grammar state
   for all conversations that end so. The best audit suffix of a node and state is
   that edit and the next node's suffix, so it is one pointer. Hot signatures are
   spread by a hash: a task boundary costs one path more.
3. ``repair``: the rows, sorted again, meet their conversation's audit as its first
   row and are edited as they stream by; the repaired text is hashed, not held.

Ties between edits go to the least letter; every edit leads from a state to one
state only, so that is the least audit. Rows of one turn follow role, then a hash
of the text. Null roles and texts are one space, null turns come first, a null
conversation id is one conversation; repeated rows are duplicates. A conversation
whose rows are all gone has zeros, an empty audit and no text. Extra columns are
not read. An empty table gives no rows. A conversation's hash is sequential by
its contract, so its rows pass one task, streamed from Spark's external sort.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import store

# edits' costs, and the faults' codes.
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
SOUND, CUT, REMOVED = 0, 1, 2
_WHITE = " \t\n\x0b\x0c\r"
_NAME = {"u": "user", "a": "assistant"}
# Grammar states: 0 nothing yet, 1 after the system row, 2 after a user, 3 after an assistant.
WANTED = ("u", "u", "a", "u")  # the role a rerole or an insert gives
AFTER = {"s": 1, "u": 2, "a": 3}
_FAR = 1 << 60


def _closed(costs: list[int], edits: list[str]) -> tuple[list[int], list[str]]:
    """Costs and first edits of a node after inserts before its row, too."""
    for _ in range(4):
        for state in range(4):
            cost = INSERT + costs[AFTER[WANTED[state]]]
            if cost < costs[state] or (cost == costs[state] and edits[state] > "I"):
                costs[state], edits[state] = cost, "I"
    return costs, edits


END = _closed([0, _FAR, _FAR, 0], ["", "~", "~", ""])


def symbol_code(letter: str, fault: int) -> int:
    return 65 + 3 * "sua".find(letter if letter in ("s", "u", "a") else "?") + fault + 3


def _letter(code: int) -> str:
    return "?sua"[(code - 65) // 3]


def node(code: int, following: list[int]) -> tuple[list[int], list[str]]:
    """Cost-to-go and first edit per state of a row's symbol before a node of costs ``following``."""
    letter, fault = _letter(code), (code - 65) % 3
    costs, edits = [], []
    for state in range(4):
        best = (DELETE + following[state], "D")
        if fault != REMOVED:
            extra = TRUNCATED if fault == CUT else 0
            if letter == WANTED[state] or (letter == "s" and state == 0):
                best = min(best, (extra + following[AFTER[letter]], "K"))
            if letter != WANTED[state]:
                best = min(best, (REROLE + extra + following[AFTER[WANTED[state]]], "R"))
        costs.append(best[0])
        edits.append(best[1])
    return _closed(costs, edits)


def edits_of(codes: bytes, path: list[tuple[list[int], list[str]]]):
    """(edit, role it gives or None) in order; ``path`` holds the end's node first."""
    state, at = 0, len(codes)
    while True:
        edit = path[at][1][state]
        if not edit:
            return
        if edit in "IR":
            letter = WANTED[state]
        elif edit == "K":
            letter = _letter(codes[len(codes) - at])
        if edit != "D":
            state = AFTER[letter]
        yield edit
        at -= edit != "I"


def _rows(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, present: str | None) -> DataFrame:
    space = F.lit(" ")
    role = F.coalesce(F.col(role_col).cast("string"), space)
    text = F.coalesce(F.col(text_col).cast("string"), space)
    return rows.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"),
        (F.col(present) if present else F.lit(True)).alias("present"),
    ).withColumn("h1", F.xxhash64("role", "text")).withColumn("h2", F.xxhash64(F.lit(7), "text", "role"))


_ORDER = ("turn", "role", "h1", "h2", "kind")
_FAULT = f"CASE WHEN length(bare) = 0 THEN {REMOVED} WHEN right(bare, 1) IN ('.', '!', '?') THEN {SOUND} ELSE {CUT} END"
_SIGNATURE = "gaps long, blank long, duplicate long, truncated long, illegal long, signature binary"


def _by_conversation(df: DataFrame) -> DataFrame:
    return df.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in _ORDER])


def _stream(batches):
    """(conversation, iterator of its rows) of sorted rows, as dictionaries."""
    from itertools import groupby

    def rows():
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in range(batch.num_columns)]
            for row in zip(*columns):
                yield row

    return groupby(rows(), key=lambda r: r[0])


def _batches(rows, schema: pa.Schema, size: int = 2_000):
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema.names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema.names)


def _arrow_type(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


def signatures(rows: DataFrame) -> DataFrame:
    """Per conversation of ``_rows``: its counts and its signature, a byte per row."""
    bare = F.rtrim("text", F.lit(_WHITE))
    narrow = rows.select(
        "conv_id", "turn", "role", "h1", "h2", F.when(F.col("present"), 1).otherwise(2).alias("kind"),
        F.ltrim(bare, F.lit(_WHITE)).alias("bare"),
    ).withColumn("fault", F.expr(_FAULT)).drop("bare")
    # The first turn of each role and text; a null turn is before all others.
    first = F.min(F.struct(F.col("turn").isNotNull().alias("later"), "turn"))["turn"]
    marks = narrow.where("kind = 1").groupBy("conv_id", "role", "h1", "h2").agg(first.alias("turn")).select(
        "conv_id", "turn", "role", "h1", "h2", F.lit(0).alias("kind"), F.lit(0).alias("fault")
    )
    ordered = _by_conversation(narrow.unionByName(marks)).select("conv_id", "turn", F.left("role", F.lit(1)).alias("letter"), "kind", "fault")

    def summary(conv, rows):
        low = high = turn = None
        turns, counts, illegal, letter, first, codes = 0, [0, 0, 0], 0, None, False, bytearray()
        for _, now, role, kind, fault in rows:
            if kind == 2:  # a dropped row: only its conversation is known by it
                continue
            if kind == 0:
                first = True
                continue
            if now is not None and now != turn:
                turns, turn, high = turns + 1, now, now
                low = now if low is None else low
            if letter is not None and letter + role not in ("su", "ua", "au"):
                illegal += 1
            letter = role
            if fault == REMOVED:
                counts[0] += 1
            elif not first:
                counts[1] += 1
                fault = REMOVED
            elif fault == CUT:
                counts[2] += 1
            first = False
            codes.append(symbol_code(role, fault))
        return (conv, high - low + 1 - turns if turns else 0, *counts, illegal, bytes(codes))

    kind = _arrow_type(rows, "conv_id")
    schema = pa.schema([("conv_id", kind)] + [(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal")] + [("signature", pa.binary())])

    def run(batches):
        yield from _batches((summary(conv, rows) for conv, rows in _stream(batches)), schema)

    return ordered.mapInArrow(run, f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, {_SIGNATURE}")


def audits(signed: DataFrame) -> DataFrame:
    """``signatures`` with cost and audit, computed once per ending and state in a task."""
    names = signed.columns
    ending = F.reverse(F.col("signature").cast("string"))
    spread = F.xxhash64("conv_id")
    # The range keys are bounded in length; the order within a task is that of whole endings.
    ranged = signed.withColumn("ending", ending).repartitionByRange(F.left("ending", F.lit(64)), spread).sortWithinPartitions("ending").select(*names)
    schema_names = [*names, "cost", "audit"]

    def run(batches):
        path, last = [END], b""
        for batch in batches:
            costs, found = [], []
            for codes in batch.column(names.index("signature")).to_pylist():
                ending = codes[::-1]
                if ending != last or not found:
                    shared, most = 0, min(len(ending), len(last))
                    while shared < most and ending[shared] == last[shared]:
                        shared += 1
                    del path[shared + 1 :]
                    for code in ending[shared:]:
                        path.append(node(code, path[-1][0]))
                    last = ending
                    audit = "".join(edits_of(codes, path))
                costs.append(path[-1][0][0])
                found.append(audit)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(costs, pa.int64()), pa.array(found, pa.string())], schema_names)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in signed.schema.fields)
    return ranged.mapInArrow(run, schema + ", cost long, audit string")


def repair(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    present: str | None = None, with_text: bool = False,
) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit, repaired_sha256 and, on request, the repaired text. Rows whose column
    ``present`` is false name their conversation only."""
    spark = rows.sparkSession
    whole = _rows(rows, conv_col, turn_col, role_col, text_col, present)
    audited = store(spark, audits(signatures(whole)).drop("signature"), "conversation-audits")
    heads = audited.select(
        "conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit(0).cast("long").alias("h1"), F.lit(0).cast("long").alias("h2"),
        F.lit(0).alias("kind"), F.lit(0).alias("follows"), F.lit("").alias("text"), F.struct(*audited.columns[1:]).alias("found"),
    )
    body = whole.where("present").select(
        "conv_id", "turn", "role", "h1", "h2", F.lit(1).alias("kind"), F.lit(1).alias("follows"), "text",
        F.lit(None).cast(heads.schema["found"].dataType).alias("found"),
    )
    both = heads.unionByName(body).repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), "follows", *[F.col(c).asc_nulls_first() for c in _ORDER]
    )
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    kind = _arrow_type(whole, "conv_id")
    schema = pa.schema(
        [("conv_id", kind)] + [(n, pa.int64()) for n in counts] + [("audit", pa.string()), ("repaired_sha256", pa.string())]
        + ([("repaired", pa.string())] if with_text else [])
    )

    def edited(conv, rows):
        found = next(rows)[4]
        state, lines, sha, held = 0, 0, hashlib.sha256(), []

        def put(role: str, text: str):
            nonlocal lines
            line = f"{role}:{text}" if not lines else f"\n{role}:{text}"
            sha.update(line.encode())
            lines += 1
            if with_text:
                held.append(line)

        for edit in found["audit"]:
            _, role, text, _, _ = next(rows) if edit != "I" else (None, "", "", None, None)
            if edit == "D":
                continue
            letter = role[:1] if edit == "K" else WANTED[state]
            put(role if edit == "K" else _NAME[letter], text)
            state = AFTER[letter]
        row = (conv, *[found[c] for c in counts], found["audit"], sha.hexdigest())
        return (*row, "".join(held)) if with_text else row

    def run(batches):
        yield from _batches((edited(conv, rows) for conv, rows in _stream(batches)), schema)

    columns = ", ".join(f"{c} long" for c in counts)
    return both.select("conv_id", "role", "text", "follows", "found").mapInArrow(
        run,
        f"conv_id {whole.schema['conv_id'].dataType.simpleString()}, {columns}, audit string, repaired_sha256 string" + (", repaired string" if with_text else ""),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` damaged by crc32(`conv_id:turn`) % 20 (nulls: one space): 0 drops
    the row (``present`` false), 1 empties its text, 2 removes its ``[.!?]``, 3 repeats
    it, 4 makes it the user's."""
    space = F.lit(" ")
    part = lambda c: F.coalesce(F.col(c).cast("string"), space)
    fate = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate(part("text"), ".!?", "")).otherwise(part("text"))
    times = F.when(F.col("fate") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return conversations.withColumn("fate", fate).select(
        "conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(part("role")).alias("role"), text.alias("text"),
        (F.col("fate") != 0).alias("present"), F.explode(times).alias("copy"),
    ).drop("copy")
