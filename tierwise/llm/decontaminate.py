"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are compared lower-cased with white space runs as one space. An
item of m characters may differ by k = floor(``error_rate`` * m) edits. It is
split into k + 1 pieces: if the item occurs in a text with at most k edits, one
piece occurs unchanged, at about its place. All pieces' exact occurrences come
from one Aho-Corasick pass over the whole text; around each (hits of an item
whose places differ by at most k are one stretch) Myers' bit-parallel distance
finds the nearest substring, which counts when it is within k edits. Nothing is
shuffled: items travel to the scan, in blocks of about ``BLOCK_CHARS``
characters, so a large benchmark takes several passes and no more memory.

Items under ``min_chars`` characters carry little evidence: they match where they occur
unchanged as whole words, whatever the error rate. Null and empty items match
nothing. Null and empty texts have no leaks. Repeated
rows, ids and items are each treated for themselves; null ids pass through.
Extra columns are kept by ``decontaminate``. Empty tables give no leaks.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .names import free

BLOCK_CHARS = 4_000_000
WHOLE = -1  # an item's error budget if it must occur unchanged, as whole words
_WORD = re.compile(r"\S+")
_WORDLIKE = re.compile(r"\w")
LEAK = T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("distance", T.IntegerType()),
    T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
])


def normal(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def pieces(length: int, errors: int) -> list[tuple[int, int]]:
    """The ``errors`` + 1 pieces of an item, as (start, end), as even as can be."""
    cuts = [length * i // (errors + 1) for i in range(errors + 2)]
    return list(zip(cuts, cuts[1:]))


def nearest_substring(item: str, text: str) -> tuple[int, int]:
    """Least edit distance of ``item`` to a substring of ``text``, and that
    substring's first possible end (Myers' bit-parallel columns)."""
    m = len(item)
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text, 1):
        same = masks.get(c, 0)
        vertical = same | down
        diagonal = (((same & up) + up) ^ up) | same
        plus, minus = (down | ~(diagonal | up)) & full, up & diagonal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus, minus = plus << 1 & full, minus << 1 & full
        up, down = (minus | ~(vertical | plus)) & full, plus & vertical
        if score < best:
            best, end = score, j
    return best, end


def whole_words(text: str, start: int, end: int) -> bool:
    """Whether no word of ``text`` is cut at ``start`` or at ``end``."""
    cut_before = start > 0 and _WORDLIKE.match(text, start - 1) and _WORDLIKE.match(text, start)
    return not cut_before and not (_WORDLIKE.match(text, end - 1) and _WORDLIKE.match(text, end))


class Matcher:
    """Finds the items of one block in normalised texts."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float, min_chars: int = 0):
        import ahocorasick

        self.items = [(i, t, int(error_rate * len(t)) if len(t) >= min_chars else WHOLE) for i, t in items]
        self.automaton = ahocorasick.Automaton()
        places: dict[str, list[tuple[int, int]]] = {}
        for n, (_, text, errors) in enumerate(self.items):
            for a, b in pieces(len(text), max(0, errors)):
                places.setdefault(text[a:b], []).append((n, b))
        for piece, where in places.items():
            self.automaton.add_word(piece, where)
        if places:
            self.automaton.make_automaton()
        self.empty = not places

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, distance, start, end) of every stretch of ``text`` that holds an item."""
        if self.empty or not text:
            return []
        begins: dict[int, set[int]] = {}
        for last, where in self.automaton.iter(text):
            for n, b in where:
                begins.setdefault(n, set()).add(last + 1 - b)
        found = []
        for n, places in begins.items():
            item_id, item, errors = self.items[n]
            ordered = sorted(places)
            if errors == WHOLE:
                found += [(item_id, 0, p, p + len(item)) for p in ordered if whole_words(text, p, p + len(item))]
                continue
            low = high = ordered[0]
            for p in [*ordered[1:], None]:
                if p is not None and p - high <= errors:
                    high = p
                    continue
                exact = text.find(item, max(0, low), max(0, high) + len(item))
                if exact >= 0:
                    found.append((item_id, 0, exact, exact + len(item)))
                else:
                    at = max(0, low - errors)
                    stretch = text[at : high + len(item) + errors]
                    distance, end = nearest_substring(item, stretch)
                    if distance <= errors:
                        back = nearest_substring(item[::-1], stretch[:end][::-1])[1]
                        found.append((item_id, distance, at + end - back, at + end))
                low = high = p if p is not None else high
        return sorted(found, key=lambda x: (x[2], x[3], str(x[0])))


def _offsets(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of the normalised text as spans of the original."""
    words, at = [], 0
    for m in _WORD.finditer(text):
        size = len(m.group().lower())
        words.append((at, at + size, m.start(), m.end()))
        at += size + 1
    out = []
    for a, b in spans:
        first = next((w for w in words if w[1] > a), words[-1])
        last = next((w for w in reversed(words) if w[0] < b), words[0])
        start = first[2] + max(0, a - first[0])
        end = last[3] if b >= last[1] else last[2] + b - last[0]
        out.append((min(start, first[3]), max(min(end, last[3]), start)))
    return out


def with_leaks(
    docs: DataFrame, benchmark: DataFrame, out_col: str, text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", error_rate: float = 0.05, min_chars: int = 40, keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` with the array ``out_col`` of (item_id, distance, start, end), offsets
    in code points of the original text."""
    keep = docs.columns if keep is None else keep
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text")).where("text IS NOT NULL")
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // BLOCK_CHARS))
    out = docs
    carried: list[str] = []
    for b in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        texts = [(r["item_id"], normal(r["text"])) for r in part.collect()]  # a block is bounded by BLOCK_CHARS
        chosen = [(i, t) for i, t in texts if t]
        name = out_col if b == 0 else free([*docs.columns, *carried], f"{out_col}_{b}")[0]
        carried.append(name)
        base = keep if b == blocks - 1 else docs.columns
        kept = [c for c in out.columns if c in base or c in carried]
        out = _one_block(out, chosen, text_col, kept, name, error_rate, min_chars)
    if blocks > 1:
        out = out.withColumn(out_col, F.concat(*carried)).drop(*carried[1:])
    return out.select(*keep, out_col)


def _one_block(docs: DataFrame, items, text_col: str, kept: list[str], name: str, error_rate: float, min_chars: int) -> DataFrame:
    fields = docs.select(*kept).schema.fields
    names, arrow = [*kept, name], pa.list_(
        pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
    )

    def run(batches):
        matcher = Matcher(items, error_rate, min_chars)
        for batch in batches:
            column = []
            for value in batch.column(batch.num_columns - 1):
                text = value.as_py()
                found = matcher.find(normal(text))
                spans = _offsets(text, [f[2:] for f in found]) if found else []
                column.append([{"item_id": f[0], "distance": f[1], "start": a, "end": b} for f, (a, b) in zip(found, spans)])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(column, arrow)], names)

    schema = T.StructType([*fields, T.StructField(name, T.ArrayType(LEAK))])
    return docs.select(*kept, F.col(text_col).cast("string").alias(*free([*kept, name], "text_to_match"))).mapInArrow(run, schema)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per document and occurrence: doc_id, item_id, distance, start, end."""
    ided = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(options.get("text_col", "text")).alias("text"))
    leaks = with_leaks(ided, benchmark, "leaks", **{**options, "text_col": "text", "keep": ["doc_id"]})
    return leaks.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` without those that hold an item of the benchmark."""
    (name,) = free(docs.columns, "leaks")
    return with_leaks(docs, benchmark, name, text_col, **options).where(F.size(name) == 0).select(*docs.columns)
