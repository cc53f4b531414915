"""Periodic runs of words: descending-LCP Kruskal over each text's suffixes.

A run is a stretch of words with smallest period q, at least ``min_length`` words
and ``exponent`` periods long, that no neighbouring word extends. Its first word s
and s + q begin suffixes whose longest common prefix (LCP) is length - q, and no
position between them begins one as long: so they are neighbours, in text order,
in the class of suffixes that share that many words, and were not before.

1. Words become numbers, a document's own, with a mark behind each document: no
   common prefix crosses documents, and many are worked on together.
2. Suffixes are sorted by prefix doubling. A pass keeps only those whose group has
   two members or more, so text that never repeats drops out in the first passes.
3. LCPs of neighbours in suffix order, in text order (each is at least the one
   before less one). Below ``least_lcp`` none can seed a run and none is kept.
4. Kruskal: the classes of suffixes joined by each LCP, largest first, are united;
   a class is a sorted list of positions, the smaller joins the larger. After all
   unions of one LCP, each position that came in is compared with its neighbours:
   at a distance q within the LCP they seed the run of period q, if the word
   before differs (the run starts here) and the word after it (it ends here).

Documents are worked on one by one or together in a task; nothing is shuffled.
Words are maximal stretches of bytes other than ASCII white space. Null and empty
texts have no words and no runs. Repeated rows and ids are treated each for itself;
extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, insort
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOGETHER = 200_000  # words of documents sorted together
SPACE = r"[\x20\x09-\x0D]+"
_SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
)


def least_lcp(min_length: int, exponent: int) -> int:
    """Smallest LCP that any run's first two suffixes can have."""
    return min(max(min_length, exponent * q) - q for q in range(1, min_length + 1))


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Words of all texts as numbers, each text's own, a mark of its own behind each
    text; and where each text starts."""
    out: list[int] = []
    starts, used = [], 0
    for words in texts:
        starts.append(len(out))
        ids: dict[bytes, int] = {}
        for w in words:
            out.append(used + ids.setdefault(w, len(ids)))
        used += len(ids) + 1
        out.append(used - 1)
    return np.array(out, np.int64), np.array(starts, np.int64)


def suffix_order(ids: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose first ``depth`` words (a power of two) occur again, in suffix
    order, and whether each shares them with the one before."""
    n = len(ids)
    ranks = np.empty(n, np.int64)  # suffix-order place of the first of a position's group
    alive = np.argsort(ids, kind="stable")
    first, base, second = ids[alive], np.zeros(n, np.int64), np.zeros(n, np.int64)
    span, kept, classes = 1, None, None
    while True:
        # ``alive`` is sorted by the first ``span`` words: ``first``, a group so far, then ``second``.
        opens = np.ones(len(alive), bool)
        opens[1:] = first[1:] != first[:-1]
        splits = opens.copy()
        splits[1:] |= second[1:] != second[:-1]
        at = np.arange(len(alive))
        place = np.maximum.accumulate(np.where(splits, at, 0))
        ranks[alive] = base + place - (np.maximum.accumulate(np.where(opens, at, 0)) if span > 1 else 0)
        alive = alive[~(splits & np.append(splits[1:], True))]
        if span == depth:
            kept, classes = alive, ranks[alive]
        if not len(alive):
            break
        base = ranks[alive]
        second = ranks[np.minimum(alive + span, n - 1)]
        by = np.lexsort((second, base))
        alive, base, second = alive[by], base[by], second[by]
        first, span = base, 2 * span
    if kept is None:
        return np.zeros(0, np.int64), np.zeros(0, bool)
    by = np.argsort(ranks[kept], kind="stable")
    kept, classes = kept[by], classes[by]
    same = np.zeros(len(kept), bool)
    same[1:] = classes[1:] == classes[:-1]
    return kept, same


def common_prefixes(ids: np.ndarray, order: np.ndarray, same: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(LCP, suffix before, suffix) of neighbours in suffix order that share ``least`` words."""
    before = np.where(same, np.roll(order, 1), -1)
    by = np.argsort(order, kind="stable")
    words = ids.tolist()
    edges, size, last = [], 0, -2
    for here, other in zip(order[by].tolist(), before[by].tolist()):
        size = max(size - (here - last), 0)
        last = here
        if other < 0:
            size = 0
            continue
        a, b = here + size, other + size
        while words[a] == words[b]:
            a += 1
            b += 1
        size = a - here
        if size >= least:
            edges.append((size, other, here))
    return edges


def runs_of(ids: np.ndarray, min_length: int, exponent: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run in numbered words."""
    least = least_lcp(min_length, exponent)
    if len(ids) <= least:
        return []
    depth = 1 << (least.bit_length() - 1)
    edges = common_prefixes(ids, *suffix_order(ids, depth), least)
    edges.sort(key=lambda e: -e[0])
    words = ids.tolist()
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}

    def find(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while (up := parent.get(x, x)) != top:
            parent[x], x = top, up
        return top

    found = set()
    for lcp, level in groupby(edges, key=lambda e: e[0]):
        came: dict[int, list[int]] = {}  # class to the positions that joined it at this LCP
        for _, a, b in level:
            a, b = find(a), find(b)
            if a == b:
                continue
            size_a = len(members.setdefault(a, [a])) + len(came.get(a, ()))
            size_b = len(members.setdefault(b, [b])) + len(came.get(b, ()))
            if size_a < size_b:
                a, b = b, a
            parent[b] = a
            came.setdefault(a, []).extend(members.pop(b))
            came[a].extend(came.pop(b, ()))
        for top, joined in came.items():
            places = members[top]
            if 4 * len(joined) < len(places):
                for p in joined:
                    insort(places, p)
                pairs = set()
                for p in joined:
                    i = bisect_left(places, p)
                    pairs.update(zip(places[max(0, i - 1) : i + 1], places[max(0, i - 1) + 1 : i + 2]))
            else:
                places += joined
                places.sort()
                pairs = zip(places, places[1:])
            for p, r in pairs:
                q = r - p
                if q <= lcp and lcp + q >= max(min_length, exponent * q) and words[p - 1] != words[r - 1] and words[p + lcp] != words[r + lcp]:
                    found.add((p, lcp + q, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def text_runs(texts: list[list[bytes]], min_length: int, exponent: int) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, by start and period."""
    ids, starts = numbered(texts)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    found = runs_of(ids, min_length, exponent)
    if found:
        where = np.searchsorted(starts, [r[0] for r in found], side="right") - 1
        for (start, length, period), t in zip(found, where.tolist()):
            out[t].append((start - int(starts[t]), length, period))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """``words`` without those that a run repeats after its first period."""
    if not runs:
        return words
    kept, at = [], 0
    for start, end in sorted((s + q, s + n) for s, n, q in runs):
        kept += words[at:start] if start > at else []
        at = max(at, end)
    return kept + words[at:]


def _row(doc_id, words, runs):
    digest = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    longest = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    start, length, period = longest or (None, None, None)
    return (
        doc_id, len(runs), start, length, period, 1000 * length // period if longest else None,
        hashlib.sha256(digest.encode()).hexdigest(), hashlib.sha256(b" ".join(collapsed(words, runs))).hexdigest(),
    )


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6, exponent: int = 4) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_runs, the longest run's start, length,
    period and exponent_milli, and SHA-256 of all runs and of the text with every
    run's repetitions taken out."""
    if exponent < 2:
        raise ValueError("exponent must be at least 2")
    types = [pa.int64()] * 6 + [pa.string()] * 2
    names = [f.split()[0] for f in _SCHEMA.split(", ")]

    def run(batches):
        for batch in batches:
            held, size = [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = (text.as_py() or b"").split()
                if held and size + len(words) > TOGETHER:
                    yield solved(held)
                    held, size = [], 0
                held.append((doc_id, words))
                size += len(words)
            if held:
                yield solved(held)

    def solved(held):
        found = text_runs([w for _, w in held], min_length, exponent)
        rows = [_row(i, w, r) for (i, w), r in zip(held, found)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return chosen.mapInArrow(run, _SCHEMA)


def with_planted_periods(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (id and text) where about a tenth of the texts become periodic: with h the
    CRC-32 of the decimal id and g = floor(h / 10), if h % 10 = 0, every word from
    a = g % n on is replaced by word a + (i - a) % p, p = 1 + floor((n - a) / (3 + g % 8)).
    Texts without an id or words stay."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def damaged(words: Column) -> Column:
        n = F.size(words)
        a = F.pmod(g, n).cast("int")
        p = (F.floor((n - a) / (F.pmod(g, F.lit(8)) + 3)) + 1).cast("int")
        place = lambda i: F.when(i >= a, a + F.pmod(i - a, p)).otherwise(i)
        return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, place(i))), " ")

    words = F.filter(F.split(F.col(text_col), SPACE), lambda w: w != "")
    # A one-element array binds the words, so that they are split once, not once per word.
    bound = F.get(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, damaged(w))), 0)
    text = F.when(h % 10 == 0, F.coalesce(bound, F.col(text_col))).otherwise(F.col(text_col))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
