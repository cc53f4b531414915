"""SimHash near-duplicates over a Gray-order hierarchical index.

Fingerprints: A-Z lower-cased, words split at ASCII white space, shingles of
``shingle`` words (all of the words if there are fewer), XXH64 with seed 42, a
bit set when it is set in over half of the hashes. Texts without words, null
and empty ones included, have fingerprint zero.

Index: the distinct fingerprints are ranked by Gray code and cut into blocks of
equal size by range. In a block, and over the blocks' roots, consecutive
entries are grouped ``FAN`` at a time; the bits on which a whole group agrees
move up into a parent node (a mask and a pattern). A search goes down from the
top, adds at every node the differences on the node's own bits, and leaves a
group as soon as the sum exceeds the distance. Every fingerprint is searched
over the roots (at most ``MAX_BLOCKS`` of them, so the table of roots has a
fixed bound), sent to the later blocks whose root it passes, and searched
there; members of one block are searched against each other in place.

Links: a block hands on a spanning forest of what it found, never all pairs;
components come from alternating large-star and small-star steps, each written
to the shared folder. Equal fingerprints are one vertex, so thousands of exact
copies cost one. Documents get their component through the fingerprint; those
of hot fingerprints (a bounded number) by a broadcast of those few, the rest by
a shuffle join.

Rows of one doc_id are all returned. Null ids take part and get a component;
a component of null ids alone has a null component_id. Extra columns are not
read (``deduplicate`` keeps them). An empty table gives no rows.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import store
from .names import free

SEED = 42
FAN = 8
BLOCK_ROWS = 65_536
MIN_BLOCKS = 32
MAX_BLOCKS = 65_536
HASH_CHUNK = 65_536


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64-bit fingerprint of a text, unsigned."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8").lower().split() if text else []  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) < shingle:
        grams, n = iter([b" ".join(words)]), 1
    else:
        n = len(words) - shingle + 1
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = np.fromiter(map(xxh64_intdigest, grams, repeat(SEED)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, HASH_CHUNK):
        part = hashes[at : at + HASH_CHUNK]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, text_col: str, out_col: str, shingle: int, keep: list[str]) -> DataFrame:
    """``keep`` and the fingerprint as a signed long, in one pass over the scan."""
    chosen = docs.select(*keep, F.col(text_col).cast("string").alias(*free(keep, "text_to_print")))
    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField(out_col, T.LongType())])

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            prints = np.array([fingerprint(t.as_py(), shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(prints)], [*keep, out_col])

    return chosen.mapInArrow(run, schema)


class GrayTree:
    """Entries in Gray order (patterns on their masks) under nodes of shared bits."""

    def __init__(self, patterns: np.ndarray, masks: np.ndarray):
        levels = [(patterns & masks, masks)]
        while len(levels[-1][0]) > FAN:
            pat, mask = levels[-1]
            short = -len(pat) % FAN
            pat, mask = np.pad(pat, (0, short), mode="edge").reshape(-1, FAN), np.pad(mask, (0, short), mode="edge").reshape(-1, FAN)
            ones, zeros = np.bitwise_and.reduce(pat, axis=1), np.bitwise_or.reduce(pat, axis=1)
            shared = np.bitwise_and.reduce(mask, axis=1) & ~(ones ^ zeros)
            levels.append((ones & shared, shared))
        # What a node adds to its parent's bits.
        self.levels = []
        for k, (pat, mask) in enumerate(levels):
            above = np.repeat(levels[k + 1][1], FAN)[: len(mask)] if k + 1 < len(levels) else np.uint64(0)
            self.levels.append((pat, mask & ~above))

    def search(self, queries: np.ndarray, most: int):
        """(query, entry) index arrays of the entries within ``most`` bits."""
        for at in range(0, len(queries), 4096):
            part = queries[at : at + 4096]
            top = len(self.levels[-1][0])
            q, node = np.repeat(np.arange(len(part)), top), np.tile(np.arange(top), len(part))
            sums = np.zeros(len(q), np.uint8)
            for k in range(len(self.levels) - 1, -1, -1):
                pat, mask = self.levels[k]
                sums = sums + np.bitwise_count((part[q] ^ pat[node]) & mask[node])
                near = np.flatnonzero(sums <= most)
                q, node, sums = q[near], node[near], sums[near]
                if k:
                    q, sums = np.repeat(q, FAN), np.repeat(sums, FAN)
                    node = (node[:, None] * FAN + np.arange(FAN)).reshape(-1)
                    real = node < len(self.levels[k - 1][0])
                    q, node, sums = q[real], node[real], sums[real]
            yield q + at, node


class _Forest:
    """Union-find over fingerprints; says which links joined two trees."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent.setdefault(up, up)
            x = parent[x]
        return x

    def joins(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def gray_rank(col):
    """Rank of a 64-bit pattern in Gray-code order, as a long that sorts like it."""
    for shift in (1, 2, 4, 8, 16, 32):
        col = col.bitwiseXOR(F.shiftrightunsigned(col, shift))
    return col.bitwiseXOR(F.lit(-(2**63)))


_ALL = np.uint64(2**64 - 1)


def links(prints: DataFrame, max_bits: int) -> DataFrame:
    """A spanning forest (a, b) of the links between distinct fingerprints ``fp``
    at most ``max_bits`` apart."""
    spark = prints.sparkSession
    # Each block more is another place a search may have to look, so their number
    # follows the fingerprints, not the cluster.
    blocks = min(MAX_BLOCKS, max(MIN_BLOCKS, -(-prints.count() // BLOCK_ROWS)))
    ranged = prints.select("fp", gray_rank(F.col("fp")).alias("rank")).repartitionByRange(blocks, "rank")
    index = store(
        spark, ranged.sortWithinPartitions("rank").select("fp", "rank", F.spark_partition_id().alias("block")), "simhash-index"
    )
    roots = index.groupBy("block").agg(F.expr("bit_and(fp)").alias("ones"), F.expr("bit_or(fp)").alias("any")).orderBy("block").collect()
    numbers = np.array([r["block"] for r in roots], np.int32)
    ones = np.array([r["ones"] for r in roots], np.int64).view(np.uint64)
    shared = ~(ones ^ np.array([r["any"] for r in roots], np.int64).view(np.uint64))

    def route(batches):
        tree = GrayTree(ones, shared)
        for batch in batches:
            fps, own = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for q, node in tree.search(fps.view(np.uint64), max_bits):
                later = numbers[node] > own[q]
                if later.any():
                    q, node = q[later], node[later]
                    yield pa.RecordBatch.from_arrays([pa.array(numbers[node]), pa.array(fps[q])], ["block", "fp"])

    def match(batches):
        forest, now, held, tree, members = None, None, [], None, None

        def pairs(found, queries):
            a, b = [], []
            for q, e in found:
                for x, y in zip(queries[q].tolist(), members[e].tolist()):
                    if x != y and forest.joins(x, y):
                        a.append(x)
                        b.append(y)
            if a:
                ab = np.array([a, b], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ab[0]), pa.array(ab[1])], ["a", "b"])

        def built():
            nonlocal tree, members
            if tree is None and held:
                members = np.concatenate(held).view(np.uint64)
                tree = GrayTree(members, np.full(len(members), _ALL))
                yield from pairs(tree.search(members, max_bits), members)

        for batch in batches:
            block, kind, fps = (batch.column(k).to_numpy() for k in range(3))
            cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(kind) != 0)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(fps)]):
                if hi == lo:
                    continue
                if block[lo] != now:
                    yield from built()
                    forest, now, held, tree = _Forest(), block[lo], [], None
                if kind[lo] == 0:
                    held.append(fps[lo:hi].copy())
                else:
                    yield from built()
                    queries = fps[lo:hi].copy().view(np.uint64)
                    yield from pairs(tree.search(queries, max_bits), queries)
        yield from built()

    routed = index.select("fp", "block").mapInArrow(route, "block int, fp long")
    rows = index.select("block", F.lit(0).alias("kind"), "fp", "rank").unionByName(
        routed.select("block", F.lit(1).alias("kind"), "fp", F.lit(0).cast("long").alias("rank"))
    )
    # Within a block its members come first, in Gray order, then the searches stream by.
    dealt = rows.repartition(blocks, "block").sortWithinPartitions("block", "kind", "rank").select("block", "kind", "fp")
    return store(spark, dealt.mapInArrow(match, "a long, b long"), "simhash-links")


def components(edges: DataFrame) -> DataFrame:
    """(vertex, root) of every vertex of ``edges`` (a, b) but the roots themselves:
    alternating large-star and small-star steps until the stars stand."""
    spark = edges.sparkSession
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = store(spark, small.select("e.u", "e.v").where("u != v").distinct(), "components")
        now = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
        if now == before:
            return edges.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
        before = now


def fingerprint_groups(prints: DataFrame, best, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """Of rows with ``fp``: (fp, copies, root, own) per distinct fingerprint, where
    ``own`` is the aggregate ``best`` over its rows and root stands for the
    component, and (root, best) per component."""
    spark = prints.sparkSession
    distinct = store(spark, prints.groupBy("fp").agg(F.count("*").alias("copies"), best.alias("own")), "simhash-distinct")
    stars = components(links(distinct.select("fp"), max_bits))
    rooted = distinct.join(stars, distinct["fp"] == stars["vertex"], "left").select(
        "fp", "copies", F.coalesce("root", "fp").alias("root"), "own"
    )
    rooted = store(spark, rooted, "simhash-rooted")
    return rooted, rooted.groupBy("root").agg(F.min("own").alias("best"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits) and
    component_id, the smallest doc_id reached over links of ``max_bits`` or fewer bits."""
    spark = docs.sparkSession
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    prints = store(spark, with_fingerprint(chosen, "text", "fp", shingle, ["doc_id"]), "simhash-prints")
    rooted, best = fingerprint_groups(prints, F.min("doc_id"), max_bits)
    by_print = store(
        spark, rooted.join(best, "root").select("fp", "copies", F.col("best").alias("component_id")), "simhash-components"
    )
    # Hot: over a 4096th of all rows, so there are at most 4096 of them.
    hot_rows = prints.count() // 4096 + 1
    hot = F.broadcast(by_print.where(F.col("copies") > hot_rows).select("fp", "component_id", F.lit(True).alias("hot")))
    tagged = prints.join(hot, "fp", "left")
    cold = tagged.where("hot IS NULL").select("doc_id", "fp").join(by_print.where(F.col("copies") <= hot_rows), "fp")
    out = tagged.where("hot").select("doc_id", "fp", "component_id").unionByName(cold.select("doc_id", "fp", "component_id"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, null ids
    last; of rows equal in id and fingerprint, any one."""
    spark = docs.sparkSession
    fp, row, kept_row = free(docs.columns, "fp", "row", "kept_row")
    printed = with_fingerprint(docs, text_col, fp, shingle, docs.columns)
    # Stored, so that a row keeps its number: what stays is decided on narrow rows, and texts meet it once.
    printed = store(spark, printed.withColumn(row, F.monotonically_increasing_id()), "simhash-printed")
    rank = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("fp"), F.col("row"))
    keys = printed.select(F.col(id_col).alias("id"), F.col(fp).alias("fp"), F.col(row).alias("row"))
    _, best = fingerprint_groups(keys, F.min(rank), max_bits)
    kept = best.select(F.col("best.row").alias(kept_row))
    return printed.join(kept, printed[row] == kept[kept_row], "left_semi").select(*docs.columns)
