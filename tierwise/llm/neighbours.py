"""Approximate nearest neighbours by cosine: inverted lists with an adaptive dimension scan.

Index: spherical k-means centres are fitted on a bounded sample (``SAMPLE_ROWS``
rows and ``SAMPLE_BYTES`` bytes at most, chosen by a hash of the id); every
vector of the table goes to the list of its nearest centre. Neighbouring lists stand
together in cells of ``CELL_ROWS`` vectors; a list larger than that is cut into
cells by a hash of the id, so a list of a third of all vectors is many cells.

Lists to visit: the ``top``-th best cosine to at most ``SEEDS`` stored vectors is a
proven bound for a query. A list whose members have mean cosine m to its centre c
and spread s beside it is visited when ``m * cos(q, c) + z * s`` reaches that bound.
z is calibrated: ``CALIBRATION`` queries are held against all vectors, and z is the
least that visits the lists of a share ``recall`` of their true neighbours. Data with
clear clusters visit few lists, data without any visit many, at the same recall.
The lists of the seeds that gave the bound are visited always.

Search: a query goes once to every cell it has lists in. There the unit vectors stand
randomly rotated in blocks of ``DIMS`` columns. Distances grow block by block; after d
of D dimensions a candidate is abandoned when its partial squared distance exceeds
``r2 * d / D * (1 + EPS / sqrt(d))**2``, where r2 is the distance to beat: under
a random rotation that rejects the hypothesis that it is a neighbour. r2 starts at the
query's bound and shrinks list by list. What stays gets its exact cosine in double
precision from the original vectors; the best of each cell are merged per query, with
the seeds that gave its bound, so that every query has its ``top`` rows.

Of equal vectors in a cell the first by id are enough for every query, and only those
are looked at: a group of copies costs no more than a few rows.

A cell's vectors are bounded and held, the queries stream by; nothing but the
sample, the seeds, the lists' sizes and spreads and the calibration's neighbours
(``top`` for each of its queries) reaches the driver.

No part take: vectors that are null or zero or hold null or non-finite
components, rows without an id, and vectors of another length than most have
(the longer of two equally frequent lengths). A query's own id is no candidate
for it; of several rows with one id, all are candidates and the least is the
query. Ties go to the smaller id. Extra columns are not read. An empty table,
and one without candidates, gives no rows.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import store

SAMPLE_ROWS = 20_000
SAMPLE_BYTES = 32 << 20
MAX_LISTS = 2048
CELL_ROWS = 16_384
CELL_BYTES = 16 << 20
SEEDS = 2048
CALIBRATION = 256
DIMS = 16
EPS = 2.1
PAIRS = 1 << 19  # pairs of query and vector looked at together
SEED = 7
_RESULT = "query_id long, rank int, vec_id long, score double"


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A binary column of doubles as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, dims)


def cosines(vectors: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Exact cosines row by row; a row's value does not depend on the rows beside it."""
    dots = (vectors * queries).sum(axis=1)
    norms = np.sqrt((vectors * vectors).sum(axis=1)) * np.sqrt((queries * queries).sum(axis=1))
    with np.errstate(all="ignore"):
        out = dots / norms
    odd = ~np.isfinite(out) | (norms < 1e-290)
    if odd.any():  # squares overflow or vanish: the same measure on scaled vectors
        out[odd] = (_unit(vectors[odd]) * _unit(queries[odd])).sum(axis=1)
    return out


def nearest_centre(unit: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each row and the cosine to it, in blocks of rows."""
    near, score = np.empty(len(unit), np.int32), np.empty(len(unit))
    for at in range(0, len(unit), 1024):
        cos = unit[at : at + 1024] @ centres.T
        near[at : at + 1024], score[at : at + 1024] = cos.argmax(axis=1), cos.max(axis=1)
    return near, score


def fit_centres(sample: np.ndarray, lists: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means on the bounded sample."""
    unit, rng = _unit(sample), np.random.default_rng(SEED)
    centres = unit[rng.permutation(len(unit))[:lists]].copy()
    for _ in range(rounds):
        near, _ = nearest_centre(unit, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, unit)
        size = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(size > 1e-12, sums / np.maximum(size, 1e-12), centres)
    return centres


class Lists:
    """The lists' centres, sizes and spreads, the cells they stand in, and which of them a query visits."""

    def __init__(self, centres: np.ndarray, sizes: np.ndarray, cosine: np.ndarray, cell_rows: int):
        self.centres, self.sizes, self.cosine = centres, sizes, cosine
        # Beside the centre a member's unit vector spreads over all dimensions alike.
        self.spread = np.sqrt(np.maximum(1 - cosine * cosine, 1e-6) / centres.shape[1])
        self.cells = np.maximum(1, -(-sizes // cell_rows)).astype(np.int64)
        self.cell = np.zeros(len(sizes), np.int64)  # the first of each list's cells
        groups = nearest_centre(centres, fit_centres(centres, max(1, int(len(centres) ** 0.5))))[0]
        at, held = 0, 0
        for k in np.lexsort((np.arange(len(sizes)), groups)).tolist():
            if held and (held + sizes[k] > cell_rows):
                at, held = at + 1, 0
            self.cell[k] = at
            held += sizes[k]
            if self.cells[k] > 1:
                at, held = at + self.cells[k], 0

    def need(self, queries: np.ndarray, to_beat: np.ndarray) -> np.ndarray:
        """Per query and list, how many spreads a member must stand out to reach the query's cosine to beat."""
        return (to_beat[:, None] - self.cosine * (_unit(queries) @ self.centres.T)) / self.spread

    def visited(self, queries: np.ndarray, to_beat: np.ndarray, seeds: np.ndarray, z: float, share: float | None) -> np.ndarray:
        """Per query and list, whether it is visited; ``seeds`` are lists that are, or -1."""
        if share is None:
            visit = self.need(queries, to_beat) <= z
        else:
            order = np.argsort(-(_unit(queries) @ self.centres.T), axis=1, kind="stable")
            visit = np.zeros(order.shape, bool)
            np.put_along_axis(visit, order[:, : int(np.ceil(share * order.shape[1]))], True, axis=1)
        for column in seeds.T:
            visit[np.flatnonzero(column >= 0), column[column >= 0]] = True
        return visit & (self.sizes > 0)


def best_seeds(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, top: int):
    """Per query the places of its ``top`` best seeds (-1: too few), and the last one's cosine (minus infinity)."""
    places = np.full((len(queries), top), -1, np.int64)
    if len(ids) < top:
        return places, np.full(len(queries), -np.inf)
    score = _unit(queries) @ _unit(vectors).T
    score[ids[None, :] == query_ids[:, None]] = -np.inf
    order = np.argpartition(-score, top - 1, axis=1)[:, :top]
    last = np.take_along_axis(score, order, axis=1).min(axis=1)
    full = np.isfinite(last)
    places[full] = order[full]
    return places, last


class Cell:
    """One cell's vectors, list after list, rotated and in column blocks."""

    def __init__(self, lists: np.ndarray, ids: np.ndarray, vectors: np.ndarray, rotation: np.ndarray, top: int):
        # Rows stand by list and id. Of equal vectors, ``top`` rows an id and twice ``top`` in all
        # leave ``top`` rows to every query, whichever id is its own.
        same = np.unique(vectors.view(f"V{vectors.shape[1] * 8}").ravel(), return_inverse=True)[1]
        kept = np.lexsort((ids, same))
        kept = kept[_rank(same[kept], ids[kept]) < top]
        kept = np.sort(kept[_rank(same[kept]) < 2 * top])
        self.ids, self.vectors = ids[kept], vectors[kept]
        self.lists, first = np.unique(lists[kept], return_index=True)
        self.bounds = [*first.tolist(), len(kept)]
        turned = (_unit(self.vectors) @ rotation).astype(np.float32)
        self.dims = turned.shape[1]
        self.blocks = [np.ascontiguousarray(turned[:, at : at + DIMS]) for at in range(0, self.dims, DIMS)]

    def _scan(self, rows: slice, query_ids: np.ndarray, turned: np.ndarray, to_beat: np.ndarray):
        """Query, row and squared distance of the pairs that no test abandons."""
        q = row = far = None
        seen = 0
        for k, whole in enumerate(self.blocks):
            part, block = turned[:, k * DIMS : k * DIMS + whole.shape[1]], whole[rows]
            seen += block.shape[1]
            if q is None:
                dist = (part * part).sum(axis=1)[:, None] + (block * block).sum(axis=1)[None, :] - 2 * part @ block.T
                dist[self.ids[rows][None, :] == query_ids[:, None]] = np.inf
            else:
                diff = block[row] - part[q]
                far = far + np.einsum("ij,ij->i", diff, diff)
            slack = (1 + EPS / np.sqrt(seen)) ** 2 if seen < self.dims else 1.0
            bound = to_beat * np.float32(seen / self.dims * slack) + np.float32(1e-5)
            if q is None:
                q, row = np.nonzero((dist <= bound[:, None]) & np.isfinite(dist))
                far = dist[q, row]
            else:
                near = far <= bound[q]
                q, row, far = q[near], row[near], far[near]
        return q, row + rows.start, far

    def nearest(self, query_ids: np.ndarray, queries: np.ndarray, turned: np.ndarray, cosine: np.ndarray, asked, which, top: int):
        """Places of queries, ids and exact cosines of the best ``top`` rows found for each. ``asked`` are
        the lists to visit, ``which`` the query of each; ``cosine`` is the queries' bound."""
        to_beat = np.where(np.isfinite(cosine), 2 - 2 * cosine, np.inf).astype(np.float32)
        best = np.full((len(queries), top), np.inf, np.float32)
        order = np.argsort(asked, kind="stable")
        asked, which = asked[order], which[order]
        found = []
        for k, name in enumerate(self.lists.tolist()):
            rows = slice(self.bounds[k], self.bounds[k + 1])
            here = which[np.searchsorted(asked, name) : np.searchsorted(asked, name, side="right")]
            step = max(1, PAIRS // (rows.stop - rows.start))
            for at in range(0, len(here), step):
                some = here[at : at + step]
                q, row, far = self._scan(rows, query_ids[some], turned[some], to_beat[some])
                if not len(q):
                    continue
                order = np.lexsort((far, q))
                q, row, far = q[order], row[order], far[order]
                place = _rank(q)
                near = np.full((len(some), top), np.inf, np.float32)
                near[q[place < top], place[place < top]] = far[place < top]
                best[some] = np.partition(np.concatenate([best[some], near], axis=1), top - 1, axis=1)[:, :top]
                to_beat[some] = np.minimum(to_beat[some], best[some].max(axis=1))
                found.append((some[q], row, far))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        q, row, far = (np.concatenate(column) for column in zip(*found))
        near = far <= to_beat[q] + np.float32(1e-5)  # with the ties of the last
        q, row = q[near], row[near]
        scores = np.concatenate([cosines(self.vectors[row[at : at + PAIRS]], queries[q[at : at + PAIRS]]) for at in range(0, max(1, len(q)), PAIRS)])
        order = np.lexsort((self.ids[row], -scores, q))
        q, row, scores = q[order], row[order], scores[order]
        kept = _rank(q) < top
        return q[kept], self.ids[row[kept]], scores[kept]


def _rank(*keys: np.ndarray) -> np.ndarray:
    """The place of every row among neighbours of equal keys."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.any([key[1:] != key[:-1] for key in keys], axis=0)
    first = np.flatnonzero(new)
    return np.arange(len(new)) - np.repeat(first, np.diff([*first.tolist(), len(new)]))


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """vec_id and vec (an array of doubles) of the rows that take part, any length."""
    v = F.col(vec_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)).select(
        F.col(id_col).cast("long").alias("vec_id"), v.alias("vec")
    )


def nearest_neighbours(
    vectors: DataFrame, query_every: int = 50, top: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
    recall: float = 0.93, lists: int | None = None, probe_share: float | None = None,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` nearest rows found for every row
    whose id is divisible by ``query_every``. ``lists`` defaults to eight times the square
    root of the number of vectors, at most ``MAX_LISTS`` and an eighth of the sample. The
    lists visited are calibrated for ``recall``, or the nearest ``probe_share`` of them if given."""
    spark = vectors.sparkSession
    good = usable(vectors, id_col, vec_col)
    lengths = good.groupBy(F.size("vec").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    if lengths is None:
        return spark.createDataFrame([], _RESULT)
    dims, total = lengths["dims"], lengths["count"]
    good = good.where(F.size("vec") == dims)
    rows = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * dims)))
    chosen = good.where(F.pmod(F.xxhash64("vec_id"), F.lit(max(1, -(-total // rows)))) == 0).limit(rows).select("vec").collect()
    sample = np.array([r["vec"] for r in chosen] or [r["vec"] for r in good.limit(1).select("vec").collect()], np.float64)
    wanted = lists or min(MAX_LISTS, int(8 * total**0.5), len(sample) // 8)
    centres = fit_centres(sample, max(1, min(wanted, len(sample))))
    rotation = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dims, dims)))[0]

    def assign(batches):
        for batch in batches:
            column = batch.column(1)
            values = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            near, cosine = nearest_centre(_unit(values), centres)
            raw = [values[i].astype("<f8").tobytes() for i in range(len(values))]
            rows = pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(near), pa.array(cosine), pa.array(raw, pa.binary())], ["vec_id", "list", "cosine", "vec"]
            )
            seen: Counter = Counter()  # of rows equal in id and vector, ``top`` are enough for every query
            kept = []
            for row in zip(batch.column(0).to_pylist(), raw):
                seen[row] += 1
                kept.append(seen[row] <= top)
            yield rows if all(kept) else rows.filter(pa.array(kept))

    listed = store(spark, good.mapInArrow(assign, "vec_id long, list int, cosine double, vec binary"), "vectors-listed")
    sizes, mean = np.zeros(len(centres), np.int64), np.zeros(len(centres))
    for r in listed.groupBy("list").agg(F.count("*").alias("n"), F.avg("cosine").alias("cosine")).collect():
        sizes[r["list"]], mean[r["list"]] = r["n"], r["cosine"]
    # Cells of about a 64th of a small table, so that it is many tasks, too.
    index = Lists(centres, sizes, mean, min(CELL_ROWS, max(1, CELL_BYTES // (8 * dims)), max(256, total // 64)))
    asked = listed.where(F.col("vec_id") % query_every == 0).groupBy("vec_id").agg(F.min("vec").alias("vec"))

    # Seeds: stored rows by a hash of id and vector.
    part = F.pmod(F.xxhash64("vec", "vec_id"), F.lit(max(1, -(-total // SEEDS))))
    seeds = listed.where(part == 0).limit(SEEDS).select("vec_id", "list", "vec").collect()
    seed_ids = np.array([r["vec_id"] for r in seeds], np.int64)
    seed_lists = np.array([r["list"] for r in seeds] + [-1], np.int64)  # the last one for the place -1
    seed_vectors = np.frombuffer(b"".join(bytes(r["vec"]) for r in seeds), "<f8").reshape(-1, dims)
    z = np.inf
    if probe_share is None and recall < 1:
        z = _calibrated(listed, asked, index, (seed_ids, seed_vectors), dims, top, recall)

    def bounds(ids, queries):
        """The seeds that bound each query, and its cosine to beat, in blocks."""
        places, cosine = zip(*(best_seeds(ids[at : at + 512], queries[at : at + 512], seed_ids, seed_vectors, top) for at in range(0, len(ids), 512)))
        return np.concatenate(places), np.concatenate(cosine)

    def route(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, queries = batch.column(0).to_numpy(), _matrix(batch.column(1), dims)
            places, cosine = bounds(ids, queries)
            for at in range(0, len(ids), 1024):
                some = slice(at, at + 1024)
                q, name = np.nonzero(index.visited(queries[some], cosine[some], seed_lists[places[some]], z, probe_share))
                cells = index.cells[name]
                cell = np.repeat(index.cell[name], cells) + np.arange(cells.sum()) - np.repeat(np.cumsum(cells) - cells, cells)
                q, name = np.repeat(q, cells), np.repeat(name, cells)
                order = np.lexsort((name, cell, q))
                q, name, cell = q[order], name[order], cell[order]
                first = np.flatnonzero(_rank(q, cell) == 0)
                offsets = pa.array(np.append(first, len(q)).astype(np.int32))
                one = pa.array(q[first] + at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell[first]), batch.column(0).take(one), batch.column(1).take(one), pa.array(cosine[q[first] + at]),
                     pa.ListArray.from_arrays(offsets, pa.array(name.astype(np.int32)))],
                    ["cell", "vec_id", "vec", "cosine", "lists"],
                )

    def from_seeds(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, queries = batch.column(0).to_numpy(), _matrix(batch.column(1), dims)
            places, _ = bounds(ids, queries)
            q, k = np.nonzero(places >= 0)
            place = places[q, k]
            scores = cosines(seed_vectors[place], queries[q])
            yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(seed_ids[place]), pa.array(scores)], ["query_id", "vec_id", "score"])

    first_cell, cells = (F.element_at(F.lit(column.tolist()), F.col("list") + 1) for column in (index.cell, index.cells))
    stored = listed.select(
        (first_cell + F.pmod(F.xxhash64("vec_id"), cells)).alias("cell"), F.lit(0).alias("kind"), "list", "vec_id", "vec",
        F.lit(None).cast("double").alias("cosine"), F.lit(None).cast("array<int>").alias("lists"),
    )
    routed = asked.mapInArrow(route, "cell long, vec_id long, vec binary, cosine double, lists array<int>").select(
        "cell", F.lit(1).alias("kind"), F.lit(-1).alias("list"), "vec_id", "vec", "cosine", "lists"
    )

    def search(batches):
        now, held, cell = None, [], None
        for batch in batches:
            cells_, kinds, lists_, ids = (batch.column(k).to_numpy() for k in range(4))
            values = _matrix(batch.column(4), dims)
            cuts = np.flatnonzero((np.diff(cells_) != 0) | (np.diff(kinds) != 0)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ids)]):
                if lo == hi:
                    continue
                if cells_[lo] != now:
                    now, held, cell = cells_[lo], [], None
                if kinds[lo] == 0:
                    held.append((lists_[lo:hi].copy(), ids[lo:hi].copy(), values[lo:hi].copy()))
                    continue
                if cell is None and not held:
                    continue  # a hash that none of a large list's ids has
                if cell is None:
                    cell, held = Cell(*(np.concatenate(column) for column in zip(*held)), rotation, top), []
                asked_ = batch.column(6).slice(lo, hi - lo)
                which = np.repeat(np.arange(hi - lo), np.asarray(pc.list_value_length(asked_)))
                turned = (_unit(values[lo:hi]) @ rotation).astype(np.float32)
                cosine = batch.column(5).slice(lo, hi - lo).to_numpy()
                q, found, scores = cell.nearest(ids[lo:hi], values[lo:hi], turned, cosine, np.asarray(asked_.flatten()), which, top)
                yield pa.RecordBatch.from_arrays([pa.array(ids[lo:hi][q]), pa.array(found), pa.array(scores)], ["query_id", "vec_id", "score"])

    # In a cell its vectors come first, then the queries stream by.
    dealt = stored.unionByName(routed).repartition("cell").sortWithinPartitions("cell", "kind", "list", "vec_id")
    schema = "query_id long, vec_id long, score double"
    found = dealt.mapInArrow(search, schema).withColumn("seed", F.lit(0))
    found = found.unionByName(asked.mapInArrow(from_seeds, schema).withColumn("seed", F.lit(1)))
    # A seed that the search found, too, is one row; repeated rows are as many as there are.
    copies = F.greatest(F.count_if(F.col("seed") == 0), F.count_if(F.col("seed") == 1))
    merged = found.groupBy("query_id", "vec_id", "score").agg(copies.alias("copies"))
    merged = merged.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(top)).cast("int"))))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = merged.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _calibrated(listed: DataFrame, asked: DataFrame, index: Lists, seeds, dims: int, top: int, recall: float) -> float:
    """The least z that visits the lists of a share ``recall`` of the true neighbours of ``CALIBRATION`` queries,
    chosen by a hash and held against all vectors in one pass."""
    chosen = asked.orderBy(F.xxhash64("vec_id"), "vec_id").limit(CALIBRATION).collect()
    if not chosen:
        return np.inf
    ids = np.array([r["vec_id"] for r in chosen], np.int64)
    queries = np.frombuffer(b"".join(bytes(r["vec"]) for r in chosen), "<f8").reshape(-1, dims)
    to_beat = best_seeds(ids, queries, *seeds, top)[1]

    def nearest(batches):
        unit = _unit(queries)
        best, where = np.full((len(ids), top), -np.inf), np.full((len(ids), top), -1, np.int64)
        for batch in batches:
            rows, lists, values = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _matrix(batch.column(2), dims)
            for at in range(0, len(rows), 2048):
                part = slice(at, at + 2048)
                score = unit @ _unit(values[part]).T
                score[rows[part][None, :] == ids[:, None]] = -np.inf
                score, names = np.concatenate([best, score], axis=1), np.concatenate([where, np.tile(lists[part], (len(ids), 1))], axis=1)
                order = np.argpartition(-score, top - 1, axis=1)[:, :top]
                best, where = np.take_along_axis(score, order, axis=1), np.take_along_axis(names, order, axis=1)
        q, k = np.nonzero(np.isfinite(best))
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(where[q, k]), pa.array(best[q, k])], ["query", "list", "score"])

    found = listed.select("vec_id", "list", "vec").mapInArrow(nearest, "query long, list long, score double")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "list")
    true = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select("query", "list").collect()
    if not true:
        return np.inf
    need = index.need(queries, to_beat)[[r["query"] for r in true], [r["list"] for r in true]]
    return float(np.quantile(need, recall, method="higher"))
