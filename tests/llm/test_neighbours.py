from __future__ import annotations

import numpy as np
import pytest

from tierwise.llm import neighbours

SF = "/root/testdata/sf0.01"


def brute(ids, vectors, every, top):
    out = {}
    for q in sorted({i for i in ids if i % every == 0}):
        at = int(np.flatnonzero(ids == q)[0])
        scores = neighbours.cosines(vectors, np.broadcast_to(vectors[at], vectors.shape))
        others = np.flatnonzero(ids != q)
        best = others[np.lexsort((ids[others], -scores[others]))][:top]
        out[q] = [(int(ids[i]), scores[i]) for i in best]
    return out


def found(df, **options):
    out = {}
    for r in sorted(neighbours.nearest_neighbours(df, **options).collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = df.select("vec_id", "embedding").collect()
    return df, np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)


def test_recall_and_exact_scores(spark):
    df, ids, vectors = table(spark)
    expected, got = brute(ids, vectors, 50, 5), found(df)
    hits = sum(len({i for i, _ in expected[q]} & {i for i, _ in got[q]}) for q in expected)
    assert hits / (5 * len(expected)) >= 0.9 and all(len(v) == 5 for v in got.values())
    near = {(q, i): s for q in expected for i, s in expected[q]}
    assert all(abs(near[q, i] - s) < 1e-12 for q in got for i, s in got[q] if (q, i) in near)


def test_all_lists_find_nearly_everything(spark):
    df, ids, vectors = table(spark)
    expected, got = brute(ids, vectors, 10, 5), found(df, query_every=10, probe_share=1.0)
    same = sum([i for i, _ in expected[q]] == [i for i, _ in got[q]] for q in expected)
    assert same >= 0.9 * len(expected)  # the dimension scan's tests may miss a few


def test_ties_copies_and_small_cells(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CELL_ROWS", 7)
    rows = [(i, [1.0, 2.0, 0.5]) for i in range(40)] + [(100 + i, [float(i), 1.0, -1.0]) for i in range(1, 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = found(df, query_every=20, probe_share=1.0)
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5] and [i for i, _ in got[20]] == [0, 1, 2, 3, 4]
    assert all(abs(s - 1) < 1e-12 for _, s in got[0])


@pytest.mark.parametrize("scale", [1e200, 1e-200])
def test_unusable_vectors_take_no_part(spark, scale):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [scale, 0.0], 1), (1, [scale, scale], 1), (2, None, 1), (3, [0.0, 0.0], 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1),
            (6, [None, 1.0], 1), (7, [1.0], 1), (8, [], 1), (None, [1.0, 1.0], 1), (50, [0.0, -scale], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, kind int")
    got = found(df)
    assert [i for i, _ in got[0]] == [1, 50] and abs(got[0][0][1] - 0.5**0.5) < 1e-12
    assert [i for i, _ in got[50]] == [0, 1] and sorted(got) == [0, 50]


def test_empty_and_lonely(spark):
    schema = "vec_id long, embedding array<float>"
    assert neighbours.nearest_neighbours(spark.createDataFrame([], schema)).collect() == []
    assert neighbours.nearest_neighbours(spark.createDataFrame([(0, [1.0, 2.0])], schema)).collect() == []
    repeated = spark.createDataFrame([(0, [1.0, 2.0]), (0, [2.0, 1.0]), (1, [1.0, 1.0])], schema)
    assert [(r.query_id, r["rank"], r.vec_id) for r in neighbours.nearest_neighbours(repeated).collect()] == [(0, 1, 1)]


def clustered(groups, each, dims=32, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, dims))
    return np.repeat(centres, each, axis=0) + 0.3 * rng.standard_normal((groups * each, dims))


def test_clusters_visit_few_lists_at_the_same_recall(spark, monkeypatch):
    shares = []
    visited = neighbours.Lists.visited

    def counted(self, *args):
        out = visited(self, *args)
        shares.append((out * self.sizes).sum(axis=1).mean() / self.sizes.sum())
        return out

    vectors = clustered(40, 100)
    ids = np.arange(len(vectors))
    unit = neighbours._unit(vectors)
    centres = neighbours.fit_centres(vectors, 320)
    near, cosine = neighbours.nearest_centre(unit, centres)
    sizes = np.bincount(near, minlength=320)
    lists = neighbours.Lists(centres, sizes, np.bincount(near, cosine, 320) / np.maximum(sizes, 1), 1024)
    monkeypatch.setattr(neighbours.Lists, "visited", counted)
    queries = np.flatnonzero(ids % 50 == 0)
    places, to_beat = neighbours.best_seeds(ids[queries], vectors[queries], ids[::2], vectors[::2], 5)
    true = np.argsort(-(unit[queries] @ unit.T - 9 * (ids[queries][:, None] == ids[None, :])), axis=1)[:, :5]
    z = np.quantile(np.take_along_axis(lists.need(vectors[queries], to_beat), near[true], axis=1), 0.95)
    lists.visited(vectors[queries], to_beat, near[::2][places], z, None)
    assert shares[0] < 0.1
    df = spark.createDataFrame(list(zip(ids.tolist(), vectors.tolist())), "vec_id long, embedding array<double>")
    expected, got = brute(ids, vectors, 50, 5), found(df)
    hits = sum(len({i for i, _ in expected[q]} & {i for i, _ in got[q]}) for q in expected)
    assert hits / (5 * len(expected)) >= 0.9 and all(len(v) == 5 for v in got.values())


def test_cells_hold_every_list_once():
    rng = np.random.default_rng(1)
    centres = neighbours._unit(rng.standard_normal((50, 8)))
    sizes = rng.integers(0, 40, 50)
    sizes[7] = 333
    lists = neighbours.Lists(centres, sizes, np.full(50, 0.8), 64)
    rows = np.zeros(int((lists.cell + lists.cells).max()), np.int64)
    for cell, n, size in zip(lists.cell, lists.cells, sizes):
        rows[cell : cell + n] += -(-size // n)
    assert (rows <= 64).all() and lists.cells[7] == 6 and (lists.cell[np.arange(50) != 7] != lists.cell[7]).all()


def test_repeated_rows_and_hot_ids(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CELL_ROWS", 16)
    rng = np.random.default_rng(5)
    rows = [(50, [1.0, 0.0, 0.1])] * 60 + [(0, [1.0, 0.1, 0.1])] * 3 + [(int(i), rng.standard_normal(3).tolist()) for i in range(1, 40)]
    got = found(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert [i for i, _ in got[0]] == [50] * 5
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    assert [i for i, _ in got[50]][:3] == [0, 0, 0] and got[50] == brute(ids, vectors, 50, 5)[50]
