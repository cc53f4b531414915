from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from helpers import TEXTS, documents, empty, messy

from tierwise.llm import simhash


def plain_print(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    counts = [0] * 64
    for g in grams:
        h = xxhash.xxh64(g.encode(), seed=42).intdigest()
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(grams))


def plain_components(prints, bits):
    a, parent = np.array(prints, np.uint64), list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= bits):
            x, y = root(i), root(int(j))
            parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(a))]


def test_fingerprints_and_components_against_brute_force(spark):
    docs = documents(spark)
    texts = sorted((r.doc_id, r.text) for r in docs.collect())
    rows = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    prints = [plain_print(t) for _, t in texts]
    assert [int(rows[i].fingerprint, 16) for i, _ in texts] == prints
    roots = plain_components(prints, 2)
    assert [rows[i].component_id for i, _ in texts] == [texts[r][0] for r in roots]


@pytest.mark.parametrize("blocks", [1, 7])
def test_links_join_exactly_the_near_fingerprints(spark, monkeypatch, blocks):
    monkeypatch.setattr(simhash, "MIN_BLOCKS", blocks)
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(150)] + [0, 2**64 - 1, 2**63]
    prints = set(centres)
    for c in centres[::3]:
        for _ in range(12):
            c ^= 1 << rng.randrange(64)
            prints.add(c)
    prints = sorted(prints)
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in prints]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"), 2)
    assert edges.count() < len(prints)  # a forest per block, not all pairs
    found = {r.vertex: r.root for r in simhash.components(edges).collect()}
    got = [found.get(s, s) for (s,) in signed]
    roots = plain_components(prints, 2)
    assert len(set(zip(got, roots))) == len(set(got)) == len(set(roots))


def test_tree_search_prunes_nothing_near():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 2**64, 500, dtype=np.uint64) & np.uint64(0xFFFF0000000000FF))
    tree = simhash.GrayTree(a, np.full(len(a), simhash._ALL))
    found = {(int(q), int(e)) for qs, es in tree.search(a, 3) for q, e in zip(qs, es)}
    assert found == {(i, int(j)) for i in range(len(a)) for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= 3)}


def test_messy_rows(spark):
    rows = simhash.near_duplicates(messy(spark)).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        if r.doc_id in (3, 4, 7):  # null, empty and blank texts share fingerprint zero
            assert r.fingerprint == "0" * 16 and r.component_id == 3
        if r.doc_id == 2:
            assert r.component_id == 1
    assert simhash.near_duplicates(empty(spark)).collect() == []


def test_deduplicate_keeps_one_of_each_group(spark):
    docs = messy(spark)
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    assert ids == sorted([1, 3, None, 5, 6, 8, 9, 10, 11], key=str)
    real = documents(spark)
    smallest = {r.component_id for r in simhash.near_duplicates(real).collect()}
    assert sorted(r.doc_id for r in simhash.deduplicate(real).collect()) == sorted(smallest)
    assert simhash.deduplicate(empty(spark)).collect() == []


def test_components_of_a_long_chain(spark):
    edges = spark.range(0, 200).selectExpr("id AS a", "id + 1 AS b")
    assert {(r.vertex, r.root) for r in simhash.components(edges).collect()} == {(i, 0) for i in range(1, 201)}
