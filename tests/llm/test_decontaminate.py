from __future__ import annotations

import random

from helpers import TEXTS, documents, empty, messy
from hypothesis import given, settings
from hypothesis import strategies as st

from tierwise.llm import decontaminate as dc

SF = "/root/testdata/sf0.01"


def edit_distances(pattern, text):
    """Last row of the plain dynamic programme: distance of the best substring ending at each place."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != x), row[j] + 1, new[-1] + 1))
        row = new
    return row


@settings(max_examples=150, deadline=None)
@given(st.text("ab c", min_size=1, max_size=20), st.text("ab c", max_size=40))
def test_bit_parallel_distance(pattern, text):
    row = edit_distances(pattern, text)
    best, end = dc.nearest_substring(pattern, text)
    assert best == min(row) and (best == len(pattern) or end == row.index(best))


def test_pieces_cover_the_item():
    for length in (40, 97, 394):
        for errors in (0, 3, 19):
            cuts = dc.pieces(length, errors)
            assert len(cuts) == errors + 1 and cuts[0][0] == 0 and cuts[-1][1] == length
            assert all(a[1] == b[0] for a, b in zip(cuts, cuts[1:])) and all(b > a for a, b in cuts)


def test_exact_copies_in_documents(spark):
    docs, bench = documents(spark, SF), spark.read.parquet(f"{SF}/benchmark.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    items = {r.item_id: dc.normal(r.text) for r in bench.collect()}
    expected = {(i, k) for i, t in texts.items() for k, v in items.items() if v in dc.normal(t)}
    found = dc.find_leaks(docs, bench).collect()
    assert expected <= {(r.doc_id, r.item_id) for r in found}
    assert all(dc.normal(texts[r.doc_id][r.start : r.end]) == items[r.item_id] for r in found if r.distance == 0)
    kept = {r.doc_id for r in dc.decontaminate(docs, bench).collect()}
    assert kept == set(texts) - {r.doc_id for r in found}


def test_edited_copies_against_the_plain_programme(spark, monkeypatch):
    rng = random.Random(2)
    words = ["river", "mill", "town", "bread", "glad", "old", "stone", "bridge", "water", "people", "market", "song"]
    items = [(k, " ".join(rng.choice(words) for _ in range(18))) for k in range(6)]
    docs = []
    for n in range(60):
        text = list(rng.choice(items)[1])
        for _ in range(rng.randint(0, 9)):
            at = rng.randrange(len(text))
            text[at] = rng.choice(["", "z", text[at] + "q"])
        docs.append((n, "Before it\n" + "".join(text).upper().replace(" ", rng.choice([" ", "  ", "\n"])) + " after it"))
    docs += [(100 + n, " ".join(rng.choice(words) for _ in range(40))) for n in range(20)]
    docs_df, items_df = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    expected = {
        (i, k) for i, t in docs for k, item in items if min(edit_distances(dc.normal(item), dc.normal(t))) <= int(0.05 * len(dc.normal(item)))
    }
    assert {(r.doc_id, r.item_id) for r in dc.find_leaks(docs_df, items_df).collect()} == expected
    monkeypatch.setattr(dc, "BLOCK_CHARS", 200)  # several blocks of items
    assert {(r.doc_id, r.item_id) for r in dc.find_leaks(docs_df, items_df).collect()} == expected
    assert {r.doc_id for r in dc.decontaminate(docs_df, items_df).collect()} == {i for i, _ in docs} - {i for i, _ in expected}


def test_messy_rows(spark):
    docs = messy(spark)
    bench = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "short", "x"), (None, TEXTS[0][1], "x"), (4, TEXTS[0][1], "x")], "item_id long, text string, key string")
    kept = dc.decontaminate(docs, bench)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    assert kept.count() == len(TEXTS) - 3  # the copies of the item go, null and empty texts stay
    assert {(r.doc_id, r.item_id, r.distance) for r in dc.find_leaks(docs, bench).collect()} == {(1, None, 0), (1, 4, 0), (2, None, 0), (2, 4, 0)}
    assert dc.decontaminate(docs, bench.limit(0)).count() == len(TEXTS)
    assert dc.find_leaks(empty(spark), bench).collect() == []


def test_short_items_match_unchanged_as_whole_words(spark):
    items = [(1, "What is the capital of France?"), (2, "Yes"), (3, ""), (4, None), (5, "ab ab"), (6, "(x)")]
    rows = [
        (1, "we asked: what is  the Capital of france? and left"), (2, "what is the capital of francey?"), (3, "yes."), (4, "eyes yesterday"),
        (5, "ab ab ab abc"), (6, "f(x) = 1"), (7, None), (8, "What is the capitol of France?"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = dc.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id, r.start, r.end) for r in found) == [(1, 1, 10, 41), (3, 2, 0, 3), (5, 5, 0, 5), (5, 5, 3, 8), (6, 6, 1, 4)]
    assert all(r.distance == 0 for r in found)
