from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from helpers import TEXTS, documents, empty, messy

from tierwise.llm import repeats


def brute(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[s : s + length] for _, b in texts for s in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        spans = []
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                if spans and s <= spans[-1][1]:
                    spans[-1][1] = s + length
                else:
                    spans.append([s, s + length])
        kept, at = b"", 0
        for a, e in spans:
            kept += b[at:a]
            at = e
        kept += b[at:]
        out.append((i, len(b), sum(e - a for a, e in spans), len(spans), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def ran(df, length):
    return sorted((tuple(r) for r in repeats.remove_repeats(df, length=length).collect()), key=str)


def test_documents_against_brute_force(spark):
    docs = documents(spark)
    assert ran(docs, 400) == brute([(r.doc_id, r.text) for r in docs.collect()], 400)


@pytest.mark.parametrize("in_task", [256, 4, 1])
def test_passages_periods_and_copies(spark, monkeypatch, in_task):
    monkeypatch.setattr(repeats, "IN_TASK", in_task)
    rng = random.Random(3)
    base = "".join(rng.choice("abcdefgh ") for _ in range(1500))
    noise = lambda: "".join(rng.choice("xyzw") for _ in range(120))
    rows = [(1, base), (2, base[200:900] + "x" + base[850:]), (3, "ab " * 200), (4, "é" * 120), (5, "é" * 120), (None, base[:300]), (None, base[:300])]
    rows += [(100 + i, noise() + base[700:860] + noise()) for i in range(12)]
    rows += [(200, "q" * 127), (201, "q" * 127), (202, "z" * 129)]
    assert ran(spark.createDataFrame(rows, "doc_id long, text string"), 128) == brute(rows, 128)


def test_texts_longer_than_a_segment(spark, monkeypatch):
    monkeypatch.setattr(repeats, "LONG", 1000)
    monkeypatch.setattr(repeats, "CHUNK", 700)
    rng = random.Random(4)
    base = "".join(rng.choice("abcd") for _ in range(3500))
    rows = [(1, base), (2, base[900:2300]), (3, base[:130] + base[3000:3200])]
    assert ran(spark.createDataFrame(rows, "doc_id long, text string"), 128) == brute(rows, 128)


def test_messy_rows(spark):
    few = [(i, t) for i, t in TEXTS if len(t or "") < 20_000]
    docs = messy(spark).where("text IS NULL OR length(text) < 20000")
    assert ran(docs, 64) == brute(few, 64)
    assert len(ran(messy(spark), 400)) == len(TEXTS)
    assert ran(empty(spark), 400) == []
    with pytest.raises(ValueError):
        repeats.remove_repeats(docs, length=63)


@pytest.mark.parametrize("length", [64, 100, 400])
def test_radix_passes_against_brute_force(spark, monkeypatch, length):
    # Every group goes through the passes: passages with edges everywhere, copies, periods and near copies.
    monkeypatch.setattr(repeats, "IN_TASK", 0)
    rng = random.Random(length)
    draw = lambda n, a="abcdefgh ": "".join(rng.choice(a) for _ in range(n))
    base = [draw(3 * length) for _ in range(4)]
    rows = []
    for i in range(60):
        text = draw(rng.randint(0, length))
        for _ in range(rng.randint(1, 3)):
            passage = rng.choice(base)
            a = rng.randint(0, len(passage) - length // 2)
            text += passage[a : a + rng.randint(length // 2, 2 * length)] + draw(rng.randint(0, length))
        rows.append((i % 55 or None, text))
    rows += [(100 + i, base[0][:length] + draw(3)) for i in range(9)] + [(200, "ab" * length), (201, "x" + "ab" * length), (202, "q" * 2 * length)]
    rows += [(300, base[1]), (301, base[1]), (301, base[1]), (302, base[1][1:]), (303, base[1][:-1] + "#")]
    assert ran(spark.createDataFrame(rows, "doc_id long, text string"), length) == brute(rows, length)


def test_many_wholly_equal_rows(spark):
    rng = random.Random(6)
    text = "".join(rng.choice("abcdef ") for _ in range(20_000))
    docs = spark.range(1500).selectExpr("CAST(7 AS long) AS doc_id").crossJoin(spark.createDataFrame([(text,)], "text string"))
    got = repeats.remove_repeats(docs.unionByName(spark.createDataFrame([(8, "z" * 300)], "doc_id long, text string"))).groupBy(
        "doc_id", "n_bytes", "n_removed", "n_spans"
    ).count().collect()
    assert sorted(map(tuple, got)) == [(7, 20_000, 20_000, 1, 1500), (8, 300, 0, 0, 1)]
