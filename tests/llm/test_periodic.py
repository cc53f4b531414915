from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from helpers import documents, empty, messy

from tierwise.llm import periodic, queries


def smallest_period(words):
    return next((q for q in range(1, len(words)) if words[q:] == words[:-q]), len(words))


def brute_runs(words, min_length, exponent):
    found = set()
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(min_length, exponent * q) and smallest_period(words[i : i + length]) == q:
                found.add((i, length, q))
            i = max(j, i) + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def contract_words(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def contract_row(doc_id, words, min_length=6, exponent=4):
    runs = brute_runs(words, min_length, exponent)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    digest = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
    kept = hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, digest, kept)


@pytest.mark.parametrize("min_length,exponent", [(6, 4), (4, 2), (2, 2), (10, 3)])
def test_runs_against_brute_force(min_length, exponent):
    rng = random.Random(min_length + exponent)
    total = 0
    for _ in range(250):
        texts = []
        for _ in range(rng.randint(1, 5)):
            n, kinds = rng.choice([0, 1, 5, 12, 40, 90]), rng.choice([1, 2, 3, 6])
            words = [b"%d" % rng.randrange(kinds) for _ in range(n)]
            if n and rng.random() < 0.6:
                a, p = rng.randrange(n), rng.randint(1, 9)
                words = [words[min(n - 1, a + (i - a) % p)] if i >= a else w for i, w in enumerate(words)]
            texts.append(words)
        want = [brute_runs(w, min_length, exponent) for w in texts]
        assert periodic.text_runs(texts, min_length, exponent) == want
        total += sum(map(len, want))
    assert total > 200


def test_query_against_brute_force(spark):
    got = sorted((tuple(r) for r in queries.op11_periodic_runs(spark, "/root/testdata/sf0.001").collect()), key=repr)
    rows = documents(spark).select("doc_id", "text").collect()
    want = sorted((contract_row(r.doc_id, contract_words(r.doc_id, r.text)) for r in rows if len(r.text or "") < 20_000), key=repr)
    short = {w[0] for w in want}
    assert [g for g in got if g[0] in short] == want and len(got) == len(rows)
    assert sum(g[1] > 0 for g in got) > 10


def test_long_runs_and_texts(spark):
    words = [f"w{i}" for i in range(997)]
    rows = [(1, " ".join(words * 30)), (2, " ".join(["a"] * 40_000)), (3, "   " * 10), (4, "\t\x0b\x0c\r\n"), (5, "x\x1cy " * 6)]
    got = {r.doc_id: r for r in periodic.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1][1:6] == (1, 0, 997 * 30, 997, 30_000)
    assert got[1].collapsed_sha256 == hashlib.sha256(" ".join(words).encode()).hexdigest()
    assert got[2][1:6] == (1, 0, 40_000, 1, 40_000_000)
    # Only ASCII white space parts words.
    assert got[3][1:6] == (1, 0, 10, 1, 10_000) and got[4].n_runs == 0 and got[5][1:6] == (1, 0, 6, 1, 6000)


def test_messy_rows_and_groups_of_documents(spark, monkeypatch):
    docs = messy(spark)
    planted = periodic.with_planted_periods(docs)
    rows = planted.collect()
    want = [contract_row(r.doc_id, re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows if len(r.text or "") < 20_000]
    got = [tuple(r) for r in periodic.periodic_runs(planted).collect()]
    assert len(got) == len(rows) and all(w in got for w in want)
    assert periodic.periodic_runs(empty(spark)).count() == 0
    monkeypatch.setattr(periodic, "TOGETHER", 3)
    assert sorted(map(repr, got)) == sorted(repr(tuple(r)) for r in periodic.periodic_runs(planted).collect())


def test_planted_periods_follow_the_contract(spark):
    rows = spark.range(400).selectExpr("id AS doc_id", "concat_ws('\t ', transform(sequence(0, id % 37), i -> concat('w', i))) AS text")
    got = {r.doc_id: r.text for r in periodic.with_planted_periods(rows).collect()}
    for r in rows.collect():
        assert got[r.doc_id].split() == contract_words(r.doc_id, r.text)
