from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import TEXTS, documents, empty, messy
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tierwise.llm import packing, token_files, tokens

ODD = [
    "a  b", "a \nb", " a b", " a", " ", "\n", "a\n\nb c", "it's 5² ½ can't", "x <|endoftext|> y", "é̀ ñ. a\tb", "a b ", "foo.\nbar.\nbaz qux",
    "don't.\n'tis !!", " a b c", "123 a1 a_b _x", "日本語 テスト。 x", "a.\n b", "🎉 🎉🎉x", "A%%% b$$$ C***\nD", "a\x1cb c\x85 d", "Ⅷ ²x ½½ a",
]


@pytest.fixture(scope="module")
def encoder():
    return tokens.TextEncoder(tokens.default_tokenizer())


def test_chunked_ids_are_the_librarys(spark, encoder):
    texts = ODD + [t for _, t in TEXTS if t] + [r.text for r in documents(spark).select("text").collect() if r.text]
    assert [t for t in texts if encoder.ids(t) != encoder.library(t)] == []
    assert encoder.ids(None) == encoder.ids("") == b""


def test_special_tokens_are_the_librarys(encoder):
    plain = Tokenizer.from_file(tokens.default_tokenizer())
    for text in ("hello <|endoftext|> world", "<|endoftext|>", "a<|endoftext|>b", "x  <|endoftext|>\n y z", "<|endoftext|><|endoftext|>", "<|endoftext"):
        want = plain.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == want
    assert np.frombuffer(encoder.ids("hello <|endoftext|> world"), "<u4").tolist() == [31373, 220, 50256, 995]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab é.,\n\t'²1$日", max_size=30))
def test_chunked_ids_on_random_texts(encoder, text):
    assert encoder.ids(text) == (encoder.library(text) if text else b"")


def test_memo_generations_do_not_change_ids(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_CHUNKS", 3)
    e = tokens.TextEncoder(tokens.default_tokenizer())
    for text in ["a bb ccc dddd eeee. ffff", "bb a eeee, gg hh ii jj", "a bb ccc dddd"] * 3:
        assert e.ids(text) == e.library(text)


def check_packed(rows, texts, encoder, capacity, end):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for doc_id, text in texts:
        raw = encoder.ids(text) + np.array([end], "<u4").tobytes()
        own = sorted((r for r in by_doc[doc_id]), key=lambda r: r.piece)
        if sum(i == doc_id for i, _ in texts) > 1:
            continue
        at = 0
        for k, r in enumerate(own):
            assert (r.piece, r.start) == (k, at) and r.ids_crc32 == zlib.crc32(raw[4 * at : 4 * (at + r.length)])
            assert r.length == capacity or k == 0
            at += r.length
        assert at == len(raw) // 4 and (len(own) == 1 or at > capacity)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence), sum(r.length for r in rows)


@pytest.mark.parametrize("capacity,slack,fan_in", [(2048, None, 8), (64, 0, 2)])
def test_packing_is_gapless_and_tight(spark, encoder, capacity, slack, fan_in):
    docs = documents(spark).repartition(5)
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    rows = packing.pack(docs, capacity=capacity, slack=slack, fan_in=fan_in).collect()
    n, total = check_packed(rows, texts, encoder, capacity, 0)
    assert n <= -(-total // capacity) * 1.02 + 1


def test_packing_messy_rows(spark, encoder):
    rows = packing.pack(messy(spark)).collect()
    assert sum(r.piece == 0 for r in rows) == len(TEXTS)
    check_packed(rows, TEXTS, encoder, 2048, 0)
    assert packing.pack(empty(spark)).collect() == []
    with_ids = packing.pack(messy(spark), with_ids=True).collect()
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in with_ids)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=80))
def test_best_fit_leaves_at_most_one_half_empty_bin(sizes):
    where, offset, fills = packing.best_fit(np.array(sizes, np.int64), 50)
    assert sum(2 * f <= 50 for f in fills) <= 1 and all(f <= 50 for f in fills)
    for b in range(len(fills)):
        own = sorted((offset[i], sizes[i]) for i in range(len(sizes)) if where[i] == b)
        assert [o for o, _ in own] == [sum(s for _, s in own[:k]) for k in range(len(own))]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=700))
def test_blocks_round_trip(ids):
    a = np.array(ids, np.uint32)
    payload = token_files.encode(a)
    assert (token_files.decode(payload) == a).all() and len(token_files.decode(payload)) == len(a)
    for b in range(-(-len(a) // token_files.BLOCK)):
        assert (token_files.decode_block(payload, b) == a[b * 256 : (b + 1) * 256]).all()


def test_outliers_go_to_the_exception_list():
    a = np.arange(256, dtype=np.uint32) % 16
    a[7] = 2**31
    assert len(token_files.encode(a)) < 256  # 4 bits each and one exception, not 32 bits each


def expected(texts, encoder, end):
    out, at = [], 0
    for doc_id, text in sorted(texts, key=lambda x: x[0]):
        raw = encoder.ids(text) + np.array([end], "<u4").tobytes()
        out.append((doc_id, at, len(raw) // 4, zlib.crc32(raw)))
        at += len(raw) // 4
    return out


@pytest.mark.parametrize("segment_ids", [1 << 18, 50])
def test_files_round_trip(spark, encoder, segment_ids):
    docs = documents(spark)
    rows = token_files.round_trip(docs, segment_ids=segment_ids, with_ids=True).collect()
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows) == expected(texts, encoder, 2)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in rows)


def test_files_messy_rows(spark, encoder):
    rows = token_files.round_trip(messy(spark)).collect()
    assert len(rows) == len(TEXTS)
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    assert [r.doc_id for r in sorted(rows, key=lambda r: r.start)][:2] == [None, None]  # nulls first
    assert token_files.round_trip(empty(spark)).collect() == []
