"""Packing: whole ids, gapless sequences, little padding, a sound plan."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from rankforge.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def slow_ids():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, texts, slow_ids, capacity=2048):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for d, own in by_doc.items():
        ids, at = slow_ids(texts[d]), 0
        for r in sorted(own, key=lambda r: r.start):
            part = np.array(ids[at:at + r.length], "<u4").tobytes()
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(part))
            at += r.length
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    total = sum(r.length for r in rows)
    return len(by_sequence), total


def test_query(run_query, texts, slow_ids):
    sequences, total = check(run_query("op6_packing"), texts, slow_ids)
    assert sequences <= 1.02 * total / 2048 + 1


def test_word_tokenizer_equals_the_library(slow_ids):
    odd = ["", " ", "It's we'll I'M", "a\tb\x0bc\xa0d\x85e", "e\u0301te\u0301 \u0301x ﬁ", "ΣΑΣ İstanbul",
           "x<|endoftext|>y <|startoftext|>", "日本語 한국어 ١٢٣", "½ ² ³ 10.5% a_b-c", "don't, (stop)...!?",
           "ÀÉ straße ǅ ȡ ɐ", "a\u00adb\u200bc", "😀👍🏽 ok", "\x1c\x1d\x00"]
    rng = random.Random(3)
    odd += ["".join(rng.choice("aBé'. \n\u0301½<|>Σ日1\xa0") for _ in range(40)) for _ in range(200)]
    encode = packing.WordTokenizer(PATH)
    encode.LIMIT = 50                                  # caches are emptied on the way
    for _ in range(2):
        for k in range(0, len(odd), 20):
            part = odd[k:k + 20]
            ids, offsets = encode(pa.array(part))
            for i, text in enumerate(part):
                assert ids[offsets[i]:offsets[i + 1]].tolist() + [1] == slow_ids(text), repr(text)


def test_edges(make_docs, slow_ids):
    texts = {1: None, 2: "", 3: "word " * 5000, 4: "tie here", 5: "tie here"}
    docs = make_docs(list(texts.items()))
    check(packing.pack(docs, PATH).collect(), texts, slow_ids)
    assert packing.pack(docs.limit(0), PATH).count() == 0
    twice = packing.pack(docs.union(docs), PATH).collect()
    assert sum(r.length for r in twice) == 2 * sum(len(slow_ids(t)) for t in texts.values())
    assert len({(r.sequence_id, r.offset) for r in twice}) == len(twice)
    assert any(r.doc_id is None for r in packing.pack(make_docs([(None, "x")]), PATH).collect())
    with pytest.raises(ValueError):
        packing.pack(docs, PATH, capacity=2047)


def test_knapsack_against_search():
    rng = np.random.default_rng(5)
    for _ in range(20):
        sizes, values = rng.choice(np.arange(2, 12), 4, replace=False), rng.random(4)
        value, counts = packing.knapsack(sizes, values, 17)
        best = max(sum(c * v for c, v in zip((a, b, d, e), values))
                   for a in range(9) for b in range(9) for d in range(9) for e in range(9)
                   if a * sizes[0] + b * sizes[1] + d * sizes[2] + e * sizes[3] <= 17)
        assert abs(value - best) < 1e-9 and counts @ sizes <= 17 and abs(counts @ values - best) < 1e-9


def test_plan_covers_demand_near_the_bound():
    rng = np.random.default_rng(6)
    sizes = np.arange(1, 65)                           # no half-empty sequences are forced
    demand = rng.integers(0, 400, 64) + 1
    patterns, times = packing.cutting_stock(sizes, demand, 128)
    assert (patterns.T @ times == demand).all()
    assert (patterns @ sizes <= 128).all()
    assert times.sum() <= 1.005 * np.ceil((sizes @ demand) / 128) + 1
    patterns, times = packing.cutting_stock(np.array([128]), np.array([7]), 128)
    assert times.sum() == 7
