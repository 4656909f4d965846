"""SimHash against brute force, and the covering property."""

import itertools
import random
import re

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from rankforge.llm import simhash
from rankforge.llm.components import components


def slow_fingerprint(text, shingle=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    parts = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    """{key: smallest key reachable} of {key: fingerprint}, radius 2."""
    root = {k: k for k in prints}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    for a, b in itertools.combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 2:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {k: find(k) for k in prints}


@given(st.text(alphabet="ab Ä\t\n\x0b\x1c\xa0Bc", max_size=60))
@settings(max_examples=60, deadline=None)
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_long_text_in_blocks(monkeypatch):
    monkeypatch.setattr(simhash, "_BLOCK", 7)
    text = " ".join(str(random.Random(1).random()) for _ in range(100))
    assert simhash.fingerprint(text) == slow_fingerprint(text)


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_masks_cover_every_pair(radius):
    masks = simhash.covering_masks(radius)
    for bits in itertools.combinations(range(64), radius):
        difference = sum(1 << b for b in bits)
        assert any(not m & difference for m in masks)


def test_query_against_brute_force(run_query, texts):
    prints = {d: slow_fingerprint(t) for d, t in texts.items()}
    roots = slow_components(prints)
    rows = run_query("op5_simhash")
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in rows} == {
        (d, f"{p:016x}", roots[d]) for d, p in prints.items()}
    assert len(rows) == len(texts)


@pytest.mark.parametrize("radius", [0, 1, 2])
def test_links_of_random_walks(spark, radius):
    rng = random.Random(radius)
    prints = set()
    for _ in range(12):                        # chains of neighbours, and lone prints
        x = rng.getrandbits(64)
        for _ in range(15):
            prints.add(x)
            for _ in range(rng.choice([1, 2, 3])):
                x ^= 1 << rng.randrange(64)
    prints = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    found = {r.node: r.root for r in components(simhash.links(df, radius)).collect()}
    root = {p: p for p in prints}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    for a, b in itertools.combinations(prints, 2):
        if ((a ^ b) & (1 << 64) - 1).bit_count() <= radius:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    assert {p: found.get(p, p) for p in prints} == {p: find(p) for p in prints}


def test_radius_is_checked(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([], "fp long"), 3)


def test_edges(make_docs):
    docs = make_docs([(5, None), (3, ""), (7, " \n"), (None, "one two three four"), (9, "solo"),
                      (9, "solo"), (11, "One  two three\tfour")])
    rows = {(r.doc_id, r.fp, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert {(5, 0, 3), (3, 0, 3), (7, 0, 3)} <= rows
    fp = next(r[1] for r in rows if r[0] is None)
    assert (None, fp, 11) in rows and (11, fp, 11) in rows
    assert simhash.near_duplicates(docs).count() == 7
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_keep_one_keeps_columns_and_one_row(make_docs):
    same = "a long enough text that is here more than one time"
    docs = make_docs([(4, same), (2, same), (2, same), (8, "another text altogether, on its own"),
                      (None, "no id")]).withColumnRenamed("lang", "rank")
    out = simhash.keep_one(docs)
    assert out.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(
        [(2, same), (8, "another text altogether, on its own"), (None, "no id")], key=str)


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(7, 7)], "u long, v long")
    assert {(r.node, r.root) for r in components(edges).collect()} == {(i, 0) for i in range(1, 41)}
    with pytest.raises(RuntimeError):
        components(edges, max_rounds=1)
