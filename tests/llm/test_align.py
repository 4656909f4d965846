import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from rankforge.llm import align
from rankforge.llm.queries import BYTE_LEVEL, PIECES

A, B = public_tokenizers.path(BYTE_LEVEL), public_tokenizers.path(PIECES)
ODD = ["", " ", "  two  spaces ", "tab\there", "a \n b", "line\nend\n", "\n", "a▁b", "nul\0l",
       "<s></s><unk> <|endoftext|>", "é ﬁ ½ İ ẞ", "日本 語。", "🙂🙂 x", "a b", "x\u0085 y",
       "don't 'S 12345 67", "a\r\nb", "é", " lead", "trail ", " z", "w" * 3000]


@pytest.fixture(scope="module")
def vocabulary():
    return align.Vocabulary(A, B)


def brute(texts, v):
    """id to (n_a, n_b, groups text, links as id pairs), each document token by token."""
    out = {}
    for doc, text in texts:
        a = b = []
        if text:
            want = (" " + text).encode()
            a = v.a.encode(" " + text, add_special_tokens=False).ids
            b = v.b.encode(text)
            if b"".join(v.bytes_a[i] for i in a) != want or \
                    b"".join(v.bytes_b[i] for i in b) != want:
                a = b = []
        ends_a = np.cumsum([len(v.bytes_a[i]) for i in a]).tolist()
        ends_b = np.cumsum([len(v.bytes_b[i]) for i in b]).tolist()
        at_b = {e: k for k, e in enumerate(ends_b)}
        links, groups, x, y = [], [], 0, 0
        for k, e in enumerate(ends_a):
            if e in at_b:
                j = at_b[e]
                links.append((a[k], b[j]))
                groups.append(",".join(map(str, a[x:k + 1])) + "|" + ",".join(map(str, b[y:j + 1])))
                x, y = k + 1, j + 1
        out.setdefault(doc, []).append((len(a), len(b), ";".join(groups), links))
    return out


def expected(texts, v):
    docs = brute(texts, v)
    count = Counter(p for rows in docs.values() for r in rows for p in r[3])
    top = Counter()
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    rows = []
    for doc, found in docs.items():
        for n_a, n_b, groups, links in found:
            sha = hashlib.sha256(groups.encode()).hexdigest() if n_a else ""
            rows.append((doc, n_a, n_b, len(links), len(links),
                         sum(count[p] == top[p[1]] for p in links),
                         sum(count[p] for p in links), sha))
    return sorted(rows, key=str)


def run(df):
    out = align.align_corpus(df, A, B)
    return sorted([tuple(r) for r in out.select(
        "doc_id", "n_a", "n_b", "n_links", "n_links", "n_best", "count_sum",
        "groups_sha256").collect()], key=str)


def test_query_equals_brute_force(run_query, documents, vocabulary):
    got = run_query("op11_tokenizer_alignment")
    want = expected([(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()],
                    vocabulary)
    assert sorted([(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum,
                    r.groups_sha256) for r in got], key=str) == want


def test_odd_texts(spark, vocabulary):
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choice(["a", "The", " ", " ", "\n", "é", "▁", "9", "'s", "🙂", "x\t"])
                           for _ in range(rng.randrange(40))) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "null id"), (3, None), (3, None),
                                                    (4, "a \n b")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows],
                               "doc_id long, text string, links string, id int")
    assert run(df) == expected(rows, vocabulary)


def test_long_text_takes_several_lanes(spark, vocabulary):
    rng = random.Random(1)
    words = ["anly", "Thentien", "onorresh,", "x", "hello\nworld", "1234", "é"]
    text = " ".join(rng.choice(words) for _ in range(100_000))
    rows = [(1, text), (2, "short"), (3, "z" * 200_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert run(df) == expected(rows, vocabulary)


def test_cuts_are_offsets_where_both_end(spark):
    df = spark.createDataFrame([(1, "Thentien anonly é\nx")], "doc_id long, text string")
    row = align.align(df, A, B, with_cuts=True).first()
    assert row.cuts == sorted(set(row.cuts)) and row.cuts[-1] == len(" Thentien anonly é\nx".encode())
    assert len(row.cuts) == len(row.links) == row.n_links


def test_pair_numbers_name_pairs(vocabulary):
    v, rng = vocabulary, np.random.default_rng(2)
    pieces = {x: i for i, x in enumerate(v.bytes_b) if x}
    a, b = [], []
    for i in rng.integers(0, 50_000, 3000).tolist():
        for n in range(1, len(v.bytes_a[i]) + 1):
            if v.bytes_a[i][-n:] in pieces:
                a.append(i)
                b.append(pieces[v.bytes_a[i][-n:]])
    a, b = np.array(a), np.array(b)
    numbers = v.pair(a, b)
    assert len(set(numbers.tolist())) == len(set(zip(a.tolist(), b.tolist())))
    assert (v.b_of(numbers) == b).all() and numbers.max() < v.pairs


def test_lockstep_against_sets():
    rng = random.Random(9)
    for _ in range(200):
        lanes, ends_a, ends_b, a, b, stop, at = [], [], [], [], [], [], 0
        for _ in range(rng.randrange(6)):
            n = rng.randrange(1, 12)
            x = sorted(set(rng.sample(range(1, n + 1), rng.randrange(1, n + 1))) | {n})
            y = sorted(set(rng.sample(range(1, n + 1), rng.randrange(1, n + 1))) | {n})
            a.append(len(ends_a))
            b.append(len(ends_b))
            lanes += [at + e for e in set(x) & set(y)]
            ends_a += [at + e for e in x]
            ends_b += [at + e for e in y]
            stop.append(len(ends_a))
            at += n
        to = [np.array(x, np.int64) for x in (ends_a, ends_b, a, b, stop)]
        la, lb = align.lockstep(*to)
        assert [ends_a[i] for i in la] == [ends_b[i] for i in lb] == sorted(lanes)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert run(df) == [] and df.filter(F.lit(True)).count() == 0
