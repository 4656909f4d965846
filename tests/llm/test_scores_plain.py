"""Scores of the two classifiers against plain versions, word by word and text by text."""
import math
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from rankforge.llm import quality, toxicity

WORDS = re.compile(r"[^\x20\x09-\x0d]+")
ASCII_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
MASK = (1 << 64) - 1
ODD = ["", None, "a", "!!! ... ???", "word " * 700, "É ß İ 日本 \0 x", "SHOUT ALL 12345 %$#", "a-b c'd"]


def plain_toxicity(model, text):
    hashes = []
    for w in WORDS.findall(text or ""):
        core = w.strip(ASCII_EDGES).lower()
        if core:
            hashes.append([xxhash.xxh64_intdigest(core.encode(), 0) | 1] + [
                xxhash.xxh64_intdigest(core[:n].encode(), n) | 1 for n in (4, 5, 6)
                if len(core) > n])
    found = [h for own in hashes for h in own]
    for gap in (1, 2):
        for a, b in zip(hashes, hashes[gap:]):
            pair = ((a[0] * 0x9E3779B97F4A7C15 + gap) & MASK) ^ (b[0] * 3 & MASK)
            found.append(pair * 0x9E3779B97F4A7C15 & MASK)
    weight = dict(zip(model.places.tolist(), model.weights.tolist()))
    count = Counter(h >> (64 - model.bits) for h in found)
    total = model.bias + sum(weight.get(p, 0.0) * (1 + math.log(n)) for p, n in count.items())
    return 1 / (1 + math.exp(-total))


def plain_shape(word):
    raw = word.encode()
    ascii_letters = sum(b < 128 and chr(b).isalpha() for b in raw)
    capitals = sum(65 <= b <= 90 for b in raw)
    digits = sum(48 <= b <= 57 for b in raw)
    symbols = sum(32 < b < 127 and not chr(b).isalnum() and chr(b) not in ".,;:'\"()-?" for b in raw)
    ends = sum(chr(b) in ".?" for b in raw)
    others = sum(b >= 192 for b in raw)
    n, letters = len(raw), ascii_letters + others
    chars = ascii_letters + digits + others + 1e-9
    out = [math.log1p(n), letters / n, capitals / chars, digits / n, symbols / n, symbols > 0,
           letters == 0, ends > 0, capitals > 1 and capitals >= ascii_letters, n <= 3, n > 14,
           others / n, 0, 0] + [0] * 16
    tail = raw[-1] * 31 + raw[0] + 7 * n
    out[14 + (tail * 2654435761 >> 11) % 16] = 1.0 if tail * 2654435761 >> 7 & 1 else -1.0
    return np.array(out, float)


def plain_quality(m, text):
    words = WORDS.findall(text or "")
    share = len(set(words)) / max(1, len(words))
    rows = []
    for i in range(0, max(1, len(words)), 64):
        own = words[i:i + 64]
        x = np.zeros(32)
        if own:
            x[:30] = sum(plain_shape(w) for w in own) / len(own)
            x[12] = len(set(own)) / len(own)
            x[13] = sum(a == b for a, b in zip(own, own[1:])) / len(own)
        x[30], x[31] = math.log1p(len(own)), share
        rows.append((x - m.mean) / m.scale)
    h = [np.tanh(x @ m.w + m.b) for x in rows]
    e = [float(np.tanh(v @ m.v) / (1 + np.exp(-(v @ m.u))) @ m.a) for v in h]
    att = np.exp(np.array(e) - max(e))
    z = sum(a * v for a, v in zip(att / att.sum(), h))
    return 1 / (1 + math.exp(-float(z @ m.c + m.c0[0])))


@pytest.mark.parametrize("module,plain", [(toxicity, plain_toxicity), (quality, plain_quality)])
def test_scores_equal_plain_scores(spark, sf_small, documents, make_docs, module, plain):
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    model = module.train(documents, labels)
    rows = documents.select("doc_id", "text").orderBy(F.length("text")).limit(120).collect()
    docs = make_docs([(r.doc_id, r.text) for r in rows] + [(10_000 + i, t) for i, t in enumerate(ODD)])
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in module.score(docs, model).select("doc_id", "score").collect():
        assert r.score == pytest.approx(plain(model, text[r.doc_id]), abs=1e-9), r.doc_id
