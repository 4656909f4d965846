"""Toxicity: FTRL-proximal logistic regression (McMahan et al., 2013) over hashed
word n-grams and skip-grams.

Features of a text: its words and word beginnings, pairs of neighbours, and
pairs with one word between, hashed to ``2 ** bits`` places; a feature's value
is 1 + ln(its count).  Places that several training texts have take part.
Each coordinate has its own learning rate, and the L1 term keeps most weights
at zero, so the model is a short list of places and weights that is broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.llm.common import steps, word_codes
from rankforge.llm.labelled import fold_of, labelled_sample, shuffled

BITS = 24
#: Labelled documents that the model is fitted on, at most.
SAMPLE = 6_000
THRESHOLD = 0.3
BEGINNINGS = (4, 5, 6)

_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
_CACHE: dict[str, tuple[int, ...]] = {}
_CACHE_WORDS = 200_000
#: Smaller steps for the driver's memory.
_FIT_BYTES = 1 << 18
_LEAD = 16
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _word(word: str) -> tuple[int, ...]:
    """Hashes of a word without outer ASCII punctuation and of its beginnings (0: none)."""
    core = word.strip(_EDGES).lower()
    if not core:
        return (0,) * (1 + len(BEGINNINGS))
    digest = lambda kind, s: xxhash.xxh64_intdigest(
        s.encode("utf-8", "surrogatepass"), kind) | 1
    return (digest(0, core), *(digest(n, core[:n]) if len(core) > n else 0 for n in BEGINNINGS))


def occurrences(texts: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(text, place) of every feature occurrence in a slice of texts."""
    codes, words, offsets = word_codes(texts)
    if len(_CACHE) > _CACHE_WORDS:
        _CACHE.clear()
    rows = []
    for w in words:
        got = _CACHE.get(w)
        if got is None:
            got = _CACHE[w] = _word(w)
        rows.append(got)
    hashes = np.array(rows, np.uint64).reshape(-1, 1 + len(BEGINNINGS))[codes]
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    solid = hashes[:, 0] != 0
    hashes, text = hashes[solid], text[solid]
    whole = hashes[:, 0]
    found = [(text, whole)]
    for column in range(1, hashes.shape[1]):
        has = hashes[:, column] != 0
        found.append((text[has], hashes[has, column]))
    for gap in (1, 2):
        if len(whole) > gap:
            near = text[:-gap] == text[gap:]
            pair = (whole[:-gap] * _ODD + np.uint64(gap)) ^ (whole[gap:] * np.uint64(3))
            found.append((text[:-gap][near], (pair * _ODD)[near]))
    where = np.concatenate([t for t, _ in found])
    place = np.concatenate([(h >> np.uint64(64 - bits)).astype(np.int64) for _, h in found])
    return where, place


def features(where: np.ndarray, place: np.ndarray, bits: int):
    """Distinct (text, place) in order with their values."""
    both, count = np.unique(where << bits | place, return_counts=True)
    return both >> bits, both & (1 << bits) - 1, 1 + np.log(count)


@dataclass
class Ftrl:
    """Places with a weight, in order, their weights, and the intercept."""
    bits: int
    places: np.ndarray
    weights: np.ndarray
    bias: float

    def totals(self, texts: pa.Array) -> np.ndarray:
        """Weighted sums of a slice of texts, with the intercept."""
        where, place = occurrences(texts, self.bits)
        shift = max(0, self.bits - _LEAD)
        lead = np.zeros(1 << self.bits - shift, bool)      # most places are ruled out here
        lead[self.places >> shift] = True
        some = lead[place >> shift]
        where, place, value = features(where[some], place[some], self.bits)
        at = np.minimum(np.searchsorted(self.places, place), max(0, len(self.places) - 1))
        if not len(self.places):
            return np.full(len(texts), self.bias)
        gain = np.where(self.places[at] == place, self.weights[at], 0.0) * value
        return np.bincount(where, gain, len(texts)) + self.bias


def fit(texts: list[str] | pa.Array, labels: np.ndarray, bits: int = BITS, alpha: float = 0.3,
        beta: float = 1.0, l1: float = 6.0, l2: float = 1.0, epochs: int = 6,
        min_texts: int = 4, seed: int = 7) -> Ftrl:
    """FTRL-proximal over the texts, shuffled anew in every epoch.  Places that
    fewer than ``min_texts`` texts have take no part.  Without texts all
    scores are 0.5."""
    if not isinstance(texts, pa.Array):
        texts = pa.array(texts, pa.string())
    seen = np.zeros(1 << bits, np.uint8)
    for _, part in steps(texts, _FIT_BYTES):
        place, count = np.unique(features(*occurrences(part, bits), bits)[1], return_counts=True)
        seen[place] = np.minimum(seen[place] + count, 255)
    places = np.flatnonzero(seen >= min_texts)
    size, rows = len(places), []
    z, n = np.zeros(size + 1), np.zeros(size + 1)          # the last place is the intercept
    for _, part in steps(texts, _FIT_BYTES):
        where, place = occurrences(part, bits)
        often = seen[place] >= min_texts
        where, place, value = features(where[often], place[often], bits)
        place = np.searchsorted(places, place)
        cut = np.searchsorted(where, np.arange(len(part) + 1))
        rows += [(np.append(place[a:b], size).astype(np.int32),
                  np.append(value[a:b], 1.0).astype(np.float32)) for a, b in zip(cut, cut[1:])]
    _CACHE.clear()                                         # the driver scores nothing

    def weight(i):
        zi = z[i]
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2)
        return np.where(np.abs(zi) > l1, w, 0.0)

    for epoch in range(epochs):
        for k in shuffled(len(rows), seed + epoch):
            i, x = rows[k]
            w = weight(i)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -30, 30)))
            g = (p - labels[k]) * x
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - sigma * w
            n[i] += g * g
    w = weight(np.arange(size + 1))
    used = np.flatnonzero(w[:-1])
    return Ftrl(bits, places[used], w[used], float(w[-1]))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 4, held: int = 2,
          sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Ftrl:
    """Fit on at most ``sample`` labelled rows outside the held-out fold."""
    rows = labelled_sample(docs, labels, label, fold_of(id_col, folds) != held, sample, id_col,
                           text_col)
    texts, known = pa.array(rows["text"], pa.string()), rows["label"].to_numpy(float)
    del rows                                               # one copy of the texts is enough
    return fit(texts, known)


def score_column(spark: SparkSession, model: Ftrl, text: Column) -> Column:
    """Score of a text column in 0..1; null texts count as empty."""
    sent = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def of(texts: pa.Array) -> pa.Array:
        out = [sent.value.totals(part) for _, part in steps(texts)]
        total = np.concatenate(out) if out else np.zeros(0)
        return pa.array(1 / (1 + np.exp(-np.clip(total, -30, 30))))
    return of(text)


def score(docs: DataFrame, model: Ftrl, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with ``score_col`` (replaced if there); rows stay as they are."""
    return docs.withColumn(score_col, score_column(docs.sparkSession, model, F.col(text_col)))
