"""Quality by attention-based multiple-instance learning with gated attention
(Ilse, Tomczak and Welling, 2018).

A document is a bag of passages of 64 words.  Each passage is encoded from the
shapes of its words and their repetition; gated attention weights, learned
from document labels alone, make one representation of the bag, which is
scored.  Passages that give a document away weigh more than the rest.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.llm.common import steps, word_codes
from rankforge.llm.labelled import fold_of, labelled_sample, shuffled

PASSAGE = 64
HASHED = 16
#: Labelled documents that the network is fitted on, at most.
SAMPLE = 8_000
THRESHOLD = 0.5
_SHAPES = 14

# Classes of UTF-8 bytes: letter, capital, digit, symbol, sentence end, start of another character.
_BYTE = np.zeros((256, 6))
for _b in range(256):
    _c = chr(_b)
    _BYTE[_b] = (_b < 128 and _c.isalpha(), "A" <= _c <= "Z", "0" <= _c <= "9",
                 32 < _b < 127 and not _c.isalnum() and _c not in ".,;:'\"()-?", _c in ".?",
                 _b >= 192)


def _word_shapes(words: list[str]) -> np.ndarray:
    """Features of each distinct word, then its place among ``HASHED`` signed ones."""
    raw = [w.encode("utf-8", "surrogatepass") for w in words]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    starts = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(raw), np.uint8)
    out = np.zeros((len(raw), _SHAPES + HASHED))
    if not len(raw):
        return out
    counts = np.stack([np.add.reduceat(_BYTE[data, k], starts) for k in range(_BYTE.shape[1])], 1)
    letters = counts[:, 0] + counts[:, 5]
    chars = counts[:, 0] + counts[:, 2] + counts[:, 5] + 1e-9
    out[:, 0] = np.log1p(sizes)
    out[:, 1] = letters / sizes
    out[:, 2] = counts[:, 1] / chars
    out[:, 3] = counts[:, 2] / sizes
    out[:, 4] = counts[:, 3] / sizes
    out[:, 5] = counts[:, 3] > 0
    out[:, 6] = letters == 0
    out[:, 7] = counts[:, 4] > 0
    out[:, 8] = (counts[:, 1] > 1) & (counts[:, 1] >= counts[:, 0])
    out[:, 9] = sizes <= 3
    out[:, 10] = sizes > 14
    out[:, 11] = counts[:, 5] / sizes
    tail = data[starts + sizes - 1].astype(np.int64) * 31 + data[starts] + 7 * sizes
    sign = np.where(tail * 2654435761 >> 7 & 1, 1.0, -1.0)
    out[np.arange(len(raw)), _SHAPES + (tail * 2654435761 >> 11) % HASHED] = sign
    return out


def passages(texts: pa.Array, size: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """(features of all passages, bag offsets): passages of ``size`` words, the
    last one shorter; a text without words is one passage of zeros."""
    codes, words, offsets = word_codes(texts)
    shapes = _word_shapes(words)
    lengths = np.diff(offsets)
    bags = np.concatenate(([0], np.cumsum(np.maximum(1, -(-lengths // size)))))
    text = np.repeat(np.arange(len(lengths)), lengths)
    passage = bags[text] + (np.arange(len(codes)) - offsets[text]) // size
    n = int(bags[-1])
    out = np.zeros((n, _SHAPES + HASHED + 2))
    many = np.bincount(passage, minlength=n)
    full = np.flatnonzero(many)
    if len(full):
        first = np.searchsorted(passage, full)
        for a in range(0, len(full), 1024):          # bounds the words held at once
            b = min(a + 1024, len(full))
            low, high = first[a], first[b] if b < len(full) else len(codes)
            out[full[a:b], :_SHAPES + HASHED] = np.add.reduceat(
                shapes[codes[low:high]], first[a:b] - low) / many[full[a:b], None]
    pairs = np.unique(passage * max(1, len(words)) + codes) // max(1, len(words))
    out[:, 12] = np.bincount(pairs, minlength=n) / np.maximum(many, 1)
    again = np.flatnonzero((codes[1:] == codes[:-1]) & (passage[1:] == passage[:-1]))
    out[:, 13] = np.bincount(passage[again], minlength=n) / np.maximum(many, 1)
    out[:, -2] = np.log1p(many)
    whole = np.unique(text * max(1, len(words)) + codes) // max(1, len(words))
    share = np.bincount(whole, minlength=len(lengths)) / np.maximum(lengths, 1)
    out[:, -1] = np.repeat(share, np.diff(bags))     # distinct words in the whole text
    return out, bags


@dataclass
class Mil:
    """Encoder (mean, scale, w, b), gated attention (v, u, a) and scorer (c, c0)."""
    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    b: np.ndarray
    v: np.ndarray
    u: np.ndarray
    a: np.ndarray
    c: np.ndarray
    c0: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.w, self.b, self.v, self.u, self.a, self.c, self.c0]

    def forward(self, x: np.ndarray, bags: np.ndarray):
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ self.w + self.b)
        t, s = np.tanh(h @ self.v), 1 / (1 + np.exp(-(h @ self.u)))
        e = (t * s) @ self.a
        sizes = np.diff(bags)
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, bags[:-1]), sizes))
        att = e / np.repeat(np.add.reduceat(e, bags[:-1]), sizes)
        z = np.add.reduceat(att[:, None] * h, bags[:-1])
        p = 1 / (1 + np.exp(-np.clip(z @ self.c + self.c0[0], -30, 30)))
        return p, (x, h, t, s, att, z)

    def gradients(self, x: np.ndarray, bags: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        p, (x, h, t, s, att, z) = self.forward(x, bags)
        sizes = np.diff(bags)
        d = (p - y) / len(y)
        dz = np.repeat(d[:, None] * self.c, sizes, axis=0)
        dh = att[:, None] * dz
        datt = (dz * h).sum(1)
        mean = np.repeat(np.add.reduceat(att * datt, bags[:-1]), sizes)
        de = att * (datt - mean)
        dt, ds = de[:, None] * self.a * s * (1 - t * t), de[:, None] * self.a * t * s * (1 - s)
        dh = (dh + dt @ self.v.T + ds @ self.u.T) * (1 - h * h)
        return [x.T @ dh, dh.sum(0), h.T @ dt, h.T @ ds, (t * s).T @ de, z.T @ d,
                np.array([d.sum()])]


def fit(texts: list[str], labels: np.ndarray, hidden: int = 24, gate: int = 12, epochs: int = 30,
        batch: int = 32, rate: float = 0.01, decay: float = 1e-4, seed: int = 7) -> Mil:
    """Adam over mini-batches of bags.  Without texts all scores are 0.5."""
    rng = np.random.default_rng(seed)
    parts = [passages(p) for _, p in steps(pa.array(texts, pa.string()))]
    dim = _SHAPES + HASHED + 2
    x = np.concatenate([p for p, _ in parts] or [np.zeros((0, dim))])
    bags = np.concatenate(([0], np.cumsum(np.concatenate([np.diff(b) for _, b in parts] or [
        np.zeros(0, np.int64)]))))
    init = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
    model = Mil(x.mean(0) if len(x) else np.zeros(dim), x.std(0) + 1e-3 if len(x) else np.ones(dim),
                init(dim, hidden), np.zeros(hidden), init(hidden, gate), init(hidden, gate),
                init(gate), np.zeros(hidden), np.zeros(1))
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in model.parameters()]
    step = 0
    for epoch in range(epochs if len(x) else 0):
        order = shuffled(len(labels), seed + epoch)
        for a in range(0, len(order), batch):
            pick = order[a:a + batch]
            sizes = bags[pick + 1] - bags[pick]
            own = np.concatenate(([0], np.cumsum(sizes)))
            rows = np.arange(own[-1]) + np.repeat(bags[pick] - own[:-1], sizes)
            step += 1
            for p, (m, s), g in zip(model.parameters(), state,
                                    model.gradients(x[rows], own, labels[pick])):
                g = g + decay * p
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 3,
          held: int = 1, sample: int = SAMPLE, id_col: str = "doc_id",
          text_col: str = "text") -> Mil:
    """Fit on at most ``sample`` labelled rows outside the held-out fold."""
    rows = labelled_sample(docs, labels, label, fold_of(id_col, folds) != held, sample, id_col,
                           text_col)
    return fit(rows["text"].tolist(), rows["label"].to_numpy(float))


def score_column(spark: SparkSession, model: Mil, text: Column) -> Column:
    """Score of a text column in 0..1; null texts count as empty."""
    sent = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def of(texts: pa.Array) -> pa.Array:
        out = np.zeros(len(texts))
        for start, part in steps(texts):
            out[start:start + len(part)] = sent.value.forward(*passages(part))[0]
        return pa.array(out)
    return of(text)


def score(docs: DataFrame, model: Mil, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with ``score_col`` (replaced if there); rows stay as they are."""
    return docs.withColumn(score_col, score_column(docs.sparkSession, model, F.col(text_col)))
