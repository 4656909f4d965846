"""Language-model scores: a small causal self-attention model in numpy on
subword ids, beside an exact add-one unigram model over words.

A text is its words between ASCII white space, A-Z in lower case, and one end.
Every word is encoded behind a space by a byte-level tokenizer, so the subword
ids give back the words; the end is an id of its own.  The stream of ids is cut
into blocks of ``BLOCK`` targets; a window holds a block and the ``BLOCK``
inputs before it, so windows overlap by half and each target is scored once,
with at least ``BLOCK`` inputs of context (fewer at the start of a text).
Texts are encoded once: learning and scoring read the ids, words included.

The model predicts a group of classes, and a class of subwords within it (the
most frequent subwords are classes of their own), from masked attention over the
window, and a subword within its class by its corpus frequency plus one: a
distribution over all ids.

What is learned: word and subword counts of all training documents, and the
network on every window of every training document, data-parallel: each task
runs Adam over its share from the same weights, and the results are averaged by
targets, round by round.  Every corpus is passed twice at least.  The first pass over one
of ``TARGETS`` targets or more is in rounds of growing parts that share no document;
each later pass is a round of its own, as are all passes over a smaller one.  Null texts count as empty (the end alone), null ids are learned from;
repeated rows are documents of their own; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.llm.align import byte_symbols
from rankforge.llm.common import settle, steps, strings, word_dictionary

BLOCK = 16
#: Subwords with an input row, and with an output class, of their own.
INPUTS, SINGLES = 960, 223
#: Classes of the other subwords, for those that start a word and those that don't.
BINS = 16
#: The 256 classes in groups: a group is predicted, then a class within it.
GROUPS, MEMBERS = 16, 16
WIDTH, HIDDEN = 16, 32
#: Passes over the training documents: enough to see this many targets, within these bounds.
TARGETS, PASSES = 8_000_000, (2, 16)
#: Ends of the rounds of a large corpus's first pass, in eighths of the documents.
ROUNDS = (1, 3, 8)
#: Windows of one step of Adam, on a small corpus and on a large one.
STEP, LONG_STEP = 96, 512
#: Consecutive windows that share their keys, on a large corpus and in scoring.
RUN = 8
#: Windows that the network takes at once: few enough for a core's cache.
PART = 128
#: Words whose counts are sent to all tasks, at most; the others' are joined.
FREQUENT = 200_000
#: Bytes of text that a task encodes at once.
PIECE = 1 << 20
#: Bytes of ids in which a task looks words up at once.
IDS = 4 << 20
#: Distinct words that a task keeps encoded before it starts anew.
CACHE = 100_000


class Subwords:
    """Subword ids of words behind a space, each encoded once."""

    #: Other characters than visible Latin ones up to U+024F.
    _ODD = r"[^!-~\x{A1}-\x{AC}\x{AE}-\x{24F}]"

    def __init__(self, path: str) -> None:
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        symbols, vocab = byte_symbols(), self.tokenizer.get_vocab()
        special = {i for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special}
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes[i] = bytes(symbols[c] for c in token)
        self.lengths = np.array([len(x) for x in self.bytes], np.int64)
        self.starts = np.array([x.startswith(b" ") for x in self.bytes])
        self.end = len(self.bytes)
        self.opens = np.append(self.starts, True)       # a word or the end
        self.kind = np.dtype(np.uint16 if self.end < 1 << 16 else np.uint32)
        self.ranks = tiktoken.Encoding("subwords", pat_str=PATTERN, special_tokens={},
                                       mergeable_ranks={x: i for i, x in enumerate(self.bytes)
                                                        if i not in special})
        self._clear()

    def _clear(self) -> None:
        self.slots = pa.array([], pa.string())
        self.sizes = np.zeros(0, np.int32)
        self.flat = np.zeros(0, np.int32)

    def _learn(self, words: pa.Array) -> np.ndarray:
        """Slots of new words.  Words of Latin letters, digits and visible symbols go
        through the tokenizer as one text, others one by one."""
        is_odd = pc.match_substring_regex(words, self._ODD)
        plain, odd = words.filter(pc.invert(is_odd)), words.filter(is_odd)
        sizes, parts = [self.sizes], [self.flat]
        if len(plain):
            ids = np.array(self.ranks.encode_ordinary(" " + " ".join(strings(plain))), np.int32)
            ends = np.cumsum(pc.binary_length(plain).to_numpy().astype(np.int64) + 1)
            upto = np.searchsorted(np.cumsum(self.lengths[ids]), ends) + 1
            sizes.append(np.diff(upto, prepend=0).astype(np.int32))
            parts.append(ids)
        if len(odd):
            found = [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(
                [" " + w for w in strings(odd)], add_special_tokens=False)]
            sizes.append(np.array([len(x) for x in found], np.int32))
            parts += found
        first, is_odd = len(self.slots), is_odd.to_numpy(zero_copy_only=False)
        slot = np.empty(len(words), np.int32)
        slot[~is_odd] = np.arange(first, first + len(plain))
        slot[is_odd] = np.arange(first + len(plain), first + len(words))
        self.slots = pa.concat_arrays([self.slots, plain, odd])
        self.sizes, self.flat = np.concatenate(sizes), np.concatenate(parts)
        return slot

    def __call__(self, words: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, size of each word)."""
        if not isinstance(words, pa.Array):
            words = pa.array(words, pa.string())
        if len(self.slots) > CACHE:
            self._clear()
        found = pc.index_in(words, self.slots)
        slot = found.fill_null(-1).to_numpy()
        if found.null_count:
            slot = slot.copy()
            slot[slot < 0] = self._learn(words.filter(found.is_null()))
        sizes = self.sizes.take(slot)
        return gather(self.flat, (np.cumsum(self.sizes) - self.sizes).take(slot), sizes), sizes

    def streams(self, codes: np.ndarray, words: pa.Array, offsets: np.ndarray,
                ends: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of texts given as word codes; texts with ``ends`` (all
        if None) close with the end."""
        ids, sizes = self(words)
        ids, sizes = (np.append(x, np.int32(last)) for x, last in ((ids, self.end), (sizes, 1)))
        close = offsets[1:] if ends is None else offsets[1:][ends]
        codes = np.insert(codes, close, len(words))
        extra = np.ones(len(offsets) - 1, np.int64) if ends is None else ends.astype(np.int64)
        offsets = offsets + np.concatenate(([0], np.cumsum(extra)))
        each = sizes.take(codes)
        bounds = np.concatenate(([0], np.cumsum(each, dtype=np.int64)))[offsets]
        return gather(ids, (np.cumsum(sizes) - sizes).take(codes), each), bounds


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The slices flat[starts[i]:starts[i] + sizes[i]], joined."""
    ends = np.cumsum(sizes, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    at = np.repeat((starts - ends + sizes).astype(np.int32 if total < 1 << 31 else np.int64), sizes)
    at += np.arange(total, dtype=at.dtype)
    return flat.take(at)


_SUBWORDS: dict[str, Subwords] = {}


def subwords(path: str) -> Subwords:
    if path not in _SUBWORDS:
        _SUBWORDS[path] = Subwords(path)
    return _SUBWORDS[path]


def lower_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    codes, words, offsets = word_dictionary(pc.ascii_lower(texts))
    return codes, words.cast(pa.string()), offsets


# --- classes -----------------------------------------------------------------------

@dataclass
class Classes:
    """Input row and output class of every id, and log probabilities within classes."""
    inputs: np.ndarray
    outputs: np.ndarray
    within: np.ndarray
    prior: np.ndarray           # log share of each class
    n_inputs: int               # the last row is the start of a text


def classes(counts: np.ndarray, starts: np.ndarray) -> Classes:
    """``counts`` of all ids, the end last.  Ties go to the smaller id."""
    n = len(counts) - 1
    order = np.argsort(-counts[:n], kind="stable")

    def place(own: int) -> tuple[np.ndarray, int]:
        out = np.zeros(n, np.int64)
        out[order[:own]] = np.arange(min(own, n))
        used = min(own, n)
        for start in (True, False):
            rest = order[own:][starts[order[own:]] == start]
            mass = np.cumsum(counts[rest] + 1.0)
            if len(rest):
                out[rest] = used + np.minimum((mass - counts[rest] - 1) * BINS // mass[-1],
                                              BINS - 1).astype(np.int64)
            used += BINS
        return out, used
    inputs, used = place(INPUTS)
    outputs, end = place(SINGLES)
    inputs, outputs = (np.append(x, last).astype(np.int32)
                       for x, last in ((inputs, used), (outputs, end)))
    mass = np.bincount(outputs, counts + 1.0, end + 1)
    return Classes(inputs, outputs, np.log((counts + 1.0) / mass[outputs]),
                   np.log(np.maximum(mass, 0.5) / mass.sum()), used + 1)


# --- the network --------------------------------------------------------------------

_BACK = np.arange(BLOCK, 2 * BLOCK)[:, None] - np.arange(2 * BLOCK)    # how far back a key lies
_HIDE = np.where(_BACK < 0, np.float32(-1e4), np.float32(0))
_AT = np.clip(_BACK, 0, 2 * BLOCK - 1)
#: Columns of what the inputs' rows give: keys, values, skip rows, queries, the rows themselves.
_K, _V, _S, _Q, _E = (slice(i * WIDTH, j * WIDTH) for i, j in ((0, 1), (1, 2), (2, 4), (4, 5), (5, 6)))
#: Rows of one product with the weights of a group.
TILE = 32


def windows(x: np.ndarray, y: np.ndarray, bounds: np.ndarray, run: int = 1):
    """Windows over streams of inputs and targets, as runs of ``run`` blocks with the
    block before them: (inputs by (run + 1) * BLOCK, which blocks of the run start a
    stream and so see no block before, targets by run * BLOCK (-1 beyond the end),
    stream of each block; the last run is filled up with blocks of no stream)."""
    sizes = np.diff(bounds)
    blocks = -(-sizes // BLOCK)
    stream = np.repeat(np.arange(len(sizes)), blocks)
    nth = np.arange(len(stream)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    place = (nth[:, None] * BLOCK + np.arange(BLOCK)).astype(np.int32)
    beyond = place >= sizes[stream][:, None]
    place += bounds[:-1][stream][:, None].astype(np.int32)
    place[beyond] = 0
    fill = -len(stream) % run
    own = np.pad(x.take(place), ((0, fill), (0, 0)))
    targets = y.take(place)
    targets[beyond] = -1
    targets = np.pad(targets, ((0, fill), (0, 0)), constant_values=-1)
    first = np.pad(nth == 0, (0, fill), constant_values=True).reshape(-1, run)
    before = own.take(np.arange(0, len(own), run) - 1, 0, mode="wrap")
    inputs = np.concatenate((before, own.reshape(-1, run * BLOCK)), 1)
    return inputs, first, targets.reshape(-1, run * BLOCK), stream


def shapes(n_inputs: int) -> dict[str, tuple[int, ...]]:
    return {"emb": (n_inputs, WIDTH), "wq": (WIDTH, WIDTH), "wk": (WIDTH, WIDTH),
            "wv": (WIDTH, WIDTH), "far": (2 * BLOCK,), "wo": (WIDTH, HIDDEN),
            "ws": (WIDTH, HIDDEN), "b": (HIDDEN,), "ug": (HIDDEN, GROUPS), "ug0": (GROUPS,),
            "uw": (GROUPS, HIDDEN, MEMBERS), "uw0": (GROUPS, MEMBERS)}


def unpack(flat: np.ndarray, n_inputs: int) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in shapes(n_inputs).items():
        size = math.prod(shape)
        out[name] = flat[at:at + size].reshape(shape).astype(np.float32, copy=False)
        at += size
    return out


def start_weights(c: Classes, seed: int = 11) -> np.ndarray:
    rng = np.random.default_rng(seed)
    share = np.exp(c.prior).reshape(GROUPS, MEMBERS)
    known = {"ug0": np.log(share.sum(1)), "uw0": np.log(share / share.sum(1, keepdims=True))}
    parts = []
    for name, shape in shapes(c.n_inputs).items():
        if name in known:
            parts.append(known[name])
        elif name in ("far", "b"):
            parts.append(np.zeros(shape))
        elif name in ("ug", "uw"):
            parts.append(rng.normal(0, 0.05, shape).ravel())
        else:
            parts.append(rng.normal(0, 0.5 if name == "emb" else 1 / math.sqrt(shape[0]),
                                    shape).ravel())
    return np.concatenate([p.ravel() for p in parts])


class Network:
    """Masked attention over one window, a hidden layer, logits of classes.

    Windows come as ``windows`` gives them; keys and values of a block serve both
    windows that hold it."""

    def __init__(self, w: dict[str, np.ndarray]) -> None:
        self.w = w
        self.kept: dict[str, np.ndarray] = {}
        self.prepare()

    def prepare(self) -> None:
        """Keys, values, skip rows and queries of every input, once for all windows;
        weights of the groups beside those of each group's members."""
        w = self.w
        self.into = np.concatenate((w["wk"], w["wv"], w["ws"], w["wq"] / np.float32(
            math.sqrt(WIDTH))), 1)
        self.rows = np.concatenate((w["emb"] @ self.into, w["emb"]), 1)
        self.rows[:, _S] += w["b"]
        self.bias = w["far"][_AT] + _HIDE
        self.ones = np.ones(2 * BLOCK, self.rows.dtype)
        longest = [np.einsum("ij,ij->i", x, x).max() for x in (self.rows[:, _Q], self.rows[:, _K])]
        self.low = math.sqrt(longest[0] * longest[1]) + w["far"].max() < 30     # of all scores
        self.u = np.empty((GROUPS, HIDDEN, GROUPS + MEMBERS), self.rows.dtype)
        self.u[:, :, :GROUPS], self.u[:, :, GROUPS:] = w["ug"], w["uw"]
        self.u0 = np.empty((GROUPS, GROUPS + MEMBERS), self.rows.dtype)
        self.u0[:, :GROUPS], self.u0[:, GROUPS:] = w["ug0"], w["uw0"]
        self.halves = np.repeat(np.eye(2, dtype=self.rows.dtype), (GROUPS, MEMBERS), 0)

    def room(self, name: str, *shape: int) -> np.ndarray:
        """An array whose memory is used again: fresh memory costs more than filling it."""
        size = math.prod(shape)
        if name not in self.kept or self.kept[name].size < size:
            self.kept[name] = np.empty(size, self.rows.dtype)
        return self.kept[name][:size].reshape(shape)

    def turned(self, rows: np.ndarray, columns: slice) -> np.ndarray:
        """Some columns of each window's rows, transposed: BLAS multiplies these faster."""
        n, blocks = rows.shape[:2]
        flat = self.room("turned", n, WIDTH, blocks * BLOCK)
        flat[:] = rows.reshape(n, blocks * BLOCK, -1)[:, :, columns].swapaxes(1, 2)
        item = flat.itemsize
        return np.lib.stride_tricks.as_strided(
            flat, (n, blocks - 1, WIDTH, 2 * BLOCK),
            (flat.strides[0], BLOCK * item, flat.strides[1], item), writeable=False)

    def forward(self, x: np.ndarray, first: np.ndarray):
        """Hidden units (targets, HIDDEN) and what the backward pass needs."""
        n, run = first.shape
        rows = self.room("rows", *x.shape, self.rows.shape[1])
        self.rows.take(x, 0, out=rows, mode="clip")
        rows = rows.reshape(n, run + 1, BLOCK, -1)
        steps = rows.strides
        seen = np.lib.stride_tricks.as_strided(                 # each window's rows
            rows, (n, run, 2 * BLOCK, rows.shape[3]), steps, writeable=False)
        q = rows[:, 1:, :, _Q]
        a = self.room("a", n, run, BLOCK, 2 * BLOCK)
        np.matmul(q, self.turned(rows, _K), out=a)
        a += self.bias
        a[first, :, :BLOCK] = -1e4
        if not self.low:
            np.minimum(a, 30, out=a)
        np.exp(a, out=a)
        total = (a.reshape(-1, 2 * BLOCK) @ self.ones)[:, None]
        c = (a @ seen[..., _V]).reshape(-1, WIDTH)
        c /= total
        h = c @ self.w["wo"]
        skip = h.reshape(n, run, BLOCK, HIDDEN)
        skip += rows[:, 1:, :, _S]
        h += np.abs(h)                                          # twice the positive part
        h *= h.dtype.type(0.5)
        return h, (rows, seen, q, a, total, c)

    def logits(self, h: np.ndarray, y: np.ndarray):
        """The targets by their groups, in tiles of one group: (group of each tile, hidden units by tiles, logits of all groups and of the
        members of the tile's group, targets in order, the row of each in the tiles,
        places of its group and its member among the logits)."""
        group = (y >> 4).astype(np.uint8)                       # 255 beyond the end
        many = np.bincount(group, minlength=GROUPS)[:GROUPS]
        order = np.argsort(group, kind="stable")[:many.sum()]
        tiles = -(-many // TILE)
        tile = np.repeat(np.arange(GROUPS), tiles)
        row = np.arange(len(order)) + np.repeat(
            (np.cumsum(tiles) - tiles) * TILE - np.cumsum(many) + many, many)
        index = np.zeros(len(tile) * TILE, np.intp)
        index[row] = order
        rows = h.take(index, 0).reshape(-1, TILE, HIDDEN)
        out = rows @ self.u.take(tile, 0)
        out += self.u0.take(tile, 0)[:, None]
        y, at = y.take(order), row * (GROUPS + MEMBERS)
        return tile, rows, _bounded(out), order, row, at + (y >> 4), at + (GROUPS + (y & 15))

    def log_prob(self, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Natural log probability of each target's class; 0 beyond the end."""
        h, _ = self.forward(x, first)
        _, _, logits, order, row, group, member = self.logits(h, y.ravel())
        own = logits.take(group) + logits.take(member)
        total = np.exp(logits, out=logits).reshape(-1, GROUPS + MEMBERS) @ self.halves
        out = np.zeros(y.size, h.dtype)
        out[order] = own - np.log(total[:, 0] * total[:, 1]).take(row)
        return out.reshape(y.shape)

    def gradients(self, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean negative log probability of the targets, summed over parts of
        the windows that fit a core's cache."""
        real = max(1, int(np.count_nonzero(y >= 0)))
        emb = np.zeros_like(self.w["emb"])
        found: dict[str, np.ndarray] = {}
        size = max(1, PART // first.shape[1])
        for i in range(0, len(x), size):
            part = slice(i, i + size)
            for name, g in self._part(x[part], first[part], y[part], real, emb).items():
                if name in found:
                    found[name] += g
                else:
                    found[name] = g
        far = np.bincount(_AT.ravel(), (found["bias"] * (_BACK >= 0)).ravel(), 2 * BLOCK)
        into, u, u0 = found["into"], found["u"], found["u0"]
        return {"emb": emb, "far": far, "wo": found["wo"], "b": found["b"],
                "wk": into[:, _K], "wv": into[:, _V], "ws": into[:, _S],
                "wq": into[:, _Q] / np.float32(math.sqrt(WIDTH)),
                "ug": u[:, :, :GROUPS].sum(0), "ug0": u0[:, :GROUPS].sum(0),
                "uw": u[:, :, GROUPS:], "uw0": u0[:, GROUPS:]}

    def _part(self, x: np.ndarray, first: np.ndarray, y: np.ndarray, real: int,
              emb: np.ndarray) -> dict[str, np.ndarray]:
        """Sums over some windows, divided by ``real``; those of ``emb`` are added to it."""
        n, run = first.shape
        h, (rows, seen, q, a, total, c) = self.forward(x, first)
        tile, units, p, order, row, group, member = self.logits(h, y.ravel())
        np.exp(p, out=p)
        weight = np.zeros((len(tile) * TILE, 1), h.dtype)       # 0 where a tile is not full
        weight[row] = 1 / real
        weight = weight / (p.reshape(-1, GROUPS + MEMBERS) @ self.halves)
        p *= (weight @ self.halves.T).reshape(p.shape)
        flat = p.reshape(-1)
        flat[group] -= h.dtype.type(1 / real)
        flat[member] -= h.dtype.type(1 / real)
        sums = (np.arange(GROUPS)[:, None] == tile).astype(h.dtype)     # tiles by group
        du = (sums @ (units.swapaxes(1, 2) @ p).reshape(len(tile), HIDDEN * (GROUPS + MEMBERS))).reshape(self.u.shape)
        du0 = sums @ (self.ones[None, :TILE] @ p)[:, 0]
        back = np.zeros((len(weight) + 1, HIDDEN), h.dtype)     # the last for targets beyond the end
        np.matmul(p, self.u.swapaxes(1, 2).copy().take(tile, 0),
                  out=back[:-1].reshape(-1, TILE, HIDDEN))
        back[:-1] *= units.reshape(-1, HIDDEN) > 0
        place = np.full(len(h), len(weight))
        place[order] = row
        dh = back.take(place, 0)
        dc = dh @ self.w["wo"].T
        wo = tall(c, dh)
        dc /= total
        mean = np.einsum("ij,ij->i", dc, c).reshape(n, run, BLOCK, 1)    # of ds under a
        dc = dc.reshape(n, run, BLOCK, WIDTH)
        ds = self.room("ds", *a.shape)
        np.matmul(dc, self.turned(rows, _V), out=ds)
        ds -= mean
        ds *= a
        d = self.room("d", n, run + 1, BLOCK, self.into.shape[1])
        d[:, 0] = 0
        dkv = self.room("dkv", n, run, 2 * BLOCK, 2 * WIDTH)
        np.matmul(ds.swapaxes(2, 3), q, out=dkv[..., _K])
        np.matmul(a.swapaxes(2, 3), dc, out=dkv[..., _V])
        d[:, 1:, :, :2 * WIDTH] = dkv[:, :, BLOCK:]
        d[:, :-1, :, :2 * WIDTH] += dkv[:, :, :BLOCK]
        d[:, 1:, :, _S] = dh.reshape(n, run, BLOCK, HIDDEN)
        np.matmul(ds, seen[..., _K], out=d[:, 1:, :, _Q])
        d = d.reshape(-1, d.shape[3])
        at = np.arange(emb.size).reshape(emb.shape).take(x, 0)
        np.add.at(emb.reshape(-1), at.ravel(), (d @ self.into.T).ravel())
        return {"into": tall(rows.reshape(len(d), -1)[:, _E], d), "bias": ds.sum((0, 1)),
                "wo": wo, "b": np.ones(len(dh), dh.dtype) @ dh, "u": du, "u0": du0}


def tall(a: np.ndarray, b: np.ndarray, rows: int = 128) -> np.ndarray:
    """``a.T @ b``, some rows at a time: BLAS is several times slower on all at once."""
    n = len(a) // rows * rows
    out = a[n:].T @ b[n:]
    if n:
        out += (a[:n].reshape(-1, rows, a.shape[1]).transpose(0, 2, 1)
                @ b[:n].reshape(-1, rows, b.shape[1])).sum(0)
    return out


def _bounded(logits: np.ndarray) -> np.ndarray:
    """``logits``, shifted together (which changes no share) if exp could overflow."""
    high = logits.max(initial=0)
    return logits - (high - 60) if high > 60 else logits


def local_pass(flat: np.ndarray, n_inputs: int, parts: Iterator, rate: float,
               batch: int = STEP) -> tuple[np.ndarray, int]:
    """Adam over the windows of ``parts``, each in random order; (weights, targets seen)."""
    p = flat.astype(np.float32)
    net = Network(unpack(p, n_inputs))           # views of p
    m, s = np.zeros_like(p), np.zeros_like(p)
    rng = np.random.default_rng(5)
    step = seen = 0
    for x, first, y in parts:
        order, size = rng.permutation(len(x)), max(1, batch // first.shape[1])
        for i in range(0, len(x), size):
            part = order[i:i + size]
            own = y[part]
            step += 1
            seen += int(np.count_nonzero(own >= 0))
            found = net.gradients(x[part], first[part], own)
            g = np.concatenate([found[name].ravel() for name in net.w]).astype(np.float32)
            m += np.float32(0.1) * (g - m)
            g *= g
            g -= s
            g *= np.float32(0.01)
            s += g
            np.sqrt(s / np.float32(1 - 0.99 ** step), out=g)
            g += np.float32(1e-6)
            p -= m / g * np.float32(rate / (1 - 0.9 ** step))
            net.prepare()
    return p.astype(np.float64), seen


# --- learning from the corpus ---------------------------------------------------------

def encoded(docs: DataFrame, tokenizer: str, train: Column, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(id, row, learn, part, ids) of every row, written once: whether ``train`` selects
    it, its eighth, and its subword ids with the end as bytes, two for an id (four beyond
    65,536 ids)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = subwords(tokenizer)
        for batch in batches:
            for start, texts in steps(batch.column(4), PIECE):
                ids, bounds = encode.streams(*lower_words(texts))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(start, len(texts)) for i in range(4)]
                    + [_bytes(ids.astype(encode.kind), bounds)], names=names + ["ids"])
    text, names = F.col(text_col).cast("string"), ["id", "row", "learn", "part"]
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"),
        F.coalesce(train, F.lit(False)).alias("learn"),
        F.pmod(F.xxhash64(F.col(id_col).cast("string"), text), F.lit(ROUNDS[-1])).alias("part"),
        text.alias("text"))
    return settle(rows.mapInArrow(run, "id long, row long, learn boolean, part long, ids binary"),
                  "lm-texts")


def _bytes(ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The slices of ``ids`` between ``bounds`` as binary values, without a copy."""
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [
        None, pa.py_buffer((bounds * ids.itemsize).astype(np.int32)), pa.py_buffer(ids)])


def _ids(values: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """(ids, bounds) of binary values, without a copy of the ids."""
    _, offsets, data = values.buffers()
    if not len(values) or data is None:
        return np.zeros(0, kind), np.zeros(len(values) + 1, np.int64)
    at = np.frombuffer(offsets, np.int32, len(values) + 1, values.offset * 4) // kind.itemsize
    ids = np.frombuffer(data, kind, at[-1] - at[0], int(at[0]) * kind.itemsize)
    return ids, (at - at[0]).astype(np.int64)


def _words(encode: Subwords, ids: np.ndarray, bounds: np.ndarray):
    """(codes of all words, distinct words as their ids' bytes, offsets): word codes of
    streams; the end is a word of its own."""
    at = np.flatnonzero(encode.opens.take(ids))
    words = _bytes(ids, np.append(at, len(ids))).dictionary_encode()
    return words.indices.to_numpy(), words.dictionary, np.searchsorted(at, bounds)


def _word_counts(texts: DataFrame, tokenizer: str) -> DataFrame:
    """(word, n) of the training texts, one partial count for each step of a task; words
    as their ids' bytes, the end among them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = subwords(tokenizer)
        for batch in batches:
            for _, values in steps(batch.column(0), 2 * IDS):
                codes, words, _ = _words(encode, *_ids(values, encode.kind))
                yield pa.RecordBatch.from_arrays(
                    [words, pa.array(np.bincount(codes, minlength=len(words)))],
                    names=["word", "n"])
    return texts.filter("learn").select("ids").mapInArrow(run, "word binary, n long")


def _subword_counts(counts: DataFrame, tokenizer: str) -> np.ndarray:
    """Counts of all subword ids, the end last; the driver gets one row for each id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = subwords(tokenizer)
        total = np.zeros(encode.end + 1)
        for batch in batches:
            ids, bounds = _ids(batch.column(0), encode.kind)
            total += np.bincount(ids, np.repeat(batch.column(1).to_numpy(), np.diff(bounds)),
                                 len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["id", "n"])
    found = (counts.select("word", "n").mapInArrow(run, "id long, n double")
             .groupBy("id").agg(F.sum("n").alias("n")).toPandas())
    out = np.zeros(subwords(tokenizer).end + 1)
    out[found["id"].to_numpy(np.int64)] = found["n"].to_numpy()
    return out


def text_windows(c: Classes, ids: np.ndarray, bounds: np.ndarray, run: int = 1):
    """Windows over all targets of whole texts, in runs of texts, so that windows of
    a bounded number are held at once: (first text, text behind the last, and
    what ``windows`` gives, the texts counted from the first)."""
    x = np.empty(len(ids), c.inputs.dtype)
    x[1:] = c.inputs.take(ids[:-1])
    x[bounds[:-1]] = c.n_inputs - 1
    at, n = 0, len(bounds) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + (1 << 18), side="right")) - 1)
        low, high = bounds[at], bounds[to]
        yield at, to, *windows(x[low:high], c.outputs.take(ids[low:high]), bounds[at:to + 1] - low, run)
        at = to


def _training_windows(batches: Iterator[pa.RecordBatch], tokenizer: str, c: Classes, run: int = 1):
    """All windows of all texts, given as such or as their ids' bytes."""
    encode = subwords(tokenizer)
    for batch in batches:
        for _, texts in steps(batch.column(0), PIECE):
            ids, bounds = (_ids(texts, encode.kind) if pa.types.is_binary(texts.type)
                           else encode.streams(*lower_words(texts)))
            for _, _, x, first, y, _ in text_windows(c, ids, bounds, run):
                yield x, first, y


@dataclass
class Model:
    """What scoring needs: classes, weights, word counts, N and V."""
    classes: Classes
    weights: np.ndarray
    counts: DataFrame
    train_tokens: int
    distinct: int
    tokenizer: str


def rounds_of(targets: float, passes: tuple[int, int]) -> tuple[list[tuple[int, int]], int, int]:
    """(first and last eighth of the documents of each round, windows of a step, windows
    that share their keys) for a corpus of so many targets."""
    n = min(passes[1], max(passes[0], math.ceil(TARGETS / max(1, targets))))
    if n > 1 and targets < TARGETS:
        return [(0, ROUNDS[-1])] * n, STEP, 1
    return list(zip((0, *ROUNDS), ROUNDS)) + [(0, ROUNDS[-1])] * (n - 1), LONG_STEP, RUN


def train(docs: DataFrame, tokenizer: str, train: Column, id_col: str = "doc_id",
          text_col: str = "text", passes: tuple[int, int] = PASSES) -> Model:
    """Learn from the documents that ``train`` selects."""
    return learn(encoded(docs, tokenizer, train, id_col, text_col), tokenizer, passes)


def learn(texts: DataFrame, tokenizer: str, passes: tuple[int, int] = PASSES) -> Model:
    """Learn from those of the ``encoded`` texts that are marked so."""
    spark = texts.sparkSession
    counts = settle(_word_counts(texts, tokenizer).groupBy("word")
                    .agg(F.sum("n").alias("n")), "lm-counts")
    sums = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    sub = _subword_counts(counts, tokenizer)
    c = classes(sub, subwords(tokenizer).starts)
    weights, targets = start_weights(c), sub.sum()
    rounds, batch, together = rounds_of(targets, passes)
    for k, (first, end) in enumerate(rounds if targets else ()):
        sent = spark.sparkContext.broadcast((weights, c))
        rate = 0.01 * (1 - k / len(rounds)) + 0.001

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            flat, c = sent.value
            new, seen = local_pass(flat, c.n_inputs, _training_windows(
                batches, tokenizer, c, together), rate, batch)
            if seen:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(new) + 1)), pa.array(np.append(new * seen, seen))],
                    ["at", "v"])
        part = texts.filter(F.col("learn") & (F.col("part") >= first)
                            & (F.col("part") < end)).select("ids")
        v = (part.mapInArrow(run, "at long, v double").groupBy("at")
             .agg(F.sum("v").alias("v")).toPandas().sort_values("at"))["v"].to_numpy()
        if len(v):                               # a part may have no documents
            weights = v[:-1] / v[-1]
        sent.unpersist()
    return Model(c, weights, counts, int(sums[0] or 0), int(sums[1]), tokenizer)


# --- scoring ------------------------------------------------------------------------

def stream_scores(net: Network, c: Classes, ids: np.ndarray, bounds: np.ndarray,
                  batch: int = 2 * PART) -> np.ndarray:
    """log10 probability of each stream of subword ids."""
    if len(bounds) < 2:
        return np.zeros(0)
    inside = np.concatenate(([0], np.cumsum(c.within[ids])))
    out = inside[bounds[1:]] - inside[bounds[:-1]]
    size = max(1, batch // RUN)
    for at, to, xs, first, ys, stream in text_windows(c, ids, bounds, RUN):
        got = np.zeros(first.shape)
        for i in range(0, len(xs), size):
            part = slice(i, i + size)
            found = net.log_prob(xs[part], first[part], ys[part])
            got[part] = found.reshape(-1, RUN, BLOCK).sum(2, dtype=np.float64)
        out[at:to] += np.bincount(stream, got.ravel()[:len(stream)], to - at)
    return out / math.log(10)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          frequent: int = FREQUENT) -> DataFrame:
    """``likelihoods`` of any documents, with their id in ``id_col``."""
    texts = encoded(docs, model.tokenizer, F.lit(False), id_col, text_col)
    return likelihoods(texts, model, frequent).withColumnRenamed("id", id_col)


def likelihoods(texts: DataFrame, model: Model, frequent: int = FREQUENT) -> DataFrame:
    """One row for each of the ``encoded`` texts: (id, n_tokens, n_known, base_score, score).

    Counts of the most frequent words, at most ``frequent``, are sent to all
    tasks, a few MB; each document's other words are joined with the counts
    of all words, so every word is counted exactly.  Which words these are
    follows from a histogram of the counts' logarithms, at most 1,024 rows.
    """
    spark, tokenizer = texts.sparkSession, model.tokenizer
    level = F.floor(F.log2("n") * 16).cast("int")
    words = model.counts.withColumn("level", level)
    held, least = 0, 1 << 20
    for row in sorted(words.groupBy("level").count().collect(), reverse=True):
        held += row["count"]
        if held > frequent:
            break
        least = row["level"]
    top = words.filter(F.col("level") >= least).select("word", "n").toPandas()
    sent = spark.sparkContext.broadcast((pa.array(top["word"], pa.binary()),
                                         top["n"].to_numpy(np.int64),
                                         model.classes, model.weights))
    cache: dict[str, tuple] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not cache:
            common, counts, c, weights = sent.value
            cache["net"] = Network(unpack(weights, c.n_inputs)), c, common, counts
        net, c, common, counts = cache["net"]
        logs = np.append(np.log10(counts + 1.0), 0.0)
        encode = subwords(tokenizer)
        for batch in batches:
            for start, values in steps(batch.column(2), IDS):
                n = len(values)
                ids, bounds = _ids(values, encode.kind)
                codes, words, offsets = _words(encode, ids, bounds)
                found = pc.index_in(words, common).fill_null(-1).to_numpy()
                rare = found < 0
                total = np.concatenate(([0], np.cumsum(logs[found[codes]])))
                known = np.concatenate(([0], np.cumsum(~rare[codes])))
                text = np.repeat(np.arange(n), np.diff(offsets))[rare[codes]]
                pairs, many = np.unique(text * max(1, len(words)) + codes[rare[codes]],
                                        return_counts=True)
                of, code = np.divmod(pairs, max(1, len(words)))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(of, np.arange(n + 1)), pa.int32()),
                    pa.StructArray.from_arrays(
                        [words.take(pa.array(code)), pa.array(many)],
                        ["word", "n"]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, n), batch.column(1).slice(start, n),
                     pa.array(np.diff(offsets)), pa.array(np.diff(known[offsets])),
                     pa.array(np.diff(total[offsets])),
                     pa.array(stream_scores(net, c, ids, bounds)), lists],
                    names=["id", "row", "n_tokens", "known", "logs", "score", "rare"])
    scored = settle(texts.select("id", "row", "ids").mapInArrow(
        run, "id long, row long, n_tokens long, known long, logs double, score double,"
        " rare array<struct<word: binary, n: long>>"), "lm-scored")
    words = scored.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.n")
    counts = model.counts.select("word", F.col("n").alias("c")).hint("shuffle_hash")
    joined = (words.join(counts, "word")
              .groupBy("row").agg(F.sum("n").alias("more"),
                                  F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("more_logs")))
    none = math.log10(model.train_tokens + model.distinct + 1)
    return scored.join(joined, "row", "left").select(
        "id", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        (F.col("logs") + F.coalesce("more_logs", F.lit(0.0))
         - F.col("n_tokens") * none).alias("base_score"), "score")
