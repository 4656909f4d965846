"""Alignment of the tokens of two tokenizers by lockstep merging.

Both tokenizers' tokens cover the same bytes (a space and the text), so a
document is two rising lists of end offsets.  A NumPy state vector holds one
pointer pair (A, B) for every document of a batch; each step compares the ends
under all pointers at once, emits a link and a cut where they agree, advances
the pointers that are behind (both after a link) and compacts the vector to
the documents that are not finished.  A long document takes part as several
lanes, cut between words that both tokenizers start anew, so the number of
steps of a batch stays bounded.

A word behind a single space is encoded alike wherever it stands, so each
distinct word of a worker is encoded once; texts with other runs of white space
are encoded as they stand.  Null and empty texts, and texts whose tokens do not
give back a space and the text, have no tokens.  Repeated rows are documents of
their own; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.llm.common import STEP_BYTES, settle, steps, strings

#: Words of a lane.
LANE = 256
#: Words whose tokens a worker keeps.
CACHE = 200_000
SPACE = "▁"


def byte_symbols() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: visible
    Latin-1 characters for themselves, the other bytes from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Bytes of all entries, and a dense number for every pair that can be linked.

    Tokens that end together cover each other's ends, so the shorter one's
    bytes end the longer one's: the longer token and the length of the shorter
    one name the pair.  A byte token of B takes the place of length zero.
    """

    def __init__(self, path_a: str, path_b: str) -> None:
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        symbols = byte_symbols()
        vocab = self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = bytes(symbols[c] for c in token)
        self.special_a = {i for i, t in self.a.get_added_tokens_decoder().items() if t.special}
        n = self.b.get_piece_size()
        self.byte_b = np.array([self.b.is_byte(i) for i in range(n)])
        self.bytes_b = [bytes([int(self.b.id_to_piece(i)[3:-1], 16)]) if self.byte_b[i]
                        else b"" if self.b.is_control(i) or self.b.is_unknown(i)
                        else self.b.id_to_piece(i).replace(SPACE, " ").encode() for i in range(n)]
        self.len_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.len_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.from_a = np.concatenate(([0], np.cumsum(self.len_a + 1)))
        self.from_b = self.from_a[-1] + np.concatenate(([0], np.cumsum(self.len_b + 1)))
        #: Numbers of pairs: fixed by the vocabularies, whatever the data.
        self.pairs = int(self.from_b[-1])

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        la, lb = self.len_a[a], self.len_b[b]
        return np.where(la >= lb, self.from_a[a] + np.where(self.byte_b[b], 0, lb),
                        self.from_b[b] + la)

    def b_of(self, pair: np.ndarray) -> np.ndarray:
        """B's id in each pair."""
        pieces = {x: i for i, x in enumerate(self.bytes_b) if x and not self.byte_b[i]}
        bytes_ = {x: i for i, x in enumerate(self.bytes_b) if self.byte_b[i]}
        out = np.searchsorted(self.from_b, pair, side="right") - 1
        for k in np.flatnonzero(pair < self.from_a[-1]):
            i = int(np.searchsorted(self.from_a, pair[k], side="right")) - 1
            n = int(pair[k] - self.from_a[i])
            end = self.bytes_a[i]
            out[k] = pieces[end[len(end) - n:]] if n else bytes_[end[-1:]]
        return out


class Encoder:
    """Token ids of words and texts by both tokenizers, with a bounded cache of words."""

    def __init__(self, path_a: str, path_b: str) -> None:
        import tiktoken
        from public_tokenizers import PATTERN
        self.vocabulary = v = Vocabulary(path_a, path_b)
        # The same merges as ranks: faster on long runs of plain words.
        self.ranks = tiktoken.Encoding("a", pat_str=PATTERN, special_tokens={}, mergeable_ranks={
            x: i for i, x in enumerate(v.bytes_a) if i not in v.special_a})
        self.clear()

    def clear(self) -> None:
        self.slots: dict[str, int] = {}
        #: For each slot: tokens of A and B, and whether they give back the word.
        self.size = np.zeros((0, 2), np.int64)
        self.good = np.zeros(0, bool)
        self.flat = [np.zeros(0, np.int64), np.zeros(0, np.int64)]

    @staticmethod
    def plain(word: str) -> bool:
        """Latin letters, digits, visible symbols and line ends inside: what
        both tokenizers give back byte for byte."""
        return (word.isascii() or max(word) < "ɐ") and (
            word.isprintable() or word.replace("\n", "").isprintable())

    def texts(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], list[bool]]:
        """Ids of whole texts behind a space, and whether they give back their bytes."""
        v = self.vocabulary
        a = [np.array(e.ids, np.int64) for e in v.a.encode_batch_fast(
            [" " + t for t in texts], add_special_tokens=False)]
        b = [np.array(x, np.int64) for x in v.b.encode(texts, num_threads=1)]
        good = []
        for t, x, y in zip(texts, a, b):
            want = (" " + t).encode()
            good.append(b"".join([v.bytes_a[i] for i in x]) == want
                        and b"".join([v.bytes_b[i] for i in y]) == want)
        return a, b, good

    def learn(self, words: list[str]) -> None:
        """New words, none of them empty or ending in white space."""
        v = self.vocabulary
        plain = [w for w in words if self.plain(w)]
        odd = [w for w in words if not self.plain(w)]
        parts, sizes, good = [[], []], [], [np.ones(len(plain), bool)]
        if plain:
            joined = " ".join(plain)
            ends = np.cumsum(np.fromiter((len(w.encode()) + 1 for w in plain), np.int64,
                                         len(plain)))
            counts = []
            for k, (ids, lens) in enumerate((
                    (self.ranks.encode_ordinary(" " + joined), v.len_a),
                    (v.b.encode(joined, num_threads=1), v.len_b))):
                ids = np.array(ids, np.int64)
                at = np.cumsum(lens[ids])
                upto = np.searchsorted(at, ends) + 1
                if (at[upto - 1] != ends).any():
                    raise ValueError("a token spans the space between two words")
                parts[k].append(ids)
                counts.append(np.diff(upto, prepend=0))
            sizes.append(np.stack(counts, 1))
        if odd:
            a, b, ok = self.texts(odd)
            parts[0] += a
            parts[1] += b
            sizes.append(np.array([(len(x), len(y)) for x, y in zip(a, b)], np.int64))
            good.append(np.array(ok))
        for w in plain + odd:
            self.slots[w] = len(self.slots)
        self.size = np.concatenate([self.size, *sizes])
        self.good = np.concatenate([self.good, *good])
        self.flat = [np.concatenate([f, *p]) for f, p in zip(self.flat, parts)]

    def __call__(self, texts: pa.Array):
        """Tokens of texts that have any: (row of each text, its word bounds,
        token bounds of words in A and B, ids of A, ids of B)."""
        lists = pc.split_pattern(texts, " ")
        coded = lists.flatten().dictionary_encode()
        words, codes = strings(coded.dictionary), coded.indices.to_numpy()
        bounds = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(
            zero_copy_only=False), dtype=np.int64)))
        regular = np.fromiter((bool(w) and not w[-1].isspace() for w in words), bool, len(words))
        if len(self.slots) > CACHE:
            self.clear()
        new = [w for w, r in zip(words, regular) if r and w not in self.slots]
        if new:
            self.learn(new)
        slot = np.fromiter((self.slots.get(w, -1) for w in words), np.int64, len(words))[codes]
        odd = np.add.reduceat(slot < 0, bounds[:-1]) > 0
        filled = pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0
        flat, size, good = self.flat, self.size, self.good
        rows = np.flatnonzero(filled)
        whole = np.flatnonzero(odd & filled)
        if len(whole):
            a, b, ok = self.texts([texts[i].as_py() for i in whole])
            flat = [np.concatenate([flat[0], *a]), np.concatenate([flat[1], *b])]
            size = np.concatenate([size, [(len(x), len(y)) for x, y in zip(a, b)]])
            good = np.concatenate([good, ok])
            place = dict(zip(whole.tolist(), range(len(self.size), len(size))))
        parts = [np.array([place[i]]) if odd[i] else slot[bounds[i]:bounds[i + 1]] for i in rows]
        kept = [k for k, p in enumerate(parts) if good[p].all()]
        rows, parts = rows[kept], [parts[k] for k in kept]
        slot = np.concatenate([np.zeros(0, np.int64), *parts])
        word_bounds = np.concatenate(([0], np.cumsum([len(p) for p in parts], dtype=np.int64)))
        starts = np.cumsum(size, axis=0) - size
        ids, token_bounds = [], []
        for k in range(2):
            each = size[slot, k]
            ends = np.cumsum(each)
            token_bounds.append(np.concatenate(([0], ends)))
            ids.append(flat[k][np.arange(ends[-1] if len(ends) else 0)
                               + np.repeat(starts[slot, k] - ends + each, each)])
        return rows, word_bounds, token_bounds[0], token_bounds[1], ids[0], ids[1]


def lockstep(end_a: np.ndarray, end_b: np.ndarray, a: np.ndarray, b: np.ndarray,
             stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (index into A, index into B) of all lanes, in rising order.

    ``end_a`` and ``end_b`` are the end offsets of all tokens; lane i starts at
    ``a[i]`` and ``b[i]`` and is finished when its A pointer reaches ``stop[i]``.
    Both tokens that end a lane end together.
    """
    links_a, links_b = [a[:0]], [b[:0]]
    live = a < stop
    a, b, stop = a[live], b[live], stop[live]
    while len(a):
        x, y = end_a[a], end_b[b]
        same = x == y
        links_a.append(a[same])
        links_b.append(b[same])
        a, b = a + (x <= y), b + (y <= x)
        live = a < stop
        if not live.all():
            a, b, stop = a[live], b[live], stop[live]
    return np.sort(np.concatenate(links_a)), np.sort(np.concatenate(links_b))


def _decimals(top: int) -> tuple[np.ndarray, np.ndarray]:
    """Digits of 0 .. top - 1 as bytes, one column wider than the longest, and their counts."""
    text = [str(i).encode() for i in range(top)]
    width = len(text[-1]) + 1
    return (np.frombuffer(b"".join(t.ljust(width) for t in text), np.uint8).reshape(top, width),
            np.fromiter(map(len, text), np.int64, top))


class Aligner:
    def __init__(self, path_a: str, path_b: str) -> None:
        self.encode = Encoder(path_a, path_b)
        v = self.encode.vocabulary
        self.digits, self.width = _decimals(max(len(v.bytes_a), len(v.bytes_b)))

    def groups(self, a: np.ndarray, b: np.ndarray, link_a: np.ndarray, link_b: np.ndarray,
               first: np.ndarray) -> list[str]:
        """sha256 of each document's groups; ``first``: bounds of documents in links."""
        cut_a, cut_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        cut_a[link_a], cut_b[link_b] = True, True
        group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        before = np.concatenate(([0], link_b + 1))          # B tokens in earlier groups
        place_a = np.arange(len(a)) + before[group_a]
        place_b = np.arange(len(b)) + link_a[group_b] + 1
        ids = np.empty(len(a) + len(b), np.int64)
        sign = np.empty(len(ids), np.uint8)
        ids[place_a], ids[place_b] = a, b
        sign[place_a] = np.where(cut_a, ord("|"), ord(","))
        sign[place_b] = np.where(cut_b, ord(";"), ord(","))
        wide = self.width[ids]
        table = self.digits[ids]
        table[np.arange(len(ids)), wide] = sign
        text = table[np.arange(table.shape[1]) <= wide[:, None]]
        ends = np.concatenate(([0], np.cumsum(wide + 1)))
        token = np.concatenate(([0], link_a + link_b + 2))  # tokens up to each link
        bounds = ends[token[first]]
        return [hashlib.sha256(text[x:y - 1]).hexdigest()
                for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist())]

    def __call__(self, texts: pa.Array):
        """(rows with tokens, n_a, n_b, digests of groups, bounds in links,
        pair number of each link, byte offset of each cut) of a slice of texts."""
        rows, words, in_a, in_b, a, b = self.encode(texts)
        v = self.encode.vocabulary
        end_a, end_b = np.cumsum(v.len_a[a]), np.cumsum(v.len_b[b])
        lanes = np.concatenate([np.arange(x, y, LANE) for x, y in zip(words[:-1], words[1:])]
                               or [words[:0]])
        stop = np.append(lanes[1:], words[-1])
        link_a, link_b = lockstep(end_a, end_b, in_a[lanes], in_b[lanes], in_a[stop])
        first = np.searchsorted(link_a, in_a[words])
        start = np.concatenate(([0], end_a))[in_a[words]]
        cuts = end_a[link_a] - np.repeat(start[:-1], np.diff(first))
        return (rows, np.diff(in_a[words]), np.diff(in_b[words]),
                self.groups(a, b, link_a, link_b, first), first,
                v.pair(a[link_a], b[link_b]), cuts)


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id",
          text_col: str = "text", with_cuts: bool = False) -> DataFrame:
    """One row for each document: (id, n_a, n_b, n_links, groups_sha256, links
    [, cuts]); ``links`` holds pair numbers, ``cuts`` the byte offsets (in a
    space and the text) where a token of both ends."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _ALIGNERS.get((path_a, path_b))
        if aligner is None:
            aligner = _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
        for batch in batches:
            for start, texts in steps(batch.column(1), STEP_BYTES):
                rows, n_a, n_b, digests, first, pairs, cuts = aligner(texts)
                n = len(texts)
                counts = np.zeros((n, 3), np.int64)
                counts[rows] = np.stack([n_a, n_b, np.diff(first)], 1)
                sha = [""] * n
                for i, d in zip(rows.tolist(), digests):
                    sha[i] = d
                offsets = pa.array(np.concatenate(([0], np.cumsum(counts[:, 2]))), pa.int32())
                out = [batch.column(0).slice(start, n), *[pa.array(counts[:, k]) for k in range(3)],
                       pa.array(sha, pa.string()),
                       pa.ListArray.from_arrays(offsets, pa.array(pairs, pa.int32()))]
                names = ["id", "n_a", "n_b", "n_links", "groups_sha256", "links"]
                if with_cuts:
                    out.append(pa.ListArray.from_arrays(offsets, pa.array(cuts, pa.int32())))
                    names.append("cuts")
                yield pa.RecordBatch.from_arrays(out, names=names)
    found = docs.select(F.col(id_col).cast("long").alias("id"),
                        F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "id long, n_a long, n_b long, n_links long, groups_sha256 string, links array<int>"
        + (", cuts array<int>" if with_cuts else ""))
    return found.withColumnRenamed("id", id_col)


def pair_counts(aligned: DataFrame, pairs: int) -> DataFrame:
    """(pair, n): how many links of the corpus hold each pair; summed in every
    task before the shuffle, at most ``pairs`` rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(pairs, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=pairs)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["pair", "n"])
    return (aligned.select("links").mapInArrow(run, "pair long, n long")
            .groupBy("pair").agg(F.sum("n").alias("n")))


def link_scores(spark: SparkSession, aligned: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``aligned`` with n_best (links whose pair's count is the highest of its
    B id, ties included) and count_sum (over links).

    The counts of all pairs are a vector whose length the two vocabularies fix.
    """
    vocabulary = Vocabulary(path_a, path_b)
    found: pd.DataFrame = pair_counts(aligned, vocabulary.pairs).toPandas()
    pair, n = found["pair"].to_numpy(np.int64), found["n"].to_numpy(np.int64)
    counts, best = np.zeros(vocabulary.pairs, np.int64), np.zeros(vocabulary.pairs, bool)
    counts[pair] = n
    if len(pair):
        b = vocabulary.b_of(pair)
        top = np.zeros(len(vocabulary.bytes_b), np.int64)
        np.maximum.at(top, b, n)
        best[pair] = n == top[b]
    sent = spark.sparkContext.broadcast((counts, best))

    @F.arrow_udf("struct<n_best: long, count_sum: long>")
    def score(links: pa.Array) -> pa.Array:
        counts, best = sent.value
        flat = links.flatten().to_numpy()
        ends = np.cumsum(links.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
        out = []
        for x in (best, counts):
            total = np.concatenate(([0], np.cumsum(x[flat], dtype=np.int64)))
            out.append(pa.array(np.diff(total[ends], prepend=0)))
        return pa.StructArray.from_arrays(out, ["n_best", "count_sum"])
    return aligned.withColumn("s", score("links")).select("*", "s.n_best", "s.count_sum").drop("s")


def align_corpus(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Alignment of all documents with their links scored over the corpus."""
    aligned = settle(align(docs, path_a, path_b, id_col, text_col), "aligned")
    return link_scores(docs.sparkSession, aligned, path_a, path_b)
