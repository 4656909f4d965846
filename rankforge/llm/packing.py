"""Sequence packing as a cutting-stock problem, solved by column generation
(Gilmore and Gomory, 1961).

Documents are tokenised and cut at multiples of the sequence length; what is
left over is one piece.  The histogram of piece lengths, in units of a few
tokens, is all that the plan needs: a linear program over patterns (multisets
of lengths that fit a sequence) whose columns are priced by a knapsack dynamic
program.  Patterns are rounded down, the few pieces left over are packed
first-fit, and pieces take their places by their rank within their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankforge.llm.common import settle, steps, strings, word_dictionary

CAPACITY = 2048
#: Tokens in a unit of the plan; a piece counts as the units that hold it.
UNIT = 8
END_ID = 1


class WordTokenizer:
    """Token ids of texts by a tokenizer whose pre-tokens never span white space.

    The distinct words of a step are lower-cased and cut into pre-tokens (runs of
    letters, single digits, runs of symbols) by Arrow's kernels; each distinct
    pre-token is encoded once.  Words with other characters than plain Latin
    ones, with apostrophes (the tokenizer's own endings) or with the start of
    a special token are encoded by the tokenizer as they stand.  The caches are bounded.
    """

    LIMIT = 300_000
    #: Latin letters, digits and visible symbols up to U+024F, but for the apostrophe and U+0130.
    _ODD = r"[^!-&(-~\x{A1}-\x{AC}\x{AE}-\x{12F}\x{131}-\x{24F}]|<\|"
    _CUT = r"(\p{N}|[^\p{L}\p{N}]+)"

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        for token, i in vocab.items():
            self.last[i] = token.endswith("</w>")
        self._clear()

    def _clear(self) -> None:
        self.slots: dict[str, int] = {}
        self.sizes, self.flat = np.zeros(0, np.int64), np.zeros(0, "<u4")

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in
                self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _slots(self, keys: list[str], learn) -> np.ndarray:
        """Places of ``keys`` in the cache; ``learn`` gives (sizes, ids) of new ones."""
        new = [k for k in keys if k not in self.slots]
        if new:
            sizes, ids = learn(new)
            for k in new:
                self.slots[k] = len(self.slots)
            self.sizes = np.concatenate([self.sizes, sizes])
            self.flat = np.concatenate([self.flat, ids])
        return np.fromiter((self.slots[k] for k in keys), np.int64, len(keys))

    def _learn_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, = self._encode([" ".join(parts)])
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(parts):
            raise ValueError("the tokenizer doesn't mark ends of words")
        return np.diff(ends, prepend=0), ids

    def _learn_words(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self._encode([k[1:] for k in keys])
        return np.array([len(x) for x in found], np.int64), np.concatenate(found)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets) of a slice of texts."""
        codes, words, offsets = word_dictionary(texts)
        if len(self.slots) > self.LIMIT:
            self._clear()
        odd = pc.match_substring_regex(words, self._ODD)
        cut = pc.replace_substring_regex(pc.utf8_lower(words.filter(pc.invert(odd))),
                                         self._CUT, r" \1 ")
        lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(cut))
        parts = lists.flatten().dictionary_encode()
        part_slots = self._slots(strings(parts.dictionary), self._learn_parts)[
            parts.indices.to_numpy()]
        # Odd words have keys of their own, so that none is taken for a pre-token.
        odd_slots = self._slots(["\n" + w for w in strings(words.filter(odd))],
                                self._learn_words)
        is_odd = odd.to_numpy(zero_copy_only=False)
        many = np.ones(len(words), np.int64)             # slots of each word
        many[~is_odd] = lists.value_lengths().to_numpy(zero_copy_only=False)
        first = np.cumsum(many) - many
        slots = np.empty(int(many.sum()), np.int64)
        slots[first[is_odd]] = odd_slots
        mask = np.ones(len(slots), bool)
        mask[first[is_odd]] = False
        slots[mask] = part_slots
        starts = np.cumsum(self.sizes) - self.sizes
        word_flat = _gather(self.flat, starts[slots], self.sizes[slots])
        sizes = np.add.reduceat(self.sizes[slots], first) if len(words) else many
        each = sizes[codes]
        ids = _gather(word_flat, (np.cumsum(sizes) - sizes)[codes], each)
        return ids, np.concatenate(([0], np.cumsum(each)))[offsets]


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The slices flat[starts[i]:starts[i] + sizes[i]], joined."""
    ends = np.cumsum(sizes)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)]


_TOKENIZERS: dict[str, WordTokenizer] = {}


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens): every document's ids and the
    end id, cut at multiples of ``capacity``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _TOKENIZERS.get(tokenizer)
        if encode is None:
            encode = _TOKENIZERS[tokenizer] = WordTokenizer(tokenizer)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            ids = batch.column(0)
            for first, texts in steps(batch.column(1)):
                tokens, offsets = encode(texts)
                out: list[list[int]] = [[], [], [], [], []]
                for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                    raw = tokens[a:b].tobytes() + end
                    n = b - a + 1
                    for start in range(0, n, capacity):
                        size = min(capacity, n - start)
                        for column, x in zip(out, (first + i, start, size, zlib.crc32(
                                raw[4 * start:4 * (start + size)]), n)):
                            column.append(x)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(out[0], pa.int64()))] + [pa.array(c, pa.int64())
                                                                for c in out[1:]],
                    names=["id", "start", "length", "ids_crc32", "doc_tokens"])
    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string")
                        .alias("text"))
            .mapInArrow(run, "id long, start long, length long, ids_crc32 long, doc_tokens long"))


def knapsack(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Best value and counts of an unbounded knapsack by dynamic programming."""
    best, took = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    order = np.argsort(sizes, kind="stable")
    sizes_up, values_up = sizes[order], values[order]
    fit = np.searchsorted(sizes_up, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if k := fit[c]:
            gain = best[c - sizes_up[:k]] + values_up[:k]
            j = int(gain.argmax())
            if gain[j] > best[c] + 1e-12:
                best[c], took[c] = gain[j], order[j]
    counts, c = np.zeros(len(sizes), np.int64), capacity
    while c > 0:
        if took[c] < 0:
            c -= 1
        else:
            counts[took[c]] += 1
            c -= sizes[took[c]]
    return float(best[capacity]), counts


def cutting_stock(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 1e-3,
                  rounds: int = 3000) -> tuple[np.ndarray, np.ndarray]:
    """(patterns as rows of counts, how often each) that cover ``demand`` exactly.

    Revised simplex over generated columns; ends when no pattern improves,
    when the dual bound proves the cost within ``gap``, or after ``rounds``
    (the basis is feasible all along).  Use is rounded down; what that leaves
    open is packed by first-fit decreasing.
    """
    m = len(sizes)
    if not m:
        return np.zeros((0, 0), np.int64), np.zeros(0, np.int64)
    columns = np.diag(capacity // sizes).astype(np.int64)
    inverse = np.diag(1.0 / np.diag(columns))
    cost = np.ones(m)
    use = demand / np.diag(columns)
    for _ in range(rounds):
        prices = cost @ inverse
        slack = int(prices.argmin())
        if prices[slack] < -1e-9:                      # more than asked for of one size
            enter, price = -np.eye(m, dtype=np.int64)[slack], 0.0
        else:
            value, enter = knapsack(sizes, prices, capacity)
            if value <= 1 + max(1e-9, gap):
                break
            price = 1.0
        way = inverse @ enter
        rows = np.flatnonzero(way > 1e-9)
        if not len(rows):
            break
        ratio = use[rows] / way[rows]
        out = rows[int(ratio.argmin())]
        step = use[out] / way[out]
        use = np.maximum(use - step * way, 0)
        use[out], cost[out], columns[:, out] = step, price, enter
        pivot = inverse[out] / way[out]
        inverse -= np.outer(way, pivot)
        inverse[out] = pivot
    plan: dict[tuple, int] = {}
    left = demand.astype(np.int64).copy()
    for j in np.argsort(-use, kind="stable"):
        pattern = columns[:, j]
        if cost[j] == 0 or not pattern.any():
            continue
        has = pattern > 0
        times = int(min(use[j] + 1e-9, (left[has] // pattern[has]).min()))
        if times > 0:
            plan[tuple(pattern)] = plan.get(tuple(pattern), 0) + times
            left -= times * pattern
    bins: list[tuple[int, np.ndarray]] = []
    while left.any():                                  # first fit, one sequence at a time
        room, pattern = capacity, np.zeros(m, np.int64)
        for i in np.argsort(-sizes, kind="stable"):
            pattern[i] = min(left[i], room // sizes[i])
            room -= int(pattern[i] * sizes[i])
        has = pattern > 0
        bins.append((int((left[has] // pattern[has]).min()), pattern))
        left -= bins[-1][0] * pattern
    for times, pattern in bins:
        plan[tuple(pattern)] = plan.get(tuple(pattern), 0) + times
    return (np.array(list(plan), np.int64).reshape(-1, m),
            np.array(list(plan.values()), np.int64))


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, unit: int = UNIT) -> DataFrame:
    """One row for each piece: (id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset).

    Null texts count as empty (the end id alone); repeated rows are documents
    of their own; an empty table gives no rows.  ``capacity`` must be a
    multiple of ``unit``.  The driver holds the histogram, at most
    ``capacity / unit`` rows, and the plan.  Ranks are counted within
    (length, salt), so one very common length is spread over many tasks.
    """
    if capacity % unit:
        raise ValueError("capacity must be a multiple of unit")
    spark = docs.sparkSession
    cut = settle(pieces(docs, tokenizer, id_col, text_col, capacity)
                 .withColumn("size", F.ceil(F.col("length") / unit).cast("int")), "pieces")
    salts = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cut = cut.withColumn("salt", F.pmod(F.xxhash64("id", "start", "ids_crc32"), F.lit(salts)))
    counts = cut.groupBy("size", "salt").agg(F.count(F.lit(1)).alias("n"))
    histogram = sorted(cut.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect())
    sizes = np.array([r["size"] for r in histogram], np.int64)
    demand = np.array([r["n"] for r in histogram], np.int64)
    rows, taken, base = [], np.zeros(len(sizes), np.int64), 0
    for pattern, times in zip(*cutting_stock(sizes, demand, capacity // unit)):
        place = 0
        for i in np.argsort(-sizes, kind="stable"):
            for _ in range(pattern[i]):
                rows.append((int(sizes[i]), int(taken[i]), int(taken[i] + times), base, place))
                taken[i] += times
                place += 1
        base += int(times)
    places = spark.createDataFrame(rows, "size int, low long, high long, base long, place int")
    prior = Window.partitionBy("size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("size", "salt", F.coalesce(F.sum("n").over(prior), F.lit(0))
                           .alias("before"))
    inside = Window.partitionBy("size", "salt").orderBy(F.col("length").desc(), "id", "start",
                                                        "ids_crc32")
    ranked = (cut.withColumn("nth", F.row_number().over(inside)).join(before, ["size", "salt"])
              .withColumn("rank", F.col("before") + F.col("nth") - 1))
    placed = ranked.join(places, "size").filter(
        (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    placed = placed.withColumn("sequence_id", F.col("base") + F.col("rank") - F.col("low"))
    filled = Window.partitionBy("sequence_id").orderBy("place") \
        .rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens",
                         "sequence_id", F.coalesce(F.sum("length").over(filled), F.lit(0))
                         .alias("offset"))
