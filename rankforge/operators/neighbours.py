"""Item-item cosine neighbours from inverted lists.

The users of an item pair fall in two classes.  A short history gives one
product for each pair of its items, at most ``long_history / 2`` for each of its
entries, whatever the size of the input; the products of a pair are summed.  Few
products are rows that are joined and grouped.  Many are never rows: items are
dealt to blocks, a task gets the entries of two blocks, multiplies them a part at
a time, and sends on only pairs that may end among the best of one of their items.
Long histories (there are at most entries / ``long_history`` of them) give no pairs:

* a pair that shares a short history gets what long histories add to it by two
  joins on the item, and only where the sum over short histories and the
  product of the two items' partial norms over long histories reach the threshold;
* a pair that shares long histories alone is found among items whose partial
  norms, in bands of falling norm, have a product that reaches the threshold.

Both bounds are Cauchy and Schwarz's, so the result is exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.functions.columns import dbl
from rankforge.operators.packed import pack, runs, unpack
from rankforge.operators.ranking import top_k_per_group
from rankforge.session import written

# Neighbour model settings.
KNN_MIN_INTERACTIONS = 5
KNN_TOP = 20
KNN_MIN_SIMILARITY = 0.1
SIM_DIGITS = 9
#: A history of more items is a long one.
LONG_HISTORY = 1024
#: Items of a block, and the ratio of norms between two bands.
BLOCK_ITEMS = 2048
BAND = 1.1
BANDS = 200
#: Rows of pairs that one task adds up, at most about; twice as many are multiplied in blocks.
PAIR_ROWS = 2_000_000
#: Entries of short histories in a block of items, at most about, and at least before more
#: blocks are made to keep all cores busy; products that a task holds at once, at most about.
ENTRIES, FEW_ENTRIES, PRODUCTS = 4 << 20, 1 << 16, 1 << 21
#: Rows that a task packs at once.
PIECE = 1 << 19


def knn_entries(train: DataFrame, min_interactions: int) -> DataFrame:
    """(user_id, item_id, r, norm, square) of items with enough interactions; ``square``
    is the norm's, and whole where ratings are."""
    items = train.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"),
                                         F.sum(F.pow("rating", 2)).alias("square"))
    return train.join(items.filter(F.col("n") >= min_interactions), "item_id").select(
        "user_id", "item_id", F.col("rating").cast("double").alias("r"),
        F.sqrt("square").alias("norm"), "square")


def split_histories(x: DataFrame, long_history: int) -> tuple[DataFrame, DataFrame]:
    """Entries of users with at most ``long_history`` items, and the others."""
    many = written(x.groupBy("user_id").agg(F.count(F.lit(1)).alias("h")).filter(
        F.col("h") > long_history).select("user_id"), "knn-users")
    return x.join(many, "user_id", "left_anti"), x.join(many, "user_id", "left_semi")


def pair_rows(short: DataFrame) -> int:
    """Pairs of items in all histories together."""
    h = F.col("h")
    return (short.groupBy("user_id").agg(F.count(F.lit(1)).alias("h")).agg(
        F.sum(h * (h - 1))).first()[0] or 0) // 2


def short_pairs(short: DataFrame) -> DataFrame:
    """(i, j, dot, norms), i < j: sums over short histories.

    Most pairs share one user, so combining before the shuffle only fills memory
    with a row for each pair: many pairs are dealt to tasks first, in a number
    that grows with them, and each task adds up its own."""
    a = short.select("user_id", F.col("item_id").alias("i"), F.col("r").alias("ri"),
                     F.col("norm").alias("ni"))
    b = short.select("user_id", F.col("item_id").alias("j"), F.col("r").alias("rj"),
                     F.col("norm").alias("nj"))
    pairs = a.join(b, "user_id").filter(F.col("i") < F.col("j"))
    tasks = math.ceil(pair_rows(short) / PAIR_ROWS)
    if tasks > int(short.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        pairs = pairs.repartition(tasks, "i", "j")
    return (pairs.groupBy("i", "j")
            .agg(F.sum(F.col("ri") * F.col("rj")).alias("dot"),
                 F.max(F.col("ni") * F.col("nj")).alias("norms")))


def _pieces(rows: DataFrame, kind: int) -> DataFrame:
    """(b, kind, x, y, z): rows (block, long, number, number) as packed pieces of a block,
    ``x`` as differences."""
    def piece(held):
        b, x, y, z = (np.concatenate([h[i] for h in held]) for i in range(4))
        order = np.lexsort((x, b))
        b, x, y, z = b[order], x[order], y[order], z[order]
        found = runs(b)
        return pa.RecordBatch.from_arrays(
            [pa.array([b[s][0] for s in found], pa.int32()), pa.array([kind] * len(found), pa.int32()),
             *(pa.array([pack(cut(v[s])) for s in found], pa.binary())
               for v, cut in ((x, lambda v: np.diff(v, prepend=0)), (y, np.asarray), (z, np.asarray)))],
            names=["b", "kind", "x", "y", "z"])

    def run(batches):
        held, count = [], 0
        for batch in batches:
            held.append([batch.column(i).to_numpy() for i in range(4)])
            count += len(batch)
            if count >= PIECE:
                yield piece(held)
                held, count = [], 0
        if count:
            yield piece(held)
    return rows.mapInArrow(run, "b int, kind int, x binary, y binary, z binary")


def _kth(group: np.ndarray, value: np.ndarray, n: int, top: int) -> np.ndarray:
    """The ``top``-th highest value of each row's group (-inf: it has fewer rows); groups
    are numbers below ``n``."""
    order = np.lexsort((-value, group))
    g = group[order]
    last = np.flatnonzero(np.arange(len(g)) - np.searchsorted(g, g) == top - 1)
    out = np.full(n, -np.inf)
    out[g[last]] = value[order[last]]
    return out[group]


def _sums(x: np.ndarray, r: np.ndarray, first: np.ndarray, many: np.ndarray,
          ry: np.ndarray, rr: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(left, right, dot) of all pairs of items, in parts that hold all products of their
    left items.  Left entries (``x``, ``r``) stand by item; entry k meets the ``many[k]``
    entries (``ry``, ``rr``) from ``first[k]`` on; right items are numbers below ``width``."""
    def products(at: slice):
        n = many[at]
        own = np.repeat(np.arange(at.start, at.stop), n)
        other = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n) + first[own]
        return x[own], ry[other], r[own] * rr[other]
    upto = np.concatenate(([0], np.cumsum(many)))
    starts = np.append(np.flatnonzero(np.diff(x, prepend=-1)), len(x))
    k = 0
    while k < len(starts) - 1:
        low = upto[starts[k]]
        to = max(k + 1, int(np.searchsorted(upto[starts], low + PRODUCTS, side="right")) - 1)
        if upto[starts[to]] - low <= PRODUCTS:
            i, j, v = products(slice(starts[k], starts[to]))
            key = i * width + j
            order = np.argsort(key, kind="stable")
            key = key[order]
            ends = np.flatnonzero(np.diff(key, prepend=-1))
            if len(key):
                yield (*np.divmod(key[ends], width), np.add.reduceat(v[order], ends))
        else:                                           # one item of very many products
            dot, met, at = np.zeros(width), np.zeros(width, bool), starts[k]
            while at < starts[to]:
                end = max(at + 1, int(np.searchsorted(upto, upto[at] + PRODUCTS, side="right")) - 1)
                _, j, v = products(slice(at, min(end, starts[to])))
                dot += np.bincount(j, v, width)
                met[j] = True
                at = end
            j = np.flatnonzero(met)
            yield np.full(len(j), x[starts[k]]), j, dot[j]
        k = to


def _best_of_blocks(top: int, floor: float):
    """Pieces of two blocks of items to pairs (i, j, dot, norms, more), both ways: those
    that reach ``floor`` and may be among the ``top`` of i, both with what long
    histories may add."""
    def joined(pieces: list[tuple], b: int) -> tuple[np.ndarray, ...]:
        found = [p[1:] for p in pieces if p[0] == b]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        x, y, z = zip(*found)
        return (np.concatenate([np.cumsum(unpack(v).astype(np.int64)) for v in x]),
                np.concatenate([unpack(v) for v in y]),
                np.concatenate([unpack(v) for v in z]).astype(np.float64))

    def multiply(items: list[tuple], entries: list[tuple], a: int, b: int):
        (li, ln, lp), (ri, rn, rp) = (sides(items, k) for k in (a, b))
        lu, lx, lr = joined(entries, a)
        ru, ry, rr = joined(entries, b)
        order = np.argsort(ru, kind="stable")
        ru, ry, rr = ru[order], np.searchsorted(ri, ry[order]), rr[order]
        order = np.argsort(lx, kind="stable")
        lu, lx, lr = lu[order], np.searchsorted(li, lx[order]), lr[order]
        first = np.searchsorted(ru, lu)
        many = np.searchsorted(ru, lu, side="right") - first
        for x, y, dot in _sums(lx, lr, first, many, ry, rr, max(1, len(ri))):
            norms, more = ln[x] * rn[y], lp[x] * rp[y]
            with np.errstate(divide="ignore", invalid="ignore"):
                low = dot / norms
            keep = low + more >= floor
            if a == b:
                keep &= x < y
            x, y, dot, norms, more, low = (v[keep] for v in (x, y, dot, norms, more, low))
            for i, j, own, other, n in ((x, y, li, ri, len(li)), (y, x, ri, li, len(ri))):
                # Values that are equal to nine digits differ by less than 1e-9.
                s = low + more >= _kth(i, low, n, top) - 2e-9
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v) for v in (own[i[s]], other[j[s]], dot[s], norms[s], more[s])],
                    names=["i", "j", "dot", "norms", "more"])

    def sides(items: list[tuple], b: int) -> tuple[np.ndarray, ...]:
        """(ids, norms, norms over long histories as a share of these) by rising id."""
        ids, square, part = joined(items, b)
        order = np.argsort(ids)
        norm = np.sqrt(square[order].astype(np.float64))
        share = np.zeros(len(ids))
        np.divide(np.sqrt(part[order]), norm, out=share, where=part[order] > 0)
        return ids[order], norm, share

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, ([], [])
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if now != row[0]:
                    if now is not None:
                        yield from multiply(*held, *_block_pair(now))
                    now, held = row[0], ([], [])
                held[row[2]].append((row[1], *row[3:]))
        if now is not None:
            yield from multiply(*held, *_block_pair(now))
    return run


def _block_pair(task: int) -> tuple[int, int]:
    """Blocks a <= b of the task b * (b + 1) / 2 + a."""
    b = (math.isqrt(8 * task + 1) - 1) // 2
    return task - b * (b + 1) // 2, b


def block_pairs(x: DataFrame, short: DataFrame, entries: DataFrame, top: int, floor: float,
                blocks: int | None = None) -> DataFrame:
    """(i, j, dot, norms, more), both ways: sums over ``short`` histories of all pairs of
    items that may be among the ``top`` of i, and the most that ``entries``, the long ones, add.

    Items are dealt to blocks; a task multiplies the entries of two blocks.  Rows moved:
    packed entries times blocks, whatever the number of pairs; a task holds the
    entries of two blocks and ``PRODUCTS`` products.
    """
    spark = x.sparkSession
    if blocks is None:
        n, cores = short.count(), spark.sparkContext.defaultParallelism
        busy = math.ceil(math.sqrt(4 * cores))          # two tasks a core, about
        blocks = max(1, math.ceil(n / ENTRIES), min(busy, math.ceil(n / FEW_ENTRIES)))
    block = F.pmod(F.xxhash64(F.col("item_id").cast("long")), F.lit(blocks)).cast("int").alias("b")
    item = F.col("item_id").cast("long")
    part = entries.groupBy("item_id").agg(F.sum(F.pow("r", 2)).alias("part"))
    items = x.groupBy("item_id").agg(F.max("square").alias("square")).join(part, "item_id", "left")
    rows = _pieces(items.select(block, item.alias("x"), F.coalesce("square", dbl(0)).alias("y"),
                                F.coalesce("part", dbl(0)).alias("z")), 0).unionByName(
        _pieces(short.filter(F.col("user_id").isNotNull() & F.col("r").isNotNull()).select(
            block, F.col("user_id").cast("long").alias("x"), item.alias("y"), "r"), 1))
    met = rows.withColumn("c", F.explode(F.lit(list(range(blocks)))))
    low, high = F.least("b", "c"), F.greatest("b", "c")
    task = F.expr("high * (high + 1) div 2 + low")
    return (met.withColumns({"low": low, "high": high})
            .select(task.cast("int").alias("task"), "b", "kind", "x", "y", "z")
            .repartitionById(blocks * (blocks + 1) // 2, "task").sortWithinPartitions("task")
            .mapInArrow(_best_of_blocks(top, floor),
                        "i long, j long, dot double, norms double, more double"))


def long_sums(pairs: DataFrame, entries: DataFrame, floor: float) -> DataFrame:
    """``pairs`` with what long histories add; pairs that cannot reach ``floor`` go."""
    part = entries.groupBy("item_id").agg(
        (F.sqrt(F.sum(F.pow("r", 2))) / F.max("norm")).alias("p"))
    return added((pairs.join(part.select(F.col("item_id").alias("i"), F.col("p").alias("pi")), "i",
                             "left")
                  .join(part.select(F.col("item_id").alias("j"), F.col("p").alias("pj")), "j", "left")
                  .withColumn("more", F.coalesce(F.col("pi") * F.col("pj"), dbl(0)))
                  .filter(F.col("dot") / F.col("norms") + F.col("more") >= floor)
                  .select("i", "j", "dot", "norms", "more")), entries)


def added(bounded: DataFrame, entries: DataFrame) -> DataFrame:
    """(i, j, dot, norms): pairs with what long histories add, where ``more`` says they may."""
    both = (bounded.filter(F.col("more") > 0).select("i", "j")
            .join(entries.select(F.col("item_id").alias("i"), "user_id", F.col("r").alias("ri")), "i")
            .join(entries.select(F.col("item_id").alias("j"), "user_id", F.col("r").alias("rj")),
                  ["j", "user_id"])
            .groupBy("i", "j").agg(F.sum(F.col("ri") * F.col("rj")).alias("add")))
    return bounded.join(both, ["i", "j"], "left").select(
        "i", "j", (F.col("dot") + F.coalesce("add", dbl(0))).alias("dot"), "norms")


def _products(top: int, floor: float):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        """Pairs of one block pair that reach ``floor``: for each item of the
        left side its ``top`` best, and those equal to the last of them."""
        left, right = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
        none = pd.DataFrame({"i": [], "j": [], "dot": [], "norms": []}).astype(
            {"i": "int64", "j": "int64"})
        if left.empty or right.empty:
            return none
        li, lx = np.unique(left["item_id"].to_numpy(), return_inverse=True)
        ri, ry = np.unique(right["item_id"].to_numpy(), return_inverse=True)
        users, u = np.unique(np.concatenate([left["user_id"], right["user_id"]]),
                             return_inverse=True)
        lu, ru = u[:len(left)], u[len(left):]
        ln, rn = np.zeros(len(li)), np.zeros(len(ri))
        ln[lx], rn[ry] = left["norm"], right["norm"]
        dot = np.zeros((len(li), len(ri)))
        # One outer product for each user that both blocks hold.
        lo, ro = np.argsort(lu, kind="stable"), np.argsort(ru, kind="stable")
        la = np.searchsorted(lu[lo], np.arange(len(users) + 1))
        ra = np.searchsorted(ru[ro], np.arange(len(users) + 1))
        lr, rr = left["r"].to_numpy(), right["r"].to_numpy()
        for k in np.flatnonzero((np.diff(la) > 0) & (np.diff(ra) > 0)):
            x, y = lo[la[k]:la[k + 1]], ro[ra[k]:ra[k + 1]]
            dot[np.ix_(lx[x], ry[y])] += np.outer(lr[x], rr[y])
        norms = np.outer(ln, rn)
        sim = np.where((dot > 0) & (li[:, None] != ri[None, :]), dot / norms, -np.inf)
        keep = sim >= floor
        if top < len(ri):
            kth = np.partition(sim, -top, axis=1)[:, [-top]]
            keep &= sim >= kth - 1e-9
        x, y = np.nonzero(keep)
        return pd.DataFrame({"i": li[x], "j": ri[y], "dot": dot[x, y], "norms": norms[x, y]})
    return fn


def long_pairs(entries: DataFrame, top: int, floor: float,
               block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(i, j, dot, norms), both ways: best pairs by sums over long histories alone.

    Items lie in bands of falling partial norm p, ``BAND ** -b >= p``, and in
    blocks of about ``block_items`` within a band.  An item of norm p meets the
    bands whose bound times p reaches ``floor``; a band has one row in the
    driver, at most ``BANDS``.
    """
    band = F.least(F.floor(-F.log("p") / math.log(BAND)), F.lit(BANDS - 1)).cast("int")
    part = entries.groupBy("item_id").agg(
        F.least(F.sqrt(F.sum(F.pow("r", 2))) / F.max("norm"), dbl(1)).alias("p"))
    part = part.filter((F.col("p") >= floor) & (F.col("p") > 0)).withColumn("band", band)
    sizes = {r["band"]: max(1, math.ceil(r["n"] / block_items)) for r in
             part.groupBy("band").agg(F.count(F.lit(1)).alias("n")).collect()}
    blocks = F.create_map(*[F.lit(x) for b, n in (sizes or {0: 1}).items() for x in (b, n)])
    part = part.withColumn("block", F.pmod(F.xxhash64("item_id"), blocks[F.col("band")]))
    # The bands that an item has to meet, then all their blocks.
    bands = F.filter(F.array(*[F.lit(b) for b in sorted(sizes) or [0]]), lambda b: (
        b == BANDS - 1) | (F.col("p") * F.pow(dbl(BAND), -b.cast("double")) >= floor))
    met = (part.select("item_id", F.col("band").alias("a"), F.col("block").alias("ab"),
                       F.explode(bands).alias("b"))
           .withColumn("bb", F.explode(F.sequence(F.lit(0).cast("long"),
                                                  (blocks[F.col("b")] - 1).cast("long")))))
    needed = met.select("a", "ab", "b", "bb").distinct()
    left = met.join(entries, "item_id").select("a", "ab", "b", "bb", F.lit(0).alias("side"),
                                               "user_id", "item_id", "r", "norm")
    right = (needed.join(part.select("item_id", F.col("band").alias("b"), F.col("block").alias("bb")),
                         ["b", "bb"]).join(entries, "item_id")
             .select("a", "ab", "b", "bb", F.lit(1).alias("side"), "user_id", "item_id", "r", "norm"))
    return left.unionByName(right).groupBy("a", "ab", "b", "bb").applyInPandas(
        _products(top, floor), "i long, j long, dot double, norms double")


def item_knn(train: DataFrame, min_interactions: int = KNN_MIN_INTERACTIONS,
             top: int = KNN_TOP, min_similarity: float = KNN_MIN_SIMILARITY,
             long_history: int = LONG_HISTORY, block_items: int = BLOCK_ITEMS,
             few_pairs: int | None = None) -> DataFrame:
    """Cosine item-item neighbours over rating vectors: (item_id, neighbor_id,
    similarity, rank).

    Items with fewer than ``min_interactions`` rows are left out; pairs share a
    user; similarity is rounded to 9 digits before ranking, so equal values tie
    (smaller neighbour id first); the ``top`` best of at least
    ``min_similarity`` stay.  Ratings are not negative.
    """
    x = written(knn_entries(train, min_interactions), "knn-entries")
    short, entries = split_histories(x, long_history)
    floor = min_similarity - 1e-9
    entries = written(entries, "knn-long")
    if pair_rows(short) > (2 * PAIR_ROWS if few_pairs is None else few_pairs):
        both = added(block_pairs(x, short, entries, top, floor), entries).filter(
            F.col("dot") / F.col("norms") >= floor)
    else:
        pairs = long_sums(short_pairs(short), entries, floor)
        both = pairs.filter(F.col("dot") / F.col("norms") >= floor).select(
            F.explode(F.array(F.struct("i", "j", "dot", "norms"),
                              F.struct(F.col("j").alias("i"), F.col("i").alias("j"), "dot", "norms")))
            .alias("s")).select("s.*")
    # A pair of the second kind that shares a short history too is there already,
    # with its whole sum, which is at least as high.
    alone = long_pairs(entries, top, floor, block_items)
    best = both.unionByName(alone).groupBy("i", "j").agg(
        F.max(F.round(F.col("dot") / F.col("norms"), SIM_DIGITS)).alias("similarity"))
    ranked = top_k_per_group(best.filter(F.col("similarity") >= dbl(min_similarity)), ["i"],
                             [F.col("similarity").desc(), F.col("j").asc()], top, salt_col="j")
    return ranked.select(F.col("i").alias("item_id"), F.col("j").alias("neighbor_id"),
                         "similarity", "rank")
