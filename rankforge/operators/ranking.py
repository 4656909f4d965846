"""Ranking, top-k, candidate generation and list operators.

Skew: a single user may own a large share of all rows, so per-group top-k is
done in two phases.  Rows are first ranked inside (group, salt) buckets, where
the salt is a hash of a tie-break column; only the best k of each bucket reach
the final per-group ranking, so no task ever sorts a whole hot group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.functions.columns import col_
from rankforge.operators.scan import best_items, score_range
from rankforge.session import written

DEFAULT_SALT_BUCKETS = 32
RANK_BLOCK = 65536


def top_k_per_group(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column],
                    k: int, rank_col: str = "rank", salt_col: str | None = None,
                    salt_buckets: int = DEFAULT_SALT_BUCKETS) -> DataFrame:
    """Keep the first ``k`` rows of each group under a total order.

    ``order_cols`` must be a total order inside a group (end with a unique
    key), so the result is deterministic.  ``salt_col`` (default: the last
    order column's name is not known, so the caller names a high-cardinality
    column) spreads a hot group over ``salt_buckets`` tasks.
    """
    group_cols = list(group_cols)
    if salt_col is not None and salt_buckets > 1:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(col_(salt_col)), F.lit(salt_buckets)))
        w1 = Window.partitionBy(*group_cols, "_salt").orderBy(*order_cols)
        df = (salted.withColumn("_r1", F.row_number().over(w1))
              .filter(F.col("_r1") <= k).drop("_r1", "_salt"))
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def rank_candidates(cands: DataFrame, k: int, user_col: str = "user_id",
                    score_col: str = "score", item_col: str = "item_id",
                    bounded: bool = False) -> DataFrame:
    """W1 + W2: rank by score desc, item id asc; keep rank <= k.

    ``bounded=True`` when each user's candidate list has a fixed size bound
    (e.g. the union of two top-20 lists): one window suffices.  Otherwise
    the two-phase salted top-k keeps a hot user off a single task."""
    return top_k_per_group(cands, [user_col],
                           [F.col(score_col).desc(), F.col(item_col).asc()], k,
                           salt_col=None if bounded else item_col)


def exclude_seen(cands: DataFrame, seen: DataFrame, keys=("user_id", "item_id")) -> DataFrame:
    """Drop candidates the user already interacted with (left anti join)."""
    return cands.join(seen.select(*keys), list(keys), "left_anti")


def item_ranking(item_scores: DataFrame, score_col: str = "score",
                 item_col: str = "item_id") -> DataFrame:
    """All items ranked by score desc, id asc: (item_id, score, prank from 1).

    One distributed sort; a row's rank is its place inside its range partition
    plus the sizes of the partitions before (one row per partition).  The
    sorted rows are written once, since range bounds are sampled anew in each
    execution."""
    order = item_scores.select(item_col, F.col(score_col).cast("double").alias("score")) \
        .orderBy(F.col("score").desc(), F.col(item_col).asc())
    rows = written(order.select(
        "*", F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_row")), "ranking")
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    return rows.join(before, "_part").select(
        item_col, "score", (F.col("_before") + F.col("_row") + 1).alias("prank"))


def popularity_pool(train: DataFrame, pool_size: int | None = None,
                    item_col: str = "item_id") -> DataFrame:
    """Items by how often they were interacted with: (item_id, score, prank);
    all of them, or the first ``pool_size``."""
    counts = train.groupBy(item_col).agg(F.count(F.lit(1)).alias("score"))
    ranked = item_ranking(counts, item_col=item_col)
    return ranked if pool_size is None else ranked.filter(F.col("prank") <= pool_size)


def popularity_candidates(users: DataFrame, seen: DataFrame, pool: DataFrame, n: int,
                          user_col: str = "user_id", item_col: str = "item_id") -> DataFrame:
    """Unseen items among each user's first ``n`` + (number of seen items)
    ranks: at least the ``n`` best unseen ones, if the pool has as many.

    Rows are linear in users x n plus the seen pairs.  The first ``n`` ranks,
    which all users join, are salted."""
    pairs = seen.select(user_col, item_col).distinct()
    own = pairs.groupBy(user_col).agg(F.count(F.lit(1)).alias("_seen"))
    need = users.select(user_col).distinct().join(own, user_col, "left").select(
        user_col, (F.coalesce("_seen", F.lit(0)) + n).alias("_need"))
    # Blocks keep a user with a very long history from making one long array.
    block = F.lit(RANK_BLOCK)
    ranks = need.select("*", F.explode(F.sequence(
        F.lit(0), F.floor((F.col("_need") - 1) / block))).alias("_b")).select(
        user_col, F.explode(F.sequence(F.col("_b") * block + 1, F.least(
            (F.col("_b") + 1) * block, F.col("_need")))).alias("prank"))
    low = F.col("prank") <= n
    salts = F.lit(DEFAULT_SALT_BUCKETS)
    ranks = ranks.withColumn("_salt", F.when(low, F.pmod(F.xxhash64(user_col), salts))
                             .otherwise(F.lit(0)))
    items = pool.withColumn("_salt", F.explode(F.when(
        low, F.sequence(F.lit(0).cast("long"), (salts - 1).cast("long")))
        .otherwise(F.array(F.lit(0).cast("long")))))
    return (ranks.join(items, ["prank", "_salt"]).drop("_salt")
            .join(pairs, [user_col, item_col], "left_anti"))


def seen_ranks(seen: DataFrame, pool: DataFrame, user_col: str = "user_id",
               item_col: str = "item_id") -> DataFrame:
    """(user, prank): the ranks of the items that each user has seen."""
    return seen.select(user_col, item_col).distinct().join(
        pool.select(item_col, "prank"), item_col).select(user_col, "prank")


def unseen_ranks(users: DataFrame, ranks: DataFrame, n: int, user_col: str = "user_id",
                 block: int = 4096) -> DataFrame:
    """(user, rank, prank): the first ``n`` ranks (rank 1 .. n) without an entry
    in ``ranks``, by a walk over the gaps between a user's seen ranks.

    The k-th unseen rank is k plus the number of seen ranks with fewer than k
    unseen ones before them.  Counts per block of ranks tell up to which block a
    user has to look, so only the seen ranks up to there make an array; a long
    history spread over the catalog gives a short one.  Ranks beyond the end of
    the pool are given too: the join with the pool drops them.
    """
    u = users.select(user_col).distinct()
    ranks = ranks.join(u, user_col, "left_semi").withColumn(
        "_b", F.floor((F.col("prank") - 1) / F.lit(block)))
    w = Window.partitionBy(user_col).orderBy("_b")
    blocks = (ranks.groupBy(user_col, "_b").agg(F.count(F.lit(1)).alias("_c"))
              .withColumn("_free", (F.col("_b") + 1) * block - F.sum("_c").over(w))
              .withColumn("_before", F.col("_free") - block + F.col("_c")))
    # Blocks with fewer than n unseen ranks before them.
    needed = blocks.filter(F.col("_before") < n).select(user_col, "_b")
    own = (ranks.join(needed, [user_col, "_b"], "left_semi").groupBy(user_col)
           .agg(F.array_sort(F.collect_list("prank")).alias("_s")))
    gaps = F.transform("_s", lambda r, j: r - (j + 1))
    u = u.join(own, user_col, "left").select(
        user_col, F.coalesce(F.filter(gaps, lambda g: g < n), F.array().cast("array<bigint>"))
        .alias("_g"))
    found = F.transform(F.sequence(F.lit(1), F.lit(n)),
                        lambda k: k + F.size(F.filter("_g", lambda g: g < k)))
    return u.select(user_col, F.posexplode(found).alias("_k", "prank")).select(
        user_col, (F.col("_k") + 1).alias("rank"), F.col("prank").cast("long").alias("prank"))


def with_pool(ranked: DataFrame, pool: DataFrame, n: int, user_col: str = "user_id",
              item_col: str = "item_id") -> DataFrame:
    """``ranked`` (user, rank, prank) with item and score.  The pool's head,
    which all users join, is copied to each salt; further ranks are keys of few users."""
    low = F.col("prank") <= 8 * n
    salts = F.lit(DEFAULT_SALT_BUCKETS)
    ranked = ranked.withColumn("_salt", F.when(low, F.pmod(F.xxhash64(user_col), salts))
                               .otherwise(F.lit(0)))
    items = pool.select(item_col, "score", "prank").withColumn("_salt", F.explode(F.when(
        low, F.sequence(F.lit(0).cast("long"), (salts - 1).cast("long")))
        .otherwise(F.array(F.lit(0).cast("long")))))
    return ranked.join(items, ["prank", "_salt"]).select(user_col, item_col, "score", "rank")


def popularity_recs(users: DataFrame, seen: DataFrame, pool: DataFrame, n: int,
                    user_col: str = "user_id", item_col: str = "item_id") -> DataFrame:
    """Exact top-``n`` of the pool per user without the items the user has
    seen: (user_id, item_id, score, rank).  Users with fewer unseen items in
    the pool get those."""
    ranks = unseen_ranks(users, seen_ranks(seen, pool, user_col, item_col), n, user_col)
    return with_pool(ranks, pool, n, user_col, item_col)


def threshold_blend(users: DataFrame, seen: DataFrame, first: DataFrame, second: DataFrame,
                    n: int, depth: int | None = None) -> DataFrame:
    """Exact top-``n`` of two rankings of one catalog, each min-max scaled
    per user over all unseen items and averaged: (user_id, item_id, score, rank,
    depth), ``depth`` being the ranks read of each list.

    Threshold algorithm (Fagin, Lotem and Naor, 2003), a round for all users at
    once: read the next unseen ranks of both lists, look up the other score, and
    let a user go once the n-th blend is above what the last ranks read could
    reach together, or a list is at its end.  The others go to ``blend_scan``
    (the depth is the longer list then): how deep they would have to read depends
    on how far the lists agree, and is near the whole catalog if they do not.
    Equal blends (9 digits) rank by item id.
    """
    pools = [written(p.select("item_id", "score", "prank"), "blend-pool") for p in (first, second)]
    size = [p.count() for p in pools]
    ranks = [written(seen_ranks(seen, p), "blend-seen") for p in pools]
    active = written(users.select("user_id").distinct(), "blend-users")
    for k, (p, r, m) in enumerate(zip(pools, ranks, size)):
        # The lowest unseen score is the first one from the other end.
        def turn(df: DataFrame, m: int = m) -> DataFrame:
            return df.withColumn("prank", F.lit(m + 1) - F.col("prank"))
        lowest = with_pool(unseen_ranks(active, turn(r), 1), turn(p), 1)
        active = active.join(lowest.select("user_id", F.col("score").alias(f"lo{k}")), "user_id")
    active = written(active, "blend-users")
    depth = depth or 4 * n
    lists = [with_pool(unseen_ranks(active, r, depth), p, depth)
             for p, r in zip(pools, ranks)]
    lists = [written(x, "blend-read") for x in lists]
    ends = active
    for k, x in enumerate(lists):
        ends = ends.join(x.groupBy("user_id").agg(
            F.max("score").alias(f"hi{k}"), F.min("score").alias(f"at{k}"),
            F.count(F.lit(1)).alias(f"n{k}")), "user_id")

    def scaled(k: int, score: Column) -> Column:
        gap = F.col(f"hi{k}") - F.col(f"lo{k}")
        return F.when(gap > 0, (score - F.col(f"lo{k}")) / gap).otherwise(F.lit(1.0))
    cands = lists[0].select("user_id", "item_id").union(
        lists[1].select("user_id", "item_id")).distinct()
    for k, p in enumerate(pools):
        cands = cands.join(p.select("item_id", F.col("score").alias(f"s{k}")), "item_id")
    blend = (scaled(0, F.col("s0")) + scaled(1, F.col("s1"))) / F.lit(2.0)
    reach = (scaled(0, F.col("at0")) + scaled(1, F.col("at1"))) / F.lit(2.0)
    whole = (F.col("n0") < depth) | (F.col("n1") < depth)
    scored = cands.join(ends, "user_id").select(
        "user_id", "item_id", blend.alias("score"), F.round(blend, 9).alias("_r"),
        F.when(whole, F.lit(-1.0)).otherwise(reach).alias("_reach"))
    # At most 2 * depth candidates a user, all in one window only while depth is small.
    top = written(top_k_per_group(scored, ["user_id"], [F.col("_r").desc(), F.col("item_id")],
                                  n, salt_col="item_id"), "blend-top")
    sure = top.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"), F.min("_r").alias("_min"),
                                      F.max("_reach").alias("_reach"))
    sure = sure.filter((F.col("_reach") < 0) | ((F.col("_n") >= n) & (
        F.col("_min") > F.col("_reach") + F.lit(1e-8)))).select("user_id")
    out = top.join(sure, "user_id", "left_semi").select(
        "user_id", "item_id", "score", "rank", F.lit(depth).alias("depth"))
    others = written(active.select("user_id").join(sure, "user_id", "left_anti"), "blend-others")
    if others.isEmpty():
        return out
    return out.unionByName(blend_scan(others, seen, *pools, n).withColumn("depth", F.lit(max(size))))


def blend_scan(users: DataFrame, seen: DataFrame, first: DataFrame, second: DataFrame,
               n: int) -> DataFrame:
    """The lists of ``threshold_blend``, (user_id, item_id, score, rank), by a
    scan of the catalog: scores have 9 digits.

    A user's blend is linear in an item's two scores, so it is the dot product of
    [w1, w2, offset] and [s1, s2, 1]; tiles of items with near scores, whose best
    corner a user's n-th blend exceeds, are left out."""
    pools = [written(p.select("item_id", F.col("score").cast("double")), "blend-pool")
             for p in (first, second)]
    u = written(users.select("user_id", F.array(F.lit(1.0)).alias("f")).distinct(), "blend-users")
    own, weights, offset = u.select("user_id"), [], F.lit(0.0)
    for k, p in enumerate(pools):
        r = score_range(u, p.select("item_id", F.array("score").alias("f")), u, seen)
        # Rows without an item are in no list, but nobody has seen them: they count for the range.
        ends = p.filter(F.col("item_id").isNull()).agg(
            F.struct(F.min("score").alias("lo"), F.max("score").alias("hi"))).scalar()
        lo, hi = F.least(F.col("lo"), ends["lo"]), F.greatest(F.col("hi"), ends["hi"])
        own = own.join(r.select("user_id", lo.alias(f"lo{k}"), (hi - lo).alias(f"gap{k}")), "user_id")
        some = F.col(f"gap{k}") > 0
        weights.append(F.when(some, F.lit(0.5) / F.col(f"gap{k}")).otherwise(F.lit(0.0)))
        offset = offset + F.when(some, -F.col(f"lo{k}") * weights[k]).otherwise(F.lit(0.5))
    both = pools[0].join(pools[1].withColumnRenamed("score", "other"), "item_id")
    return best_items(own.select("user_id", F.array(*weights, offset).alias("f")),
                      both.select("item_id", F.array("score", "other", F.lit(1.0)).alias("f")),
                      u, seen, n)


def lists_from_ranked(recs: DataFrame, user_col="user_id", item_col="item_id",
                      rank_col="rank") -> DataFrame:
    """Ranked rows to one ordered array per user (bounded by the list length)."""
    return (recs.groupBy(user_col)
            .agg(F.array_sort(F.collect_list(F.struct(rank_col, item_col))).alias("_l"))
            .select(user_col, F.col(f"_l.{item_col}").alias("items")))


def latest_per_key(df: DataFrame, key_cols: Sequence[str], order_cols: Sequence[str],
                   payload_cols: Sequence[str]) -> DataFrame:
    """Latest row per key by a total order, as an aggregation.

    ``max(struct(order..., payload...))`` is combined map-side (partial
    aggregation), so a hot key costs one row per map task in the shuffle.
    """
    key_cols = list(key_cols)
    st = F.struct(*[F.col(c) for c in list(order_cols) + list(payload_cols)])
    return (df.groupBy(*key_cols).agg(F.max(st).alias("_m"))
            .select(*key_cols, *[F.col(f"_m.{c}").alias(c)
                                 for c in list(order_cols) + list(payload_cols)]))


def fresh_lists(stored: DataFrame, as_of, key_cols=("cache_key",)) -> DataFrame:
    """V2: keep stored lists whose ``expires_at`` is not before ``as_of``;
    latest stored entry per key wins."""
    live = stored.filter(F.col("expires_at") >= as_of)
    payload = [c for c in stored.columns if c not in key_cols and c not in ("created_at",)]
    return latest_per_key(live, key_cols, ["created_at"], payload)
