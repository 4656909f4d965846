import numpy as np
import pytest
from pyspark.sql import functions as F

from rankforge.operators import ranking


def pool_of(spark, scores):
    order = sorted(scores, key=lambda i: (-scores[i], i))
    return spark.createDataFrame([(i, float(scores[i]), k + 1) for k, i in enumerate(order)],
                                 "item_id long, score double, prank long"), order


@pytest.mark.parametrize("block", [4, 16, 4096])
def test_gap_walk_equals_brute_force(spark, block):
    rng = np.random.default_rng(block)
    scores = {i: int(rng.integers(0, 9)) for i in range(60)}
    pool, order = pool_of(spark, scores)
    seen = {0: set(), 1: set(order[:30]), 2: set(order), 3: set(order[:58]), 4: {order[0], 999},
            5: set(order[5:50:2])}
    for u in range(6, 20):
        seen[u] = set(rng.choice(60, rng.integers(0, 40), replace=False).tolist())
    rows = [(u, int(i)) for u, s in seen.items() for i in s] * 2
    seen_df = spark.createDataFrame(rows, "user_id long, item_id long")
    users = spark.createDataFrame([(u,) for u in seen] * 2, "user_id long")
    ranks = ranking.unseen_ranks(users, ranking.seen_ranks(seen_df, pool), 7, block=block)
    got = ranking.with_pool(ranks, pool, 7)
    want = sorted((u, i, float(scores[i]), k + 1) for u, s in seen.items()
                  for k, i in enumerate([i for i in order if i not in s][:7]))
    assert sorted(tuple(r) for r in got.collect()) == want


def test_no_anti_join_in_lists(spark):
    pool, _ = pool_of(spark, {1: 1, 2: 2})
    seen = spark.createDataFrame([(1, 1)], "user_id long, item_id long")
    plan = ranking.popularity_recs(seen.select("user_id"), seen, pool, 3) \
        ._jdf.queryExecution().toString()
    assert "LeftAnti" not in plan


def blend_brute(users, seen, a, b, n):
    out = []
    for u in users:
        free = [i for i in a if i not in seen.get(u, ())]
        if not free:
            continue

        def scale(s, free=free):
            lo, hi = min(s[i] for i in free), max(s[i] for i in free)
            return {i: (s[i] - lo) / (hi - lo) if hi > lo else 1.0 for i in free}
        sa, sb = scale(a), scale(b)
        best = sorted(free, key=lambda i: (-round((sa[i] + sb[i]) / 2, 9), i))[:n]
        out += [(u, i, round((sa[i] + sb[i]) / 2, 9), k + 1) for k, i in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("kind", ["opposed", "random", "ties"])
def test_threshold_blend_equals_whole_catalog(spark, kind):
    rng = np.random.default_rng(3)
    items = range(300)
    a = {i: float(rng.random() if kind != "ties" else rng.integers(0, 4)) for i in items}
    b = {i: (1 - a[i] + 0.2 * rng.random() if kind == "opposed" else float(rng.integers(0, 5)))
         for i in items}
    seen = {u: set(rng.choice(300, rng.integers(0, 200), replace=False).tolist()) for u in range(12)}
    seen[0], seen[1], seen[2] = set(), set(items), set(range(297))
    df = spark.createDataFrame([(u, int(i)) for u, s in seen.items() for i in s],
                               "user_id long, item_id long")
    users = spark.createDataFrame([(u,) for u in seen], "user_id long")
    got = ranking.threshold_blend(users, df, pool_of(spark, a)[0], pool_of(spark, b)[0], 5).collect()
    assert sorted((r.user_id, r.item_id, round(r.score, 9), r["rank"]) for r in got) == \
        blend_brute(seen, seen, a, b, 5)
    # Ranks read: a cut at 20 would lose items when the two lists oppose each other.
    depth = {r.user_id: r.depth for r in got}
    print(kind, "ranks read", sorted(depth.values()))
    if kind == "opposed":
        assert max(depth.values()) > 20


def test_blend_reads_few_ranks_of_agreeing_lists(spark):
    a = {i: float(1000 - i) for i in range(1000)}
    users = spark.createDataFrame([(1,), (2,)], "user_id long")
    seen = spark.createDataFrame([(1, 0), (1, 3)], "user_id long, item_id long")
    got = ranking.threshold_blend(users, seen, pool_of(spark, a)[0], pool_of(spark, a)[0], 5)
    assert got.agg(F.max("depth")).first()[0] == 20
