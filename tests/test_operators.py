"""Operator behaviour on small fixtures and brute-force checks."""


import numpy as np
import pytest
from pyspark.sql import functions as F

from rankforge.operators import features, models, ranking
from rankforge.sources.tables import read_interactions_csv


def test_dedup_last_total_order(spark):
    rows = [(1, 1, 3.0, "view", 10.0, "s1", 5, 1, 1), (1, 1, 4.0, "rating", 10.0, "s2", 6, 1, 1),
            (1, 1, 1.0, "view", 5.0, "s3", 9, 1, 1), (2, 1, 5.0, "view", 1.0, "s4", 1, 1, 1)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating double, "
                                     "interaction_type string, timestamp double, "
                                     "session_id string, l_orderkey long, l_linenumber int, "
                                     "l_suppkey long")
    got = {(r["user_id"], r["item_id"]): r["rating"] for r in features.dedup_last(df).collect()}
    assert got == {(1, 1): 4.0, (2, 1): 5.0}


def test_last_nonnull_skips_nulls(spark):
    rows = [(1, 1, 3.0, "a", 1.0), (1, 1, None, "b", 2.0)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating double, "
                                     "interaction_type string, timestamp double")
    r = features.last_nonnull(df, order_cols=("timestamp",),
                              value_cols=("rating", "interaction_type")).first()
    assert r["rating"] == 3.0 and r["interaction_type"] == "b"


def test_validate_rejects_out_of_range(spark):
    rows = [(1, 1, 6.0, "rating"), (1, 2, 4.0, "view"), (None, 2, 4.0, "view"),
            (1, 3, 4.0, "teleport"), (1, 4, None, "view")]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating double, "
                                     "interaction_type string")
    good, bad = features.split_valid(df)
    assert good.count() == 1
    reasons = sorted(r["reject_reason"] for r in bad.collect())
    assert reasons == ["missing_rating", "missing_user", "rating_out_of_range", "unknown_type"]


def test_top_k_salted_equals_plain(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), F.col("id").alias("x"),
                                  ((F.col("id") * 7919) % 1000).alias("s"))
    a = ranking.top_k_per_group(df, ["g"], [F.col("s").desc(), F.col("x")], 7, salt_col="x")
    b = ranking.top_k_per_group(df, ["g"], [F.col("s").desc(), F.col("x")], 7)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_popularity_recs_excludes_seen(spark):
    train = spark.createDataFrame([(u, i) for u in range(1, 4) for i in range(1, 6 - u)],
                                  "user_id long, item_id long")
    pool = ranking.popularity_pool(train, 3)
    users = spark.createDataFrame([(1,), (9,)], "user_id long")
    recs = ranking.popularity_recs(users, train, pool, 2)
    got = {}
    for r in recs.collect():
        got.setdefault(r["user_id"], []).append((r["rank"], r["item_id"]))
    assert got[9] == [(1, 1), (2, 2)]
    assert 1 not in got or all(i not in (1, 2, 3, 4) for _, i in got[1])


def test_recency_two_level_equals_window(spark):
    from pyspark.sql import Window
    df = spark.range(3000).select(
        (F.col("id") % 4).alias("user_id"), F.col("id").alias("event_id"),
        ((F.col("id") * 104729) % 500000).cast("double").alias("timestamp"))
    a = features.recency(df, tie_cols=["event_id"], bucket_seconds=20000.0)
    w = Window.partitionBy("user_id").orderBy("timestamp", "event_id")
    b = df.withColumn("t2", F.col("timestamp") - F.lag("timestamp").over(w))
    j = a.join(b, "event_id")
    assert j.filter(~F.col("time_since_last_interaction").eqNullSafe(F.col("t2"))).count() == 0


def test_item_knn_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(int(u), int(i), float(rng.integers(1, 6)))
            for u in range(40) for i in rng.choice(30, size=8, replace=False)]
    train = spark.createDataFrame(rows, "user_id long, item_id long, rating double")
    m = np.zeros((40, 30))
    for u, i, r in rows:
        m[u, i] = r
    norms = np.linalg.norm(m, axis=0)
    co = m.T @ m
    expected = {(i, j) for i in range(30) for j in range(30) if i != j and co[i, j] > 0}
    for long_history in (4, 8, 1024):
        got = {(r["item_id"], r["neighbor_id"]): r["similarity"]
               for r in models.item_knn(train, min_interactions=1, top=50, min_similarity=0.0,
                                        long_history=long_history, block_items=7).collect()}
        for (i, j), s in got.items():
            assert s == pytest.approx(m[:, i] @ m[:, j] / (norms[i] * norms[j]), abs=1e-8)
        assert set(got) == expected


def test_item_knn_top_k_paths_agree(spark):
    rng = np.random.default_rng(5)
    rows = [(int(u), int(i), float(rng.integers(1, 6)))
            for u in range(60) for i in rng.choice(50, size=10, replace=False)]
    train = spark.createDataFrame(rows, "user_id long, item_id long, rating double")
    a = models.item_knn(train, min_interactions=2, top=5, long_history=1)
    b = models.item_knn(train, min_interactions=2, top=5, long_history=1024)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_randomized_svd_singular_values(spark):
    rng = np.random.default_rng(0)
    u = rng.normal(size=(60, 3))
    v = rng.normal(size=(40, 3))
    mat = u @ np.diag([9.0, 5.0, 2.0]) @ v.T
    rows = [(int(a), int(b), float(mat[a, b])) for a in range(60) for b in range(40)]
    a = spark.createDataFrame(rows, "user_id long, item_id long, v double")
    _, _, s = models.randomized_svd(spark, a, k=3, oversample=5, n_iter=2, checkpoint=False)
    ref = np.linalg.svd(mat, compute_uv=False)[:3]
    assert np.allclose(s, ref, rtol=1e-6)


def test_pca_width_rule():
    from rankforge.streaming.jobs import feature_pipeline
    assert feature_pipeline([f"c{i}" for i in range(8)]).getStages()[-1].getK() == 2
    assert feature_pipeline([f"c{i}" for i in range(15)]).getStages()[-1].getK() == 4


def test_csv_reader_by_header(spark, tmp_path):
    p = tmp_path / "i.csv"
    p.write_text("user_id,item_id,rating,timestamp,interaction_type,session_id\n"
                 "1,101,4.5,1640995200,rating,s1\n")
    r = read_interactions_csv(spark, str(p)).first()
    assert r["item_id"] == 101 and r["rating"] == 4.5 and r["timestamp"] == 1640995200.0


def test_promotion_rules(spark):
    v = spark.createDataFrame([(1, "a", 0.9), (2, "b", 0.95), (3, "c", 0.8), (4, "d", 0.8)],
                              "version int, model string, rmse double")
    got = {r["version"]: r["stage"] for r in models.promotion(v).collect()}
    assert got == {1: "archived", 2: "staging", 3: "production", 4: "staging"}


def test_factor_scores_are_dot_products(spark):
    uf = spark.createDataFrame([(1, [1.0, 2.0]), (2, [0.5, 0.0])], "user_id long, f array<double>")
    itf = spark.createDataFrame([(10, [1.0, 1.0]), (11, [3.0, -1.0])], "item_id long, f array<double>")
    users = spark.createDataFrame([(1,), (2,), (2,), (9,)], "user_id long")
    none = spark.createDataFrame([], "user_id long, item_id long")
    got = {(r["user_id"], r["item_id"]): r["score"]
           for r in models.factor_top_n(uf, itf, users, none, 2).collect()}
    assert got == {(1, 10): 3.0, (1, 11): 1.0, (2, 10): 0.5, (2, 11): 1.5}
    seen = spark.createDataFrame([(1, 10), (1, 10), (1, 77)], "user_id long, item_id long")
    recs = models.factor_top_n(uf, itf, users.filter("user_id = 1"), seen, 1)
    assert [(r["item_id"], r["rank"]) for r in recs.collect()] == [(11, 1)]
    assert models.factor_top_n(uf, itf.limit(0), users, seen, 1).count() == 0
    assert models.factor_top_n(uf.limit(0), itf, users, seen, 1).count() == 0


def _factor_case(spark):
    """30 users by 70 items with tied scores, one user who saw nearly all, one who saw all."""
    rng = np.random.default_rng(8)
    u = rng.integers(-2, 3, (30, 4)).astype(float)
    i = rng.integers(-2, 3, (70, 4)).astype(float)
    seen = {(int(x), int(y)) for x, y in zip(rng.integers(0, 30, 200), rng.integers(0, 70, 200))}
    seen |= {(0, y) for y in range(68)} | {(1, y) for y in range(70)}
    uf = spark.createDataFrame([(x, v.tolist()) for x, v in enumerate(u)], "user_id long, f array<double>")
    itf = spark.createDataFrame([(x, v.tolist()) for x, v in enumerate(i)], "item_id long, f array<double>")
    return u, i, seen, uf, itf, spark.createDataFrame(sorted(seen), "user_id long, item_id long")


def test_factor_top_n_matches_brute_force(spark):
    u, i, seen, uf, itf, sdf = _factor_case(spark)
    want = []
    for x in range(30):
        rest = sorted((-float(u[x] @ i[y]), y) for y in range(70) if (x, y) not in seen)
        want += [(x, y, -s, k + 1) for k, (s, y) in enumerate(rest[:5])]
    for blocks in ((7, 9), (1024, 4096)):
        recs = models.factor_top_n(uf, itf, uf.select("user_id"), sdf, 5, *blocks)
        assert sorted((r["user_id"], r["item_id"], r["score"], r["rank"])
                      for r in recs.collect()) == sorted(want)


def test_blended_top_n_matches_brute_force(spark):
    u, i, seen, uf, itf, sdf = _factor_case(spark)
    i2 = np.random.default_rng(4).normal(size=(70, 3))
    u2 = np.random.default_rng(5).normal(size=(30, 3))
    u2[3] = 0.0                                                  # all of this user's scores are equal
    uf2 = spark.createDataFrame([(x, v.tolist()) for x, v in enumerate(u2)], "user_id long, f array<double>")
    itf2 = spark.createDataFrame([(x, i2[x].tolist()) for x in range(60)],     # lacks ten items
                                 "item_id long, f array<double>")
    got = {}
    for r in models.blended_top_n((uf, itf), (uf2, itf2), uf.select("user_id"), sdf, 6).collect():
        got.setdefault(r["user_id"], []).append((r["rank"], r["item_id"], r["score"]))
    for x in range(30):
        rest = [y for y in range(70) if (x, y) not in seen]
        total = dict.fromkeys(rest, 0.0)
        for a, b, n in ((u, i, 70), (u2, i2, 60)):
            own = {y: float(a[x] @ b[y]) for y in rest if y < n}
            lo, hi = min(own.values(), default=0), max(own.values(), default=0)
            for y, s in own.items():
                total[y] += 0.5 * ((s - lo) / (hi - lo) if hi > lo else 1.0)
        best = sorted(rest, key=lambda y: (-round(total[y], 9), y))[:6]
        mine = sorted(got.get(x, []))
        assert [y for _, y, _ in mine] == best
        assert [s for _, _, s in mine] == pytest.approx([total[y] for y in best], abs=1e-8)


def test_running_sums_and_gap_sessions_equal_plain_windows(spark):
    from pyspark.sql import Window
    rng = np.random.default_rng(11)
    n = 4000
    users = np.where(rng.random(n) < 0.4, 0, rng.integers(1, 30, n))      # hot user 0
    ts = rng.integers(0, 3 * 86400, n).astype(float)                       # many ties
    rating = rng.integers(1, 6, n).astype(float)
    rows = [(int(u), int(i), float(t), float(r)) for i, (u, t, r) in
            enumerate(zip(users, ts, rating))]
    df = spark.createDataFrame(rows, "user_id long, event_id long, timestamp double, "
                                     "rating double")
    b = df.withColumn("_tb", F.floor(F.col("timestamp") / 7200.0)).withColumn("_one", F.lit(1))
    got = features.running_sum_in_buckets(b, ["user_id"], ["timestamp", "event_id"],
                                          ["_one", "rating"], "_tb", ["c", "s"],
                                          inclusive=False)
    w = (Window.partitionBy("user_id").orderBy("timestamp", "event_id")
         .rowsBetween(Window.unboundedPreceding, -1))
    ref = df.select("event_id", F.coalesce(F.count(F.lit(1)).over(w), F.lit(0)).alias("c2"),
                    F.coalesce(F.sum("rating").over(w), F.lit(0.0)).alias("s2"))
    j = got.join(ref, "event_id")
    assert j.filter((F.col("c") != F.col("c2")) | (F.abs(F.col("s") - F.col("s2")) > 1e-9)) \
        .count() == 0

    ev = df.select("user_id", "event_id", F.timestamp_seconds("timestamp").alias("ts"))
    sessions = features.gap_sessions(ev, "user_id", "ts", "event_id", gap_seconds=1800.0,
                                      bucket_seconds=3600.0)
    wu = Window.partitionBy("user_id").orderBy("ts", "event_id")
    t = F.unix_seconds("ts")
    flag = F.when(F.lag(t).over(wu).isNull() | (t - F.lag(t).over(wu) >= 1800), 1).otherwise(0)
    ref_s = (ev.withColumn("f", flag)
             .withColumn("sid", F.sum("f").over(wu.rowsBetween(Window.unboundedPreceding, 0)))
             .groupBy("user_id", "sid").agg(F.count(F.lit(1)).alias("n_events"),
                                            F.min("ts").alias("session_start")))
    a = sessions.select("user_id", "session_start", "n_events")
    bb = ref_s.select("user_id", "session_start", "n_events")
    assert a.exceptAll(bb).count() == 0 and bb.exceptAll(a).count() == 0


def test_blend_minmax_average_full_outer(spark):
    from rankforge.plans.q_metrics import blend
    a = spark.createDataFrame([(1, 10, 5.0), (1, 11, 3.0), (1, 12, 1.0)],
                              "user_id long, item_id long, score double")
    b = spark.createDataFrame([(1, 12, 0.9), (1, 13, 0.1)],
                              "user_id long, item_id long, score double")
    got = [(r["item_id"], round(r["score"], 6), r["rank"])
           for r in blend(a, b, 3).orderBy("rank").collect()]
    # a scaled: 10->1, 11->0.5, 12->0; b scaled: 12->1, 13->0; mean with 0 for missing
    assert got == [(10, 0.5, 1), (12, 0.5, 2), (11, 0.25, 3)]


def test_lists_reach_beyond_the_items_a_user_has_seen(spark):
    train = spark.createDataFrame(
        [(1, i) for i in range(250)] + [(u, i) for u in range(2, 5) for i in range(200)]
        + [(9, i) for i in range(250, 260)], "user_id long, item_id long")
    pool = ranking.popularity_pool(train)
    users = spark.createDataFrame([(1,), (2,), (77,)], "user_id long")
    rows = ranking.popularity_recs(users, train, pool, 5).collect()
    got = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        got.setdefault(r["user_id"], []).append(r["item_id"])
    assert got == {1: [250, 251, 252, 253, 254], 2: [200, 201, 202, 203, 204], 77: [0, 1, 2, 3, 4]}
    few = ranking.popularity_recs(users.filter("user_id = 1"), train, pool, 50)
    assert sorted(r["item_id"] for r in few.collect()) == list(range(250, 260))


def test_item_ranking_is_dense_and_ordered(spark):
    scores = spark.range(1000).selectExpr("id AS item_id", "CAST(id % 7 AS DOUBLE) AS score")
    rows = ranking.item_ranking(scores.repartition(8)).orderBy("prank").collect()
    assert [r["prank"] for r in rows] == list(range(1, 1001))
    assert [(r["score"], r["item_id"]) for r in rows] == sorted(
        ((i % 7, i) for i in range(1000)), key=lambda x: (-x[0], x[1]))
    assert ranking.item_ranking(scores.limit(0)).count() == 0


def test_sparse_product_moves_no_row_for_each_entry(spark):
    """Equal to the plain join and sum, null keys and odd values included; the
    factors reach each block of sums once."""
    rng = np.random.default_rng(2)
    cells = {(int(u), int(i)): float(v) for u, i, v in zip(
        rng.integers(0, 300, 5000), rng.integers(-40, 60, 5000) * 10**15, rng.normal(size=5000))}
    rows = [(u, i, v) for (u, i), v in cells.items()]
    rows += [(None, 0, 2.5), (None, 10**15, 1.0), (5, None, 9.0), (10**18 + 1, 0, 4.0), (7, 0, 3.0)]
    a = spark.createDataFrame(rows, "user_id long, item_id long, v double").repartition(5)
    f = {i: rng.normal(size=4).tolist() for i in {r[1] for r in rows} - {None}}
    m = spark.createDataFrame(list(f.items()), "item_id long, f array<double>").repartition(3)
    want = {}
    for u, i, v in rows:
        if i is not None:
            want[u] = want.get(u, 0) + v * np.array(f[i])
    for blocks in (1, 3):
        dealt = models._dealt(a, "user_id", "item_id", blocks)
        out = models.sparse_product(dealt, m, "user_id", "item_id", blocks, 4)
        got = {r.user_id: r.f for r in out.collect()}
        assert got.keys() == want.keys() and out.count() == len(want)
        for u, x in want.items():
            assert np.allclose(got[u], x, atol=1e-12)
    assert models._factor_rows(m, "item_id", 3, 4).agg(
        F.sum(F.length("b"))).first()[0] == 3 * len(f) * 4 * 8
    for x in (np.array([1, 2**53 + 1]), np.array([0.1, 3]), np.array([5.0, np.nan]),
              np.array([], float), np.array([2**40 + 0.5]), np.array([-1, 127])):
        back = models._unpack(models._pack(x))
        assert back.astype(x.dtype).tobytes() == x.tobytes()
