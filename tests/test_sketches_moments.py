import math
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankforge.functions import stats
from rankforge.operators import moments, monitoring, profiles
from rankforge.sources.tables import Tables, bucketed_tables, interactions
from rankforge.streaming import jobs


# --- quantile sketches ---------------------------------------------------------------
def test_folded_sketches_keep_the_rank_error(spark):
    rows = spark.range(200_000).select(
        (F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 3600)).alias("ts"),
        (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 7.0).alias("latency_ms"))
    sketches = monitoring.latency_sketches(rows, k=256)
    assert sketches.count() == 61
    folded = monitoring.fold_latency(sketches, 15, (0.5, 0.95, 0.99), k=256)
    exact = monitoring.windowed(rows, 15)
    for r in folded.collect():
        values = np.sort([x[0] for x in exact.filter(F.col("w.start") == r["w"]["start"])
                          .select("latency_ms").collect()])
        assert r["n"] == len(values)
        for p, name in ((0.5, "p50"), (0.95, "p95"), (0.99, "p99")):
            assert abs(np.searchsorted(values, r[name], "right") / len(values) - p) < 0.02


def test_small_windows_are_exact_and_nulls_are_left_out(spark):
    rows = spark.createDataFrame([(float(v) if v % 5 else None,) for v in range(100)],
                                 "latency_ms double").withColumn(
        "ts", F.lit("2024-01-01 00:00:30").cast("timestamp"))
    r = monitoring.fold_latency(monitoring.latency_sketches(rows), 5, (0.5, 0.95)).first()
    values = [v for v in range(100) if v % 5]
    assert (r["n"], r["p50"], r["p95"]) == (80, values[39], values[75])
    w = monitoring.latency_windows(rows, 5).first()
    assert w["n"] == 100 and w["p50"] == pytest.approx(np.percentile(values, 50))


# --- exact mergeable sets ------------------------------------------------------------
def test_bitmaps_count_distinct_over_batches(spark):
    rng = np.random.default_rng(0)
    rows = [(int(u), int(i), 3.0, 1.0) for u, i in zip(rng.integers(0, 200_000, 3000),
                                                        rng.integers(0, 5, 3000))]
    rows += [(u, 9, 1.0, 2.0) for u in range(70_000)] + [(None, 3, 2.0, 1.0), (None, 77, 2.0, 1.0)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating double, timestamp double")
    halves = [df.filter(F.coalesce(F.col("user_id"), F.lit(0)) % 3 == k) for k in range(3)]
    parts = profiles.item_partials(halves[0], 0)
    for k in (1, 2, 1):                                  # batch 1 twice: the set stays
        parts = parts.unionByName(profiles.item_partials(halves[k], k))
    got = {r.item_id: r.unique_users for r in profiles.merge_items(parts).collect()}
    want = {r.item_id: r.unique_users for r in profiles.item_features(df).collect()}
    assert got == want and got[9] == 70_000 and got[77] == 0


# --- Mann-Whitney ------------------------------------------------------------------
@pytest.mark.parametrize("n1,n2", [(1, 4), (3, 3), (5, 7), (2, 9)])
def test_counts_of_u_by_enumeration(n1, n2):
    want = np.zeros(n1 * n2 + 1)
    for c in combinations(range(n1 + n2), n1):
        want[sum(c) - n1 * (n1 - 1) // 2] += 1
    assert (stats.mann_whitney_counts(n1, n2, n1 * n2) == want).all()


def test_known_exact_p_values():
    # Published critical values: U at which the two-sided p first is at most 0.05.
    for n1, n2, u in ((4, 4, 0), (5, 5, 2), (6, 6, 5), (7, 7, 8), (8, 8, 13), (5, 8, 6)):
        assert stats.mann_whitney_exact(u, n1, n2) <= 0.05
        assert stats.mann_whitney_exact(u + 1, n1, n2) > 0.05
    assert stats.mann_whitney_exact(0, 3, 3) == pytest.approx(0.1)
    assert stats.mann_whitney_exact(4.5, 3, 3) == 1.0
    assert stats.mann_whitney_exact(20, 4, 5) == pytest.approx(2 / math.comb(9, 4))
    assert stats.mann_whitney_two_sided(0, 3, 3, 6.0) == stats.mann_whitney_p(0, 3, 3, 6.0)
    assert math.isnan(stats.mann_whitney_two_sided(0, 0, 3, 0.0))
    # A large second sample: close to the normal approximation.
    assert stats.mann_whitney_two_sided(30_000, 8, 10_000, 0.0) == pytest.approx(
        stats.mann_whitney_p(30_000, 8, 10_000, 0.0), rel=0.05)


# --- moments -----------------------------------------------------------------------
def test_folded_moments_and_components(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 4)) @ rng.normal(size=(4, 4)) + 1e6     # far from zero
    x[:, 3] = 7.0                                                     # constant
    rows = [(int(i % 7), *map(float, r)) for i, r in enumerate(x)] + [(3, None, 1.0, 2.0, 3.0)]
    df = spark.createDataFrame(rows, "k int, a double, b double, c double, d double")
    cols = ["a", "b", "c", "d"]
    parts = moments.partial_moments(df, cols, ["k"])
    whole = moments.merge_moments(parts, 4)
    got = {(r.a, r.b): r for r in moments.covariances(whole, cols).collect()}
    want = np.cov(x.T)
    for i, j in moments._pairs(4):
        assert got[cols[i], cols[j]].cov == pytest.approx(want[i, j], rel=1e-6, abs=1e-6)
        assert got[cols[i], cols[j]].n == 500
    twice = moments.merge_moments(moments.merge_moments(parts.filter("k < 3"), 4).unionByName(
        moments.merge_moments(parts.filter("k >= 3"), 4)), 4).first()
    assert twice["comoment"] == pytest.approx(whole.first()["comoment"], rel=1e-9, abs=1e-6)
    scale, loadings, explained = moments.principal_components(whole, cols, target_variance=0.9)
    z = (x[:, :3] - x[:, :3].mean(0)) / x[:, :3].std(0, ddof=1)
    values = np.sort(np.linalg.eigvalsh(np.cov(z.T)))[::-1] / 3
    assert np.allclose(explained, values[:len(explained)], atol=1e-6)
    assert explained.sum() >= 0.9 and (len(explained) == 1 or explained[:-1].sum() < 0.9)
    out = moments.project(df.filter("a is not null"), cols, scale, loadings)
    pc = np.array([r[0] for r in out.select("pc1").collect()])
    assert np.var(pc, ddof=1) == pytest.approx(values[0] * 3, rel=1e-4)
    assert moments.principal_components(whole, [f"c{i}" for i in range(4)])[1].shape == (4, 1)


def test_no_rows_have_no_moments(spark):
    df = spark.createDataFrame([], "a double, b double")
    m = moments.merge_moments(moments.partial_moments(df, ["a", "b"]), 2)
    assert m.count() == 0
    _, loadings, explained = moments.principal_components(m, ["a", "b"])
    assert loadings.shape == (2, 1) and explained.tolist() == [0.0]


# --- bucketed tables ----------------------------------------------------------------
def test_bucketed_tables_join_without_exchange(spark, sf_small, tmp_path):
    t = Tables(spark, sf_small)
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = interactions(bucketed_tables(t, str(tmp_path), "t_test", 4))
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" in interactions(t)._jdf.queryExecution().executedPlan().toString()
        key = lambda d: sorted(map(tuple, d.collect()))
        assert key(df) == key(interactions(t))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)
        for name in ("t_test_lineitem", "t_test_orders"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_sets_take_no_more_than_their_members(spark):
    """Spread members: a bitmap row is a number, not a buffer of 4 KB."""
    df = spark.createDataFrame([(1, 64 * k + k % 64) for k in range(-20, 500)] + [(1, 0), (1, None)],
                               "item_id long, user_id long")
    sets = profiles.distinct_bitmaps(df, "item_id", "user_id")
    assert sets.schema["members"].dataType.simpleString() == "bigint"
    assert profiles.distinct_counts(sets.unionByName(sets), "item_id", "n").first()["n"] == 520


def test_messages_are_compressed_and_read_back(spark, tmp_path):
    m = spark.createDataFrame([("t", str(k), '{"user_id": 1}', float(k)) for k in range(50)],
                              "topic string, key string, value string, _t double")
    path = jobs.write_messages(m, str(tmp_path / "source"), 2)
    assert list((tmp_path / "source").glob("*.json.gz"))
    assert not list((tmp_path / "source").glob("*.json"))
    assert spark.read.schema(jobs.MESSAGE_SCHEMA).json(path).count() == 50


def test_partial_moments_fold_rows_in_the_tasks(spark):
    """Many columns are no aggregate of all their pairs; null keys, rows with a
    null, and more keys than a task holds come out right."""
    rng = np.random.default_rng(3)
    x = rng.normal(1e6, 1, (9000, 3)).round(3)
    rows = [(i % 8000 if i % 9 else None, f"k{i % 2}", *map(float, r)) for i, r in enumerate(x)]
    rows += [(1, "k1", None, 1.0, 2.0), (None, None, 3.0, 4.0, 5.0)]
    df = spark.createDataFrame(rows, "a int, b string, x double, y double, z double").repartition(1)
    cols = ["x", "y", "z"]
    found = moments.partial_moments(df, cols, ["a", "b"])
    assert found.columns == ["a", "b", "n", "mean", "comoment"]
    want = {}
    for a, b, *v in rows:
        if None not in v:
            want.setdefault((a, b), []).append(v)
    got = {(r.a, r.b): r for r in found.collect()}
    assert got.keys() == want.keys() and found.count() == len(want) > 4096
    for key, v in want.items():
        d = np.array(v) - np.mean(v, axis=0)
        assert got[key].n == len(v) and np.allclose(got[key]["mean"], np.mean(v, axis=0), rtol=1e-12)
        assert np.allclose(got[key]["comoment"], (d.T @ d)[np.triu_indices(3)], atol=1e-6)
    wide = spark.range(10).select(*[(F.col("id") * i).alias(f"c{i}") for i in range(15)])
    whole = moments.partial_moments(wide, wide.columns)
    assert "covar" not in whole._jdf.queryExecution().optimizedPlan().toString()
    assert whole.first().n == 10
    assert moments.partial_moments(wide.filter("id > 99"), wide.columns).collect() == []
