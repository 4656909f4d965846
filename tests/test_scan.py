import numpy as np
import pytest

from rankforge.operators import ranking, scan


def table(spark, x, key):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)],
                                 f"{key} long, f array<double>")


def case(spark):
    rng = np.random.default_rng(5)
    u, v = rng.normal(size=(60, 4)), np.round(rng.normal(size=(500, 4)), 1)
    seen = [(a, int(b)) for a in range(60) for b in rng.choice(500, 40, replace=False)]
    seen += [(3, b) for b in range(500)] + [(4, b) for b in range(497)]
    return u, v, set(seen), spark.createDataFrame(seen + seen[:5] + [(None, 1), (2, None)],
                                                  "user_id long, item_id long")


def test_scan_equals_brute_force(spark):
    u, v, pairs, seen = case(spark)
    uf, vf = table(spark, u, "user_id"), table(spark, v, "item_id")
    s = u @ v.T
    for a, b in pairs:
        s[a, b] = np.nan
    want = []
    for a in range(60):
        free = [b for b in range(500) if not np.isnan(s[a, b])]
        free.sort(key=lambda b: (-round(s[a, b], 9), b))
        want += [(a, b, k + 1) for k, b in enumerate(free[:7])]
    got = scan.best_items(uf, vf, uf.select("user_id"), seen, 7, users_per_block=16, tile=32)
    assert sorted((r.user_id, r.item_id, r["rank"]) for r in got.collect()) == sorted(want)
    found = {r.user_id: (r.lo, r.hi) for r in
             scan.score_range(uf, vf, uf.select("user_id"), seen).collect()}
    assert set(found) == set(range(60)) - {3}
    for a, (lo, hi) in found.items():
        assert lo == pytest.approx(np.nanmin(s[a])) and hi == pytest.approx(np.nanmax(s[a]))


def test_tiles_out_of_reach_are_not_multiplied(monkeypatch):
    rng = np.random.default_rng(2)
    u, v = np.abs(rng.normal(size=(300, 6))), np.abs(rng.normal(size=(8000, 6)))
    cells, plain = [], scan._Users.scores

    def counted(self, some, ids, *rest):
        cells.append(len(some) * len(ids))
        return plain(self, some, ids, *rest)
    monkeypatch.setattr(scan._Users, "scores", counted)
    best = scan.Best(np.arange(300), u, 10)
    parts = scan.near_parts(v, 64)
    assert sorted(np.concatenate(parts)) == list(range(8000)) and max(map(len, parts)) <= 64
    norm = [float(np.sqrt((v[p] ** 2).sum(1)).max()) for p in parts]
    for k in np.argsort(norm)[::-1]:
        best.meet(parts[k], v[parts[k]], norm[k], np.zeros((0, 2), np.int64))
    best.settle()
    assert np.allclose(best.s, -np.sort(-np.round(u @ v.T, 9), 1)[:, :10])
    assert sum(cells) < 0.5 * 300 * 8000


def test_blend_scan_equals_threshold_blend(spark):
    rng = np.random.default_rng(6)
    a, b = (spark.createDataFrame([(i, float(x)) for i, x in enumerate(rng.integers(0, 9, 200))],
                                  "item_id long, score double") for _ in range(2))
    seen = [(u, int(i)) for u in range(9) for i in rng.choice(200, 20 * u, replace=False)]
    seen = spark.createDataFrame(seen, "user_id long, item_id long")
    users = spark.createDataFrame([(u,) for u in range(9)] + [(1,)], "user_id long")
    got, want = (sorted((r.user_id, r.item_id, r["rank"], round(r.score, 8)) for r in x.collect())
                 for x in (ranking.blend_scan(users, seen, a, b, 5), ranking.threshold_blend(
                     users, seen, ranking.item_ranking(a), ranking.item_ranking(b), 5)))
    assert got == want


def test_a_row_without_an_item_counts_for_the_range(spark):
    a = spark.createDataFrame([(1, 2.0), (2, 4.0), (None, 10.0)], "item_id long, score double")
    users = spark.createDataFrame([(1,)], "user_id long")
    seen = spark.createDataFrame([], "user_id long, item_id long")
    got = ranking.blend_scan(users, seen, a, a, 5).collect()
    assert sorted((r["rank"], r.item_id, r.score) for r in got) == [(1, 2, 0.25), (2, 1, 0.0)]


def test_seen_pairs_never_meet_the_items(spark, monkeypatch):
    """Pairs go to the block of their user, once and packed: no join with the items' tiles;
    blocks grow in number with the pairs."""
    u, v, pairs, seen = case(spark)
    uf, vf = table(spark, u, "user_id"), table(spark, v, "item_id")
    want = scan.best_items(uf, vf, uf.select("user_id"), seen, 7)
    plan = want._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "hashpartitioning" not in plan
    monkeypatch.setattr(scan, "PAIRS", 100)
    monkeypatch.setattr(scan, "PIECE", 64)
    got = scan.best_items(uf, vf, uf.select("user_id"), seen, 7)
    assert str(-(-seen.dropna().count() // 100)) in str(got._jdf.queryExecution().optimizedPlan())
    assert sorted(got.collect()) == sorted(want.collect())


def test_a_few_users_of_many_with_seen_pairs(spark):
    u, v, pairs, seen = case(spark)
    uf, vf = table(spark, u, "user_id"), table(spark, v, "item_id")
    some = spark.createDataFrame([(5,), (9,), (9,), (None,), (999,)], "user_id long")
    every = scan.best_items(uf, vf, uf.select("user_id"), seen, 7).collect()
    got = scan.best_items(uf, vf, some, seen, 7).collect()
    assert sorted(got) == sorted(r for r in every if r.user_id in (5, 9)) and len(got) == 14
