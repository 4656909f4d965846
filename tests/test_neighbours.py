import numpy as np
import pytest
from pyspark.sql import functions as F

from rankforge.operators import neighbours


def brute(rows, min_interactions=5, top=20, floor=0.1):
    vectors = {}
    for u, i, r in rows:
        vectors.setdefault(i, {})[u] = r
    vectors = {i: v for i, v in vectors.items() if len(v) >= min_interactions}
    norm = {i: np.sqrt(sum(r * r for r in v.values())) for i, v in vectors.items()}
    out = []
    for i, v in vectors.items():
        found = []
        for j, w in vectors.items():
            dot = sum(r * w[u] for u, r in v.items() if u in w)
            sim = round(dot / (norm[i] * norm[j]), 9)
            if i != j and dot > 0 and sim >= floor:
                found.append((-sim, j))
        out += [(i, j, -s, k + 1) for k, (s, j) in enumerate(sorted(found)[:top])]
    return sorted(out)


def hot_rows(seed=0, n=3000):
    """User 0 and item 0 own a third of the rows each."""
    rng = np.random.default_rng(seed)
    cells = {(0, int(i)): 0.0 for i in range(n // 3)}
    cells |= {(int(u), 0): 0.0 for u in range(n // 3)}
    while len(cells) < n:
        cells[int(rng.integers(1, 400)), int(rng.integers(1, n // 3))] = 0.0
    return [(u, i, float(rng.integers(1, 6))) for u, i in cells]


@pytest.fixture(scope="module")
def make(spark):
    return lambda rows: spark.createDataFrame(rows, "user_id long, item_id long, rating double")


@pytest.mark.parametrize("long_history,block_items", [(20, 64), (1024, 2048)])
def test_hot_user_and_item(make, long_history, block_items):
    rows = hot_rows()
    got = neighbours.item_knn(make(rows), min_interactions=2, long_history=long_history,
                              block_items=block_items).collect()
    assert sorted((r.item_id, r.neighbor_id, r.similarity, r.rank) for r in got) == \
        [pytest.approx(x) for x in brute(rows, 2)]


def test_pairs_that_share_long_histories_alone(make):
    """Every history is long: all pairs come from the banded products."""
    rng = np.random.default_rng(2)
    rows = [(u, int(i), float(rng.integers(1, 6))) for u in range(6)
            for i in rng.choice(300, size=120, replace=False)]
    got = neighbours.item_knn(make(rows), min_interactions=1, top=5, long_history=50,
                              block_items=16).collect()
    assert sorted((r.item_id, r.neighbor_id, r.similarity, r.rank) for r in got) == \
        [pytest.approx(x) for x in brute(rows, 1, 5)]


def test_rows_a_pair_stage_makes_are_linear(make):
    """Twice the users give twice the pair rows; a long history gives none."""
    rng = np.random.default_rng(3)

    def pairs(users):
        rows = [(u, int(i), 1.0) for u in range(1, users + 1)
                for i in rng.choice(5000, size=20, replace=False)]
        rows += [(0, i, 1.0) for i in range(2000)]
        x = neighbours.knn_entries(make(rows), 1)
        short, entries = neighbours.split_histories(x, 100)
        assert entries.select("user_id").distinct().collect()[0][0] == 0
        return short.alias("a").join(short.alias("b"), "user_id").filter(
            F.col("a.item_id") < F.col("b.item_id")).count()
    assert pairs(200) == 2 * pairs(100) == 200 * 20 * 19 // 2


def test_no_rows(make):
    assert neighbours.item_knn(make([])).collect() == []
    assert neighbours.item_knn(make([(1, 1, 5.0), (2, 1, 3.0)]), 1).collect() == []


def test_many_pairs_are_dealt_to_more_tasks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = sorted({(int(u), int(i)) for u, i in zip(rng.integers(0, 40, 600),
                                                    rng.integers(0, 50, 600))})
    train = spark.createDataFrame([(u, i, float(1 + (u + i) % 5)) for u, i in rows],
                                  "user_id long, item_id long, rating double")
    x = neighbours.knn_entries(train, 1)
    want = sorted(map(tuple, neighbours.short_pairs(x).collect()))
    monkeypatch.setattr(neighbours, "PAIR_ROWS", 100)
    pairs = neighbours.short_pairs(x)
    tasks = -(-sum(h * (h - 1) // 2 for h in np.bincount([u for u, _ in rows])) // 100)
    assert "hashpartitioning(i" in pairs._jdf.queryExecution().executedPlan().toString()
    assert f", {tasks})" in pairs._jdf.queryExecution().executedPlan().toString()
    got = sorted(map(tuple, pairs.collect()))
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert np.allclose([r[2:] for r in got], [r[2:] for r in want])


@pytest.mark.parametrize("long_history", [20, 1024])
@pytest.mark.parametrize("products", [50, 1 << 21])
def test_blocks_of_items_give_the_best_pairs(make, monkeypatch, long_history, products):
    """Entries of two blocks multiplied in a task, in parts or whole, with nulls and zeros."""
    monkeypatch.setattr(neighbours, "PRODUCTS", products)
    monkeypatch.setattr(neighbours, "FEW_ENTRIES", 500)
    rows = hot_rows(4)
    rows += [(None, i, 2.0) for i in range(0, 40, 3)] + [(7, None, 1.0), (401, 3, 0.0), (401, 5, 0.0)]
    train = make(rows)
    plain, blocks = (sorted(tuple(r) for r in neighbours.item_knn(
        train, min_interactions=2, top=5, long_history=long_history, few_pairs=few).collect())
        for few in (1 << 40, 0))
    assert len(blocks) > 500 and blocks == [pytest.approx(x) for x in plain]


def test_no_row_for_each_pair_is_moved(make):
    """Many pairs move packed entries alone: no shuffle of the plan is by pair before the
    products, and what leaves the tasks is bounded by ``top``, not by the pairs."""
    rng = np.random.default_rng(6)
    rows = [(u, int(i), float(rng.integers(1, 6))) for u in range(300)
            for i in rng.choice(400, 60, replace=False)]
    x = neighbours.knn_entries(make(rows), 1)
    short, entries = neighbours.split_histories(x, 1024)
    got = neighbours.block_pairs(x, short, entries, 3, 0.1, blocks=2)
    assert "hashpartitioning(i#" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.count() < 400 * 3 * 4 < neighbours.pair_rows(short) / 50
