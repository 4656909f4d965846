"""Model operators (L1-L16): scaling, baselines, selection, promotion,
mutual information, PCA, ALS and randomized SVD.

Heavy linear algebra stays distributed: sparse matrices are long tables
``(row, col, value)``, dense factors one array per key, multiplied by joins +
grouped sums; only r x r matrices (r = rank + oversampling, about 20) reach
the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankforge.functions.columns import dbl, safe_div
from rankforge.operators.neighbours import item_knn  # noqa: F401  (L12)
from rankforge.operators.packed import pack as _pack, runs as _runs, unpack as _unpack
from rankforge.operators.ranking import top_k_per_group
from rankforge.operators.scan import best_items, score_range
from rankforge.session import checkpoint_dir, written


# --- L2 / L6 -------------------------------------------------------------------
def minmax_scale(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - min) / (max - min) per column; 0 for a constant column.

    All min/max come from one aggregate row, used as a single scalar
    subquery (one scan of the input for the statistics)."""
    stats = df.agg(F.struct(*[F.min(c).cast("double").alias(f"{c}__lo") for c in cols],
                            *[F.max(c).cast("double").alias(f"{c}__hi") for c in cols])).scalar()
    out = df
    for c in cols:
        lo, hi = stats[f"{c}__lo"], stats[f"{c}__hi"]
        out = out.withColumn(f"{c}_scaled", safe_div(F.col(c) - lo, hi - lo))
    return out


def standardize(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """L2: (x - mean) / sample std, like ``StandardScaler(withMean, withStd)``."""
    stats = df.agg(F.struct(*[F.avg(c).alias(f"{c}__m") for c in cols],
                            *[F.stddev_samp(c).alias(f"{c}__s") for c in cols])).scalar()
    out = df
    for c in cols:
        m, sd = stats[f"{c}__m"], stats[f"{c}__s"]
        out = out.withColumn(f"{c}_std", safe_div(F.col(c) - m, sd))
    return out


# --- G8 / L16 -------------------------------------------------------------------
def baseline_predictions(train: DataFrame, test: DataFrame) -> DataFrame:
    """Predictions of four baselines on the test rows, long format
    (model, ord, user_id, item_id, rating, pred), clipped to [1, 5]."""
    from rankforge.functions.columns import clip
    mu = train.agg(F.avg("rating")).scalar()
    ub = train.groupBy("user_id").agg(F.avg("rating").alias("_um"))
    ib = train.groupBy("item_id").agg(F.avg("rating").alias("_im"))
    j = test.select("user_id", "item_id", "rating").join(ub, "user_id", "left") \
        .join(ib, "item_id", "left")
    preds = {
        "global_mean": mu,
        "item_mean": F.coalesce(F.col("_im"), mu),
        "user_mean": F.coalesce(F.col("_um"), mu),
        "bias": mu + F.coalesce(F.col("_um") - mu, dbl(0)) + F.coalesce(F.col("_im") - mu, dbl(0)),
    }
    arr = F.array(*[F.struct(F.lit(name).alias("model"), F.lit(i + 1).alias("ord"),
                             clip(p, 1.0, 5.0).alias("pred"))
                    for i, (name, p) in enumerate(preds.items())])
    return j.select("user_id", "item_id", "rating", F.explode(arr).alias("m")).select(
        "m.model", "m.ord", "user_id", "item_id", "rating", "m.pred")


def model_runs(preds: DataFrame) -> DataFrame:
    """RMSE per model run; a run without rows is marked failed."""
    return preds.groupBy("model", "ord").agg(
        F.sqrt(F.avg(F.pow(F.col("rating") - F.col("pred"), 2))).alias("rmse"),
        F.count(F.lit(1)).alias("n")).withColumn(
        "status", F.when(F.col("n") > 0, "success").otherwise("failed"))


def best_model(runs: DataFrame) -> DataFrame:
    """Arg-min RMSE over successful runs; first run wins ties.  An empty
    result (no successful run) is the error case: nothing to promote."""
    ok = runs.filter(F.col("status") == "success")
    return ok.agg(F.min_by("model", F.struct("rmse", "ord")).alias("best_model"),
                  F.min("rmse").alias("rmse"),
                  F.count(F.lit(1)).alias("n_candidates"))


def promotion(versions: DataFrame) -> DataFrame:
    """Walk versions in order; a version is promoted when its RMSE is
    strictly below the production RMSE (the first is always promoted).  The
    last promoted version is 'production', earlier promoted ones
    'archived', the rest 'staging'.  Production RMSE after each step is the
    running minimum, so one ordered window suffices (versions are few)."""
    w = Window.orderBy("version").rowsBetween(Window.unboundedPreceding, -1)
    v = versions.withColumn("_prev_min", F.min("rmse").over(w))
    v = v.withColumn("promoted", F.col("_prev_min").isNull() | (F.col("rmse") < F.col("_prev_min")))
    last = F.max(F.when(F.col("promoted"), F.col("version"))).over(Window.partitionBy())
    return v.select("version", "model", "rmse", "promoted",
                    F.when(F.col("version") == last, "production")
                    .when(F.col("promoted"), "archived").otherwise("staging").alias("stage"))


# --- L15 ------------------------------------------------------------------------
def mutual_information(df: DataFrame, feature_cols: Sequence[str], label_col: str,
                       k: int = 100) -> DataFrame:
    """MI(feature; label) of discrete features, top ``k`` by MI.

    Unpivot to (feature, value, label) and count; every count is a grouped
    aggregation, combined map-side."""
    long = df.select(label_col, F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value"))
        for c in feature_cols])).alias("f")).select("f.feature", "f.value",
                                                    F.col(label_col).alias("y"))
    # One pass over the input: the joint counts.  Marginals and n are sums
    # over the (small) joint table, per feature.
    joint = long.groupBy("feature", "value", "y").agg(F.count(F.lit(1)).alias("nxy"))
    j = (joint.withColumn("nx", F.sum("nxy").over(Window.partitionBy("feature", "value")))
         .withColumn("ny", F.sum("nxy").over(Window.partitionBy("feature", "y")))
         .withColumn("n", F.sum("nxy").over(Window.partitionBy("feature"))))
    n = F.col("n")
    term = (F.col("nxy") / n) * F.log((F.col("nxy") * n) / (F.col("nx") * F.col("ny")))
    mi = j.groupBy("feature").agg(F.sum(term).alias("mi"))
    return top_k_per_group(mi.withColumn("_g", F.lit(0)), ["_g"],
                           [F.col("mi").desc(), F.col("feature")], k).drop("_g")


# --- L1-L5 ----------------------------------------------------------------------
def pca_fit_transform(df: DataFrame, cols: Sequence[str]):
    """Assemble (skip NULL rows), standardise, PCA(k = max(1, n*0.33))."""
    from rankforge.streaming.jobs import feature_pipeline
    model = feature_pipeline(list(cols)).fit(df)
    return model, model.transform(df)


def explained_variance(spark: SparkSession, model, target: float = 0.95) -> DataFrame:
    """Per-component and cumulative explained variance, and whether the
    component count reaches ``target`` (k x k numbers from the fitted model)."""
    ev = [float(v) for v in model.stages[-1].explainedVariance.toArray()]
    cum = np.cumsum(ev).tolist()
    rows = [(i + 1, ev[i], cum[i], cum[i] >= target) for i in range(len(ev))]
    return spark.createDataFrame(rows, "component int, explained_variance double, "
                                       "cumulative double, reaches_target boolean")


# --- L8 / L9 --------------------------------------------------------------------
def als_fit(train: DataFrame, rank: int = 10, seed: int = 42, nonnegative: bool = True,
            max_iter: int = 10, reg: float = 0.1):
    """Non-negative factorisation of observed ratings (ALS).  Unlike a
    zero-filled NMF, only observed cells are fitted.

    Item factors are checkpointed in every step, so what a step has shuffled goes
    with the next one; else the files of all steps lie on the disks together."""
    from pyspark.ml.recommendation import ALS
    checkpoint_dir(train.sparkSession)           # without a folder ALS keeps all files
    als = ALS(userCol="user_id", itemCol="item_id", ratingCol="rating", rank=rank, seed=seed,
              nonnegative=nonnegative, maxIter=max_iter, regParam=reg,
              coldStartStrategy="drop", checkpointInterval=1)
    data = train.select(F.col("user_id").cast("int"), F.col("item_id").cast("int"), "rating")
    return als.fit(data)


def als_factors(model) -> tuple[DataFrame, DataFrame]:
    """(user_id, f) and (item_id, f) of a fitted ALS model."""
    def table(df: DataFrame, key: str) -> DataFrame:
        return df.select(F.col("id").cast("long").alias(key),
                         F.col("features").cast("array<double>").alias("f"))
    return table(model.userFactors, "user_id"), table(model.itemFactors, "item_id")


def als_recommend(model, users: DataFrame, seen: DataFrame, n: int) -> DataFrame:
    """Top-``n`` unseen items per user of a fitted ALS model."""
    from rankforge.operators.factors import pruned_top_n
    return pruned_top_n(*als_factors(model), users, seen, n)


def _block_scores(user_f: DataFrame, item_f: DataFrame, users: DataFrame, seen: DataFrame, fn,
                  schema: str, users_per_block: int, items_per_block: int) -> DataFrame:
    """``fn(users, items, scores)`` over blocks of users by blocks of items.

    Users and items are dealt to blocks by hash; one group holds one block of
    each and the seen pairs between them, so its score matrix has a fixed size
    bound, and a user (or item) with a long history is spread over all blocks
    of the other side.  Seen cells are -inf.  Rows moved: users x item blocks
    + items x user blocks + seen pairs.
    """
    u = user_f.join(users.select("user_id").distinct(), "user_id", "left_semi")
    n_items, n_users = item_f.count(), u.count()
    ub = max(1, math.ceil(n_users / users_per_block))
    ib = max(1, math.ceil(n_items / items_per_block))
    a = F.pmod(F.xxhash64("user_id"), F.lit(ub)).cast("int").alias("a")
    b = F.pmod(F.xxhash64("item_id"), F.lit(ib)).cast("int").alias("b")
    none = F.lit(None).cast("long")
    all_a = F.explode(F.sequence(F.lit(0), F.lit(ub - 1))).alias("a")
    all_b = F.explode(F.sequence(F.lit(0), F.lit(ib - 1))).alias("b")
    cells = (seen.select("user_id", "item_id").distinct()
             .join(u.select("user_id"), "user_id", "left_semi")
             .select(a, b, "user_id", "item_id", F.lit(None).cast("array<double>").alias("f")))
    rows = (u.select(a, all_b, "user_id", none.alias("item_id"), "f")
            .unionByName(item_f.select(all_a, b, none.alias("user_id"), "item_id", "f"))
            .unionByName(cells))

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        has_f = pdf["f"].notna()
        left = pdf[has_f & pdf["user_id"].notna()].sort_values("user_id")
        right = pdf[has_f & pdf["item_id"].notna()].sort_values("item_id")
        uid, iid = left["user_id"].to_numpy(np.int64), right["item_id"].to_numpy(np.int64)
        if not len(uid) or not len(iid):
            return fn(uid, iid, np.zeros((len(uid), len(iid))))
        scores = np.stack(left["f"].to_list()) @ np.stack(right["f"].to_list()).T
        pairs = pdf[~has_f]
        su, si = pairs["user_id"].to_numpy(np.int64), pairs["item_id"].to_numpy(np.int64)
        known = np.isin(si, iid)             # seen items may have no factors
        scores[np.searchsorted(uid, su[known]), np.searchsorted(iid, si[known])] = -np.inf
        return fn(uid, iid, scores)

    return rows.groupBy("a", "b").applyInPandas(score, schema)


def factor_top_n(user_f: DataFrame, item_f: DataFrame, users: DataFrame, seen: DataFrame, n: int,
                 users_per_block: int = 1024, items_per_block: int = 4096) -> DataFrame:
    """Exact top-``n`` unseen items per user by factor dot products.

    ``user_f`` (user_id, f) and ``item_f`` (item_id, f) hold arrays of equal
    length.  Each block drops seen items itself and emits its ``n`` best per
    user (and ties with the n-th), which one ranking per user merges.  Scores
    are rounded to 9 digits, so equal ones tie (smaller item id first)
    whatever the blocks.  Users without factors get no row.
    """
    def best(uid: np.ndarray, iid: np.ndarray, scores: np.ndarray) -> pd.DataFrame:
        scores = np.round(scores, 9)
        keep = scores > -np.inf
        if 0 < n < scores.shape[1]:
            keep &= scores >= np.partition(scores, -n, axis=1)[:, [-n]]
        x, y = np.nonzero(keep)
        return pd.DataFrame({"user_id": uid[x], "item_id": iid[y], "score": scores[x, y]})

    rows = _block_scores(user_f, item_f, users, seen, best,
                         "user_id long, item_id long, score double",
                         users_per_block, items_per_block)
    return top_k_per_group(rows, ["user_id"], [F.col("score").desc(), F.col("item_id")], n,
                           salt_col="item_id")


def blended_top_n(first: tuple[DataFrame, DataFrame], second: tuple[DataFrame, DataFrame],
                  users: DataFrame, seen: DataFrame, n: int) -> DataFrame:
    """L10 over two factor models: each model's scores are min-max scaled per
    user over all unseen items and averaged; exact top-``n``.

    A scaled score is linear in the item's factors, so the blend is one dot
    product of joined arrays: [w1 * u1, w2 * u2, offset] and [i1, i2, 1].  A
    model that scores all items of a user alike adds 1 (as min-max does for a
    single value); a model that lacks the user or the item adds 0.
    """
    def width(df: DataFrame) -> int:
        row = df.select(F.size("f").alias("w")).first()
        return row["w"] if row else 0

    def scaled(model, k: int) -> DataFrame:
        """Two arrays for each user: scaled factors, and the offset for items this model has."""
        user_f, item_f = model
        r = score_range(user_f, item_f, users, seen)
        gap = F.col("hi") - F.col("lo")
        w = F.when(gap > 0, dbl(0.5) / gap).otherwise(dbl(0))
        off = F.when(gap > 0, -F.col("lo") * w).otherwise(dbl(0.5))
        return user_f.join(r, "user_id").select(
            "user_id", F.concat(F.transform("f", lambda x: x * w), F.array(off)).alias(f"f{k}"))

    def items_of(model, k: int) -> DataFrame:
        return model[1].select("item_id", F.concat("f", F.array(dbl(1))).alias(f"f{k}"))

    zeros = {k: F.array_repeat(dbl(0), width(m[0]) + 1) for k, m in ((1, first), (2, second))}
    joined = F.concat(F.coalesce("f1", zeros[1]), F.coalesce("f2", zeros[2])).alias("f")
    u = scaled(first, 1).join(scaled(second, 2), "user_id", "full_outer").select("user_id", joined)
    i = items_of(first, 1).join(items_of(second, 2), "item_id", "full_outer").select(
        "item_id", joined)
    return best_items(written(u, "blend-users"), written(i, "blend-items"), users, seen, n)


# --- L7 -------------------------------------------------------------------------
def _gauss(item, j, seed: int):
    """Deterministic standard normal per (item, j) by Box-Muller on two
    hash uniforms: independent of partitioning and task retries."""
    def unif(salt):
        h = F.pmod(F.xxhash64(item, j, F.lit(seed), F.lit(salt)), F.lit(2147483647))
        return (h.cast("double") + dbl(0.5)) / dbl(2147483647.0)
    return F.sqrt(dbl(-2.0) * F.log(unif(1))) * F.cos(dbl(2 * math.pi) * unif(2))


def _gram(m: DataFrame, r: int) -> np.ndarray:
    """Sum of the r x r outer products of all arrays ``f``: one partial matrix
    per task, summed by position."""
    def partial(batches):
        total = np.zeros((r, r))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy().reshape(-1, r)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(r * r, dtype=np.int32)), pa.array(total.ravel())], ["at", "g"])
    rows = (m.select("f").mapInArrow(partial, "at int, g double")
            .groupBy("at").agg(F.sum("g").alias("g")).collect())          # r*r values
    out = np.zeros(r * r)
    for x in rows:
        out[x["at"]] = x["g"]
    return out.reshape(r, r)


def _times_small(f: Column, mat: np.ndarray) -> Column:
    """Array column times a small r x c matrix."""
    @F.arrow_udf("array<double>")
    def times(rows: pa.Array) -> pa.Array:
        x = rows.flatten().to_numpy().reshape(-1, mat.shape[0]) @ mat
        ends = np.arange(len(x) + 1, dtype=np.int32) * mat.shape[1]
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(x.ravel()))
    return times(f)


def _orthonormal(y: DataFrame, r: int) -> DataFrame:
    """Cholesky-QR: Q = Y R^-1 with R^T R = Y^T Y (r x r on the driver)."""
    g = _gram(y, r)
    g = g + np.eye(r) * 1e-10 * max(1.0, np.trace(g))
    chol = np.linalg.cholesky(g)            # g = L L^T, R = L^T
    return y.withColumn("f", _times_small(F.col("f"), np.linalg.inv(chol.T)))


#: Blocks of output keys of a sparse product, at least, and bytes of sums that one holds.
SUM_BLOCKS, SUM_BYTES = 3, 256 << 20
#: Tiles of factors that stream past each block.
FACTOR_TILES = 64

_STREAM = "block int, tile int, kind int, none boolean, a binary, b binary, c binary"


def _stream_rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32(), pa.int32(), pa.bool_(), *[pa.binary()] * 3]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)],
        names=["block", "tile", "kind", "none", "a", "b", "c"])


def _dealt(a: DataFrame, out: str, by: str, blocks: int) -> DataFrame:
    """The entries of ``a`` (out, by, v) for products that sum over ``by``: packed
    pieces by (block of out, tile of by), and the keys of each block.  Entries
    without ``by`` meet no factor; those without ``out`` are one key, marked ``none``."""
    a = a.filter(F.col(by).isNotNull()).select(
        F.pmod(F.xxhash64(out), F.lit(blocks)).cast("int").alias("block"),
        F.pmod(F.xxhash64(by), F.lit(FACTOR_TILES)).cast("int").alias("tile"),
        F.col(out).isNull().alias("none"),
        F.coalesce(F.col(out).cast("long"), F.lit(0).cast("long")).alias("out"),
        F.col(by).cast("long").alias("by"),
        F.coalesce(F.col("v").cast("double"), dbl(0)).alias("v"))

    def pack(batches):
        for batch in batches:
            block, tile, none, keys, others, v = (
                batch.column(i).to_numpy(zero_copy_only=False) for i in range(6))
            rows = [(block[s][0], tile[s][0], 2, none[s][0], _pack(np.diff(keys[s], prepend=0)),
                     _pack(others[s]), _pack(v[s])) for s in _runs(block, tile, none)]
            if rows:
                yield _stream_rows(rows)

    def pack_keys(batches):
        for batch in batches:
            block, keys = (batch.column(i).to_numpy() for i in range(2))
            rows = [(block[s][0], -1, 0, False, _pack(np.diff(keys[s], prepend=0)), None, None)
                    for s in _runs(block)]
            if rows:
                yield _stream_rows(rows)
    entries = (a.repartition("block", "tile").sortWithinPartitions("block", "tile", "none", "out")
               .mapInArrow(pack, _STREAM))
    keys = (a.filter(~F.col("none")).select("block", "out").distinct()
            .sortWithinPartitions("block", "out").mapInArrow(pack_keys, _STREAM))
    return entries.unionByName(keys)


def _factor_rows(m: DataFrame, by: str, blocks: int, r: int) -> DataFrame:
    """Factors (by, f) packed by tile, once for each block."""
    def pack(batches):
        for batch in batches:
            tile, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            f = batch.column(2).flatten().to_numpy().reshape(-1, r)
            order = np.argsort(tile, kind="stable")
            tile, ids, f = tile[order], ids[order], f[order]
            rows = [(0, tile[s][0], 1, False, _pack(ids[s]), f[s].tobytes(), None)
                    for s in _runs(tile)]
            if rows:
                yield _stream_rows(rows)
    packed = m.filter(F.col(by).isNotNull()).select(
        F.pmod(F.xxhash64(by), F.lit(FACTOR_TILES)).cast("int").alias("tile"),
        F.col(by).cast("long").alias("by"), "f").mapInArrow(pack, _STREAM)
    return packed.withColumn("block", F.explode(F.lit(list(range(blocks)))))


def sparse_product(dealt: DataFrame, m: DataFrame, out: str, by: str, blocks: int,
                   r: int) -> DataFrame:
    """(out, f): for each key the sum of v times the factors ``m`` (by, f) of its entries.

    Every block of output keys holds its sums (``SUM_BYTES`` or less), and the
    factors stream past, tile by tile, so a factor moves once for each block, not
    once for each entry.
    """
    def multiply(batches):
        keys = total = f = ids = none = None
        block, tile, pieces, lists = None, None, [], []

        def rows():
            known = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            sums = total if total is not None else np.zeros((len(known), r))
            for i in range(0, len(known), 4096):
                yield batch_of(pa.array(known[i:i + 4096]), sums[i:i + 4096])
            if none is not None:
                yield batch_of(pa.array([None], pa.int64()), none[None])

        def batch_of(key, sums):
            ends = np.arange(len(sums) + 1, dtype=np.int32) * r
            return pa.RecordBatch.from_arrays(
                [key, pa.ListArray.from_arrays(pa.array(ends), pa.array(sums.ravel()))], [out, "f"])
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if row[0] != block:
                    if block is not None:
                        yield from rows()
                    block, tile, keys, total, none, lists, pieces = row[0], None, [], None, None, [], []
                if row[2] == 0:
                    lists.append(np.cumsum(_unpack(row[4]).astype(np.int64)))
                    continue
                if total is None:
                    keys = [np.sort(np.concatenate(lists))] if lists else []
                    total = np.zeros((len(keys[0]) if keys else 0, r))
                if row[1] != tile:
                    tile, pieces, ids = row[1], [], None
                if row[2] == 1:
                    pieces.append((_unpack(row[4]).astype(np.int64),
                                   np.frombuffer(row[5]).reshape(-1, r)))
                    continue
                if ids is None and pieces:
                    ids = np.concatenate([p[0] for p in pieces])
                    order = np.argsort(ids)
                    ids, f = ids[order], np.concatenate([p[1] for p in pieces])[order]
                if ids is None:
                    continue
                own = np.cumsum(_unpack(row[4]).astype(np.int64))
                at = np.minimum(np.searchsorted(ids, others := _unpack(row[5]).astype(np.int64)),
                                len(ids) - 1)
                v = np.where(ids[at] == others, _unpack(row[6]).astype(np.float64), 0.0)
                cells = f[at] * v[:, None]
                firsts = np.flatnonzero(np.diff(own, prepend=own[0] - 1))
                if row[3]:
                    none = cells.sum(0) + (0 if none is None else none)
                else:
                    total[np.searchsorted(keys[0], own[firsts])] += np.add.reduceat(cells, firsts)
        if block is not None:
            yield from rows()
    both = dealt.unionByName(_factor_rows(m, by, blocks, r))
    return (both.repartitionById(blocks, "block").sortWithinPartitions("block", "tile", "kind")
            .mapInArrow(multiply, f"`{out}` long, f array<double>"))


def randomized_svd(spark: SparkSession, a: DataFrame, k: int = 10, oversample: int = 10,
                   n_iter: int = 2, seed: int = 42, checkpoint: bool = True):
    """Truncated SVD of the zero-filled user x item matrix.

    ``a``: (user_id, item_id, v).  Randomized range finder with ``n_iter``
    power iterations.  A dense factor is one row per key with an array ``f``
    of r = k + oversample values.  ``a`` is dealt once for either side of the
    products (see ``sparse_product``).  ``checkpoint`` writes both and each
    product to the shared folder (it is read twice: for its Gram matrix and
    for the next step).  Returns user factors U*S (user_id, f),
    item factors V (item_id, f) and the singular values.
    """
    r = k + oversample
    omega = a.select("item_id").distinct().select(
        "item_id", F.transform(F.sequence(F.lit(0), F.lit(r - 1)),
                               lambda j: _gauss(F.col("item_id"), j, seed)).alias("f"))

    sizes = a.agg(F.approx_count_distinct("user_id").alias("user_id"),
                  F.approx_count_distinct("item_id").alias("item_id")).first()
    dealt = {}
    for out, by in (("user_id", "item_id"), ("item_id", "user_id")):
        blocks = max(SUM_BLOCKS, math.ceil(sizes[out] * r * 8 / SUM_BYTES))
        rows = _dealt(a, out, by, blocks)
        dealt[out] = written(rows, "svd-cells") if checkpoint else rows, blocks

    def product(m: DataFrame, key: str, out: str) -> DataFrame:
        p = sparse_product(dealt[out][0], m, out, key, dealt[out][1], r)
        return written(p, "svd") if checkpoint else p

    y = _orthonormal(product(omega, "item_id", "user_id"), r)
    for _ in range(n_iter):
        z = _orthonormal(product(y, "user_id", "item_id"), r)
        y = _orthonormal(product(z, "item_id", "user_id"), r)
    b = product(y, "user_id", "item_id")     # B^T: items x r  (B = Q^T A)
    vals, vecs = np.linalg.eigh(_gram(b, r))
    order = np.argsort(vals)[::-1][:k]
    s = np.sqrt(np.clip(vals[order], 0, None))
    ub = vecs[:, order]                      # r x k
    user_f = y.withColumn("f", _times_small(F.col("f"), ub * s))           # Q U_B S
    inv_s = np.where(s > 0, 1.0 / np.where(s > 0, s, 1.0), 0.0)
    item_f = b.withColumn("f", _times_small(F.col("f"), ub * inv_s))       # B^T U_B S^-1
    return user_f, item_f, s.tolist()
