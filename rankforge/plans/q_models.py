"""Registered queries: model operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankforge.operators import factors as FA
from rankforge.operators import features
from rankforge.operators import models as MD
from rankforge.operators import moments as MO
from rankforge.operators import metrics as M
from rankforge.operators import profiles
from rankforge.plans import sql_prelude as P
from rankforge.plans.canonical import TOP_N, Canonical
from rankforge.plans.registry import register
from rankforge.session import written
from rankforge.sources.tables import Tables, interactions, items, users
from rankforge.streaming.jobs import derive, feature_columns


@register("minmax", ops="L6", doubles=("item_price_scaled", "item_size_scaled"), sql="""
SELECT p_partkey AS item_id,
  CASE WHEN max(p_retailprice) OVER () > min(p_retailprice) OVER ()
       THEN (p_retailprice - min(p_retailprice) OVER ())
            / (max(p_retailprice) OVER () - min(p_retailprice) OVER ()) ELSE 0.0 END
    AS item_price_scaled,
  CASE WHEN max(p_size) OVER () > min(p_size) OVER ()
       THEN (p_size - min(p_size) OVER ()) / (max(p_size) OVER () - min(p_size) OVER ())
       ELSE 0.0 END AS item_size_scaled
FROM part""")
def minmax(spark, root):
    it = items(Tables(spark, root))
    return MD.minmax_scale(it, ["item_price", "item_size"]).select(
        "item_id", "item_price_scaled", "item_size_scaled")


@register("scaled", ops="L2", doubles=("item_price_std", "item_size_std"), sql="""
SELECT p_partkey AS item_id,
  (p_retailprice - avg(p_retailprice) OVER ()) / stddev_samp(p_retailprice) OVER ()
    AS item_price_std,
  (p_size - avg(p_size) OVER ()) / stddev_samp(p_size) OVER () AS item_size_std
FROM part""")
def scaled(spark, root):
    it = items(Tables(spark, root))
    return MD.standardize(it, ["item_price", "item_size"]).select(
        "item_id", "item_price_std", "item_size_std")


RUNS_SQL = P.FULL + """,
preds AS (
  SELECT 'global_mean' AS model, 1 AS ord, t.rating,
         greatest(1.0::DOUBLE, least(5.0::DOUBLE, mu.mu)) AS pred
  FROM test t CROSS JOIN mu
  UNION ALL
  SELECT 'item_mean', 2, t.rating, greatest(1.0::DOUBLE, least(5.0::DOUBLE, coalesce(ib.im, mu.mu)))
  FROM test t CROSS JOIN mu LEFT JOIN ib ON t.item_id = ib.item_id
  UNION ALL
  SELECT 'user_mean', 3, t.rating, greatest(1.0::DOUBLE, least(5.0::DOUBLE, coalesce(ub.um, mu.mu)))
  FROM test t CROSS JOIN mu LEFT JOIN ub ON t.user_id = ub.user_id
  UNION ALL
  SELECT 'bias', 4, rating, pred FROM scored),
runs AS (SELECT model, ord, sqrt(avg(pow(rating - pred, 2))) AS rmse, count(*) AS n,
                CASE WHEN count(*) > 0 THEN 'success' ELSE 'failed' END AS status
         FROM preds GROUP BY model, ord)"""


def _runs(spark, root):
    c = Canonical(spark, root)
    return MD.model_runs(MD.baseline_predictions(c.train, c.test))


@register("model_runs", ops="L14,M10", doubles=("rmse",),
          sql=RUNS_SQL + " SELECT model, ord, rmse, n, status FROM runs")
def model_runs(spark, root):
    return _runs(spark, root)


@register("best_model", ops="G8", doubles=("rmse",), sql=RUNS_SQL + """
SELECT arg_min(model, (rmse, ord)) AS best_model, min(rmse) AS rmse, count(*) AS n_candidates
FROM runs WHERE status = 'success'""")
def best_model(spark, root):
    return MD.best_model(_runs(spark, root))


@register("promote", ops="L16", doubles=("rmse",), sql=RUNS_SQL + """,
p AS (SELECT ord AS version, model, rmse,
             (min(rmse) OVER (ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
               IS NULL
             OR rmse < min(rmse) OVER (ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING
                                                          AND 1 PRECEDING) AS promoted
      FROM runs)
SELECT version, model, rmse, promoted,
       CASE WHEN version = (SELECT max(version) FROM p WHERE promoted) THEN 'production'
            WHEN promoted THEN 'archived' ELSE 'staging' END AS stage
FROM p""")
def promote(spark, root):
    runs = _runs(spark, root).filter(F.col("status") == "success")
    return MD.promotion(runs.select(F.col("ord").alias("version"), "model", "rmse"))


MI_FEATURES = ("user_segment", "user_region", "item_brand", "size_bucket", "price_bucket",
               "interaction_type")


@register("mutual_info", ops="L15", doubles=("mi",), sql=P.INTERACTIONS_ONLY + """,
e AS (SELECT i.interaction_type, c.c_mktsegment AS user_segment, r.r_name AS user_region,
             p.p_brand AS item_brand, CAST(p.p_size // 10 AS VARCHAR) AS size_bucket,
             CAST(CAST(floor(p.p_retailprice / 500.0) AS BIGINT) AS VARCHAR) AS price_bucket,
             i.rating >= 4.0 AS y
      FROM inter i LEFT JOIN customer c ON i.user_id = c.c_custkey
      LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
      LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
      LEFT JOIN part p ON i.item_id = p.p_partkey),
l AS (UNPIVOT (SELECT CAST(y AS VARCHAR) AS y, user_segment, user_region, item_brand,
                      size_bucket, price_bucket, interaction_type FROM e)
      ON user_segment, user_region, item_brand, size_bucket, price_bucket, interaction_type
      INTO NAME feature VALUE value),
nn AS (SELECT count(*) AS n FROM e),
j AS (SELECT feature, value, y, count(*) AS nxy FROM l GROUP BY ALL),
px AS (SELECT feature, value, count(*) AS nx FROM l GROUP BY ALL),
py AS (SELECT feature, y, count(*) AS ny FROM l GROUP BY ALL),
mi AS (SELECT j.feature, sum(nxy / nn.n * ln(nxy * nn.n / (nx * ny))) AS mi
       FROM j JOIN px USING (feature, value) JOIN py USING (feature, y) CROSS JOIN nn
       GROUP BY j.feature)
SELECT feature, mi, CAST(row_number() OVER (ORDER BY mi DESC, feature) AS INTEGER) AS rank
FROM mi QUALIFY rank <= 100""")
def mutual_info(spark, root):
    t = Tables(spark, root)
    e = interactions(t).join(users(t), "user_id", "left").join(items(t), "item_id", "left")
    e = e.select("interaction_type", "user_segment", "user_region", "item_brand",
                 F.floor(F.col("item_size") / 10).cast("string").alias("size_bucket"),
                 F.floor(F.col("item_price") / 500.0).cast("string").alias("price_bucket"),
                 (F.col("rating") >= 4.0).cast("string").alias("y"))
    return MD.mutual_information(e, MI_FEATURES, "y", 100)


@register("item_knn", ops="L12", doubles=("similarity",), sql=P.SPLIT_BASE + """,
cnt AS (SELECT item_id, sqrt(sum(rating * rating)) AS norm FROM train GROUP BY item_id
        HAVING count(*) >= 5),
x AS (SELECT t.user_id, t.item_id, t.rating FROM train t JOIN cnt USING (item_id)),
co AS (SELECT a.item_id AS i, b.item_id AS j, sum(a.rating * b.rating) AS dot
       FROM x a JOIN x b ON a.user_id = b.user_id AND a.item_id < b.item_id GROUP BY 1, 2),
s AS (SELECT i, j, round(dot / (ci.norm * cj.norm), 9) AS sim
      FROM co JOIN cnt ci ON ci.item_id = i JOIN cnt cj ON cj.item_id = j),
b AS (SELECT i, j, sim FROM s UNION ALL SELECT j, i, sim FROM s)
SELECT i AS item_id, j AS neighbor_id, sim AS similarity,
       CAST(row_number() OVER (PARTITION BY i ORDER BY sim DESC, j) AS INTEGER) AS rank
FROM b WHERE sim >= 0.1 QUALIFY rank <= 20""")
def item_knn(spark, root):
    return MD.item_knn(Canonical(spark, root).train)


@register("pca_features", ops="L1,L2,L3,L4")
def pca_features(spark, root):
    """Assemble -> standardise -> PCA(2) over enriched interactions; rows-only
    (component signs are arbitrary)."""
    t = Tables(spark, root)
    e = derive(interactions(t)).join(users(t), "user_id", "left").join(items(t), "item_id",
                                                                       "left")
    # Read three times, by the two fits and the projection; joined once.
    e = written(e.select("user_id", "item_id", *feature_columns()), "pca-rows")
    _, out = MD.pca_fit_transform(e, feature_columns())
    from pyspark.ml.functions import vector_to_array
    arr = vector_to_array("pca_features")
    return out.select("user_id", "item_id", arr[0].alias("pc1"), arr[1].alias("pc2"))


@register("pca_variance", ops="L5")
def pca_variance(spark, root):
    t = Tables(spark, root)
    e = derive(interactions(t)).join(users(t), "user_id", "left").join(items(t), "item_id",
                                                                       "left")
    e = written(e.select(*feature_columns()), "pca-rows")
    model, _ = MD.pca_fit_transform(e, feature_columns())
    return MD.explained_variance(spark, model)


@register("als_recs", ops="L8,L9,J8")
def als_recs(spark, root):
    """Non-negative ALS (rank 10, seed 42) on train; top-20 unseen items for
    every truth user."""
    c = Canonical(spark, root)
    model = MD.als_fit(c.train)
    return MD.als_recommend(model, c.truth.select("user_id"), c.seen, TOP_N)


@register("als_eval", ops="L8,L14,M14")
def als_eval(spark, root):
    """Evaluation report of the ALS model: ranking metrics of its lists and
    RMSE/R2 of its rating predictions on the test rows."""
    c = Canonical(spark, root)
    model = MD.als_fit(c.train)
    # Four metric branches read the lists: score all items once, then reuse.
    recs = written(MD.als_recommend(model, c.truth.select("user_id"), c.seen, TOP_N), "als-lists")
    test = c.test.select(F.col("user_id").cast("int"), F.col("item_id").cast("int"), "rating")
    pred = model.transform(test).select(F.col("user_id").cast("long"),
                                        F.col("item_id").cast("long"), "rating",
                                        F.col("prediction").cast("double").alias("pred"))
    return M.evaluation_report(recs, c.truth, pred, c.popularity, c.total_items(),
                               c.total_users())


@register("svd_factors", ops="L7")
def svd_factors(spark, root):
    """Truncated SVD (10 components, seed 42) of the zero-filled train
    matrix by a distributed randomized range finder; user factors U*S."""
    c = Canonical(spark, root)
    a = c.train.select("user_id", "item_id", F.col("rating").alias("v"))
    user_f, _, _ = MD.randomized_svd(spark, a, k=10, seed=42)
    return user_f.select("user_id", F.posexplode("f").alias("component", "value"))


@register("svd_recs", ops="L7,L9")
def svd_recs(spark, root):
    """L9 for "svd": top-20 unseen items per truth user scored by the
    truncated SVD reconstruction (U S) V^T, blocks pruned by norms."""
    c = Canonical(spark, root)
    a = c.train.select("user_id", "item_id", F.col("rating").alias("v"))
    user_f, item_f, _ = MD.randomized_svd(spark, a, k=10, seed=42)
    return FA.pruned_top_n(user_f, item_f, c.truth.select("user_id"), c.seen, TOP_N)


@register("hybrid_models", ops="L10,L8,L7")
def hybrid_models(spark, root):
    """L10 over the factor models: scores of ALS (non-negative) and SVD, each
    min-max scaled per truth user over all unseen items, averaged; top-10.
    Rows-only (model outputs)."""
    c = Canonical(spark, root)
    a = c.train.select("user_id", "item_id", F.col("rating").alias("v"))
    user_f, item_f, _ = MD.randomized_svd(spark, a, k=10, seed=42)
    return MD.blended_top_n(MD.als_factors(MD.als_fit(c.train)),
                            (written(user_f, "svd-users"), written(item_f, "svd-items")),
                            c.truth.select("user_id"), c.seen, 10)


def _nmf(spark, c):
    a = c.train.select("user_id", "item_id", F.col("rating").alias("v"))
    return FA.nmf(spark, a, k=10, seed=42)


@register("nmf_factors", ops="L8")
def nmf_factors(spark, root):
    """Non-negative factors (10 components, seed 42) of the zero-filled train
    matrix: both sides, component by component."""
    w, h, _ = _nmf(spark, Canonical(spark, root))
    both = w.select(F.lit("user").alias("side"), F.col("user_id").alias("id"), "f").unionByName(
        h.select(F.lit("item").alias("side"), F.col("item_id").alias("id"), "f"))
    return both.select("side", "id", F.posexplode("f").alias("component", "value"))


@register("nmf_recs", ops="L8,L9")
def nmf_recs(spark, root):
    """L9 for "nmf": top-20 unseen items per truth user by the product of the
    non-negative factors, blocks pruned by norms."""
    c = Canonical(spark, root)
    w, h, _ = _nmf(spark, c)
    return FA.pruned_top_n(w, h, c.truth.select("user_id"), c.seen, TOP_N)


@register("cold_start_fold_in", ops="L11")
def cold_start_fold_in(spark, root):
    """Customers without a train row: top-10 items by SVD factors, the user's own
    folded in from the later ratings, else the average profile."""
    c = Canonical(spark, root)
    a = c.train.select("user_id", "item_id", F.col("rating").alias("v"))
    user_f, item_f, _ = MD.randomized_svd(spark, a, k=10, seed=42)
    known = user_f.select("user_id")
    unknown = users(Tables(spark, root)).select("user_id").join(known, "user_id", "left_anti")
    own = c.test.select("user_id", "item_id", F.col("rating").alias("v"))
    found = written(FA.unknown_user_factors(unknown, own, user_f, item_f, 10), "unknown-users")
    recs = FA.pruned_top_n(found.select("user_id", "f"), item_f, unknown, own, 10)
    return recs.join(found.select("user_id", "source"), "user_id")


MOMENT_COLS = ("user_acctbal", "item_price", "item_size", "rating", "day_of_week", "is_weekend")
_PAIRS = [(a, b) for i, a in enumerate(MOMENT_COLS) for b in MOMENT_COLS[i:]]


def _enriched(t, inter=None):
    return derive(interactions(t) if inter is None else inter).join(
        users(t), "user_id", "left").join(items(t), "item_id", "left")


@register("moments_fold", ops="G3,X3,L5", doubles=("cov", "mean_a"), sql=P.INTERACTIONS_ONLY + """,
e AS (SELECT c.c_acctbal::DOUBLE AS user_acctbal, p.p_retailprice::DOUBLE AS item_price,
        p.p_size::DOUBLE AS item_size, i.rating,
        (dayofweek(make_timestamp(CAST(i."timestamp" AS BIGINT) * 1000000)) + 1)::DOUBLE
          AS day_of_week,
        CASE WHEN dayofweek(make_timestamp(CAST(i."timestamp" AS BIGINT) * 1000000)) IN (0, 6)
             THEN 1.0 ELSE 0.0 END AS is_weekend
      FROM inter i JOIN customer c ON i.user_id = c.c_custkey JOIN part p ON i.item_id = p.p_partkey)
""" + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, count(*) AS n, avg({a}) AS mean_a, covar_samp({a}, {b}) AS cov "
    f"FROM e" for a, b in _PAIRS))
def moments_fold(spark, root):
    """Moments per yearly batch, folded: covariances of the whole."""
    e = _enriched(Tables(spark, root)).withColumn("year", F.year(F.timestamp_seconds("timestamp")))
    whole = MO.merge_moments(MO.partial_moments(e, MOMENT_COLS, ["year"]), len(MOMENT_COLS))
    return MO.covariances(whole, MOMENT_COLS).select("a", "b", "n", "mean_a", "cov")


WIDE = ("user_acctbal", "user_nation", "item_price", "item_size", "rating", "day_of_week",
        "is_weekend", "user_avg_rating", "user_interaction_count", "item_avg_rating",
        "item_popularity", "session_duration", "interactions_in_session", "purchase_count",
        "time_since_last_interaction")


def wide_features(t):
    """The 15 columns of the feature pipeline for every interaction.

    Few columns are moved, and seldom: sessions are orders, which the join has together
    already; the time since the last interaction is added to the rows where it is found;
    then all that hangs on the user is joined, and all that hangs on the item.
    """
    keys = ["l_orderkey", "l_linenumber", "l_suppkey"]
    def repeated(dim, key):
        """Keys that the dimension has more than once; its joins repeat their rows."""
        return written(dim.groupBy(key).agg(F.count(F.lit(1)).alias(f"n_{key}")).filter(
            F.col(f"n_{key}") > 1), "repeated")
    rows = interactions(t, with_keys=True).drop("session_id")
    for dim, key in ((users(t), "user_id"), (items(t), "item_id")):
        rows = rows.join(repeated(dim, key), key, "left")
    one = F.lit(1).cast("long")
    rows = rows.withColumn("copies", F.coalesce("n_user_id", one) * F.coalesce("n_item_id", one))
    keyed = written(features.session_features(
        rows.drop("n_user_id", "n_item_id"), "l_orderkey", "copies").drop("copies"), "interactions")
    inter = keyed.drop(*keys)
    recent = features.recency(keyed, tie_cols=keys, least_by=["item_id"])
    e = written(recent.select("user_id", "item_id", "rating", "timestamp", "session_duration",
                              "interactions_in_session", "time_since_last_interaction"), "recent")
    e = derive(e).join(users(t), "user_id", "left")
    e = e.join(profiles.type_counts(inter, ["purchase"]), "user_id", "left")
    popular = profiles.item_popularity(inter).select("item_id", "popularity")
    e = features.profile_lookup(e, profiles.user_profiles(inter).drop("interacted_items"),
                                profiles.item_features(inter).join(popular, "item_id"))
    return e.join(items(t), "item_id", "left").na.fill(0.0, ["time_since_last_interaction"])


@register("pca_wide", ops="L1,L2,L3,L4")
def pca_wide(spark, root):
    """15 standardised columns to 4 components, from folded moments."""
    e = written(wide_features(Tables(spark, root)).select("user_id", "item_id", *WIDE),
                "wide-features")
    scale, loadings, _ = MO.principal_components(
        MO.merge_moments(MO.partial_moments(e, WIDE), len(WIDE)), WIDE)
    out = MO.project(e, WIDE, scale, loadings)
    return out.select("user_id", "item_id", *[f"pc{j + 1}" for j in range(loadings.shape[1])])


@register("pca_target", ops="L5")
def pca_target(spark, root):
    """As many components of the eight features as explain 95 % of the variance."""
    cols = feature_columns()
    m = MO.partial_moments(_enriched(Tables(spark, root)), cols)
    _, _, explained = MO.principal_components(m, cols, target_variance=0.95)
    return MO.explained_table(spark, explained, 0.95)
