"""Registered queries: ranking, recommendation metrics, SQL-able recommenders,
serving tables (W1-W5, M1-M15, J5, L10, L11, L13, L14, V1, V2, V6)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from rankforge.functions import columns as C
from rankforge.operators import metrics as M
from rankforge.operators import ranking as R
from rankforge.plans import sql_prelude as P
from rankforge.plans.canonical import TOP_N, Canonical, bias_predict
from rankforge.plans.registry import register


@register("topn", ops="W1,W2,V1", doubles=("score",), sql=P.FULL + """,
everybody AS (SELECT DISTINCT user_id FROM dedup)
SELECT u.user_id, p.item_id, CAST(p.cnt AS DOUBLE) AS score,
       CAST(row_number() OVER (PARTITION BY u.user_id ORDER BY p.prank) AS INTEGER) AS rank,
       'popularity' AS algorithm
FROM everybody u CROSS JOIN pool p
WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.user_id = u.user_id AND s.item_id = p.item_id)
QUALIFY rank <= 20""")
def topn(spark, root):
    """V1: lists for every user with an interaction, over the whole catalog."""
    c = Canonical(spark, root)
    r = R.popularity_recs(c.dedup.select("user_id"), c.seen, c.pool, TOP_N)
    return r.withColumn("algorithm", F.lit("popularity"))


@register("exclude_seen", ops="J5", sql=P.FULL + """,
own AS (SELECT user_id, count(*) AS n FROM seen GROUP BY user_id)
SELECT c.user_id, c.item_id, CAST(c.prank AS BIGINT) AS prank
FROM cand c LEFT JOIN own o ON c.user_id = o.user_id
WHERE c.prank <= 20 + coalesce(o.n, 0)""")
def exclude_seen(spark, root):
    """Each truth user's first 20 + (number of seen items) ranks of the
    whole catalog, without the seen items."""
    c = Canonical(spark, root)
    return R.popularity_candidates(c.truth.select("user_id"), c.seen, c.pool, TOP_N) \
        .select("user_id", "item_id", "prank")


@register("ndcg_binary", ops="M2,W3", doubles=("ndcg",),
          sql=P.WITH_HITS + " SELECT user_id, ndcg FROM per_user")
def ndcg_binary(spark, root):
    c = Canonical(spark, root)
    return M.per_user_ranking(c.recs, c.truth).select("user_id", "ndcg")


@register("map_at_k", ops="M3,M4,W4", doubles=("ap",),
          sql=P.WITH_HITS + " SELECT user_id, ap FROM per_user")
def map_at_k(spark, root):
    c = Canonical(spark, root)
    return M.per_user_ranking(c.recs, c.truth).select("user_id", "ap")


@register("hit_rate", ops="M5,J3,J4,P13", doubles=("hit",),
          sql=P.WITH_HITS + " SELECT user_id, hit FROM per_user")
def hit_rate(spark, root):
    c = Canonical(spark, root)
    return M.per_user_ranking(c.recs, c.truth).select("user_id", "hit")


@register("hit_rate_all", ops="M5,M3,J3", doubles=("hit", "ap"), sql=P.WITH_HITS + """,
everybody AS (SELECT DISTINCT user_id FROM dedup)
SELECT e.user_id, coalesce(p.hit, 0.0) AS hit,
       CASE WHEN s.n_truth > 0 THEN coalesce(p.ap, 0.0) END AS ap
FROM everybody e LEFT JOIN per_user p ON e.user_id = p.user_id
                 LEFT JOIN tsize s ON e.user_id = s.user_id""")
def hit_rate_all(spark, root):
    """M5 over every user with an interaction: users without truth are misses."""
    c = Canonical(spark, root)
    return M.per_user_ranking(c.recs, c.truth, queried=c.dedup).select("user_id", "hit", "ap")


@register("precision_recall", ops="M6,M7", doubles=("precision", "recall"),
          sql=P.WITH_HITS + " SELECT user_id, precision, recall FROM per_user")
def precision_recall(spark, root):
    c = Canonical(spark, root)
    return M.per_user_ranking(c.recs, c.truth).select("user_id", "precision", "recall")


@register("ranking_summary", ops="M2,M4,M5,M6,M7",
          doubles=("ndcg", "map", "hit_rate", "precision", "recall"), sql=P.WITH_HITS + """
SELECT coalesce(avg(ndcg), 0.0) AS ndcg, coalesce(avg(ap), 0.0) AS map,
       coalesce(avg(hit), 0.0) AS hit_rate, coalesce(avg(precision), 0.0) AS precision,
       coalesce(avg(recall), 0.0) AS recall, count(*) AS n_users FROM per_user""")
def ranking_summary(spark, root):
    c = Canonical(spark, root)
    return M.ranking_summary(M.per_user_ranking(c.recs, c.truth))


@register("ndcg_graded", ops="M1", doubles=("ndcg",), sql=P.FULL + """,
head AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY item_id) AS pos
         FROM scored QUALIFY pos <= 10),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY pred DESC, pos) AS rp,
                row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, pos) AS ri
      FROM head)
SELECT user_id,
  CASE WHEN sum((pow(2.0, rating) - 1) / log2(ri + 1)) > 0
       THEN sum((pow(2.0, rating) - 1) / log2(rp + 1)) / sum((pow(2.0, rating) - 1) / log2(ri + 1))
       ELSE 0.0 END AS ndcg
FROM r GROUP BY user_id""")
def ndcg_graded(spark, root):
    return M.ndcg_graded(Canonical(spark, root).scored, k=10)


@register("coverage", ops="M8,M9", doubles=("catalog_coverage", "user_coverage"),
          sql=P.FULL + """
SELECT count(DISTINCT item_id) AS n_rec_items, count(DISTINCT user_id) AS n_rec_users,
       count(DISTINCT item_id) / (SELECT count(*) FROM part) AS catalog_coverage,
       count(DISTINCT user_id) / (SELECT count(*) FROM customer) AS user_coverage
FROM recs""")
def coverage(spark, root):
    c = Canonical(spark, root)
    return M.coverage(c.recs, c.total_items(), c.total_users())


@register("diversity", ops="M13", doubles=("diversity",), sql=P.FULL + """
SELECT coalesce(avg(d / n), 0.0) AS diversity FROM (
  SELECT user_id, count(*) AS n, count(DISTINCT item_id) AS d FROM recs GROUP BY user_id)
WHERE n > 1""")
def diversity(spark, root):
    return M.diversity(Canonical(spark, root).recs)


@register("novelty", ops="M12,J6,P14", doubles=("novelty",), sql=P.FULL + """
SELECT coalesce(avg(1.0 - p.popularity), 0.0) AS novelty
FROM recs r JOIN popularity p ON r.item_id = p.item_id""")
def novelty(spark, root):
    c = Canonical(spark, root)
    return M.novelty(c.recs, c.popularity)


@register("rating_error", ops="M10,M11", doubles=("rmse", "r2"), sql=P.FULL + """
SELECT count(*) AS n,
  CASE WHEN count(*) > 0 THEN sqrt(avg(pow(rating - pred, 2))) ELSE 'inf'::DOUBLE END AS rmse,
  CASE WHEN count(*) = 0 THEN 0.0
       WHEN var_pop(rating) * count(*) = 0 THEN
         CASE WHEN sum(pow(rating - pred, 2)) = 0 THEN 1.0 ELSE 0.0 END
       ELSE 1.0 - sum(pow(rating - pred, 2)) / (var_pop(rating) * count(*)) END AS r2
FROM scored""")
def rating_error(spark, root):
    return M.rating_error(Canonical(spark, root).scored)


@register("bias_predict", ops="L14", doubles=("rating", "pred"),
          sql=P.FULL + " SELECT user_id, item_id, rating, pred FROM scored")
def bias_predict_q(spark, root):
    c = Canonical(spark, root)
    return bias_predict(c.train, c.test)


EVAL_SQL = P.WITH_HITS + """,
rs AS (SELECT coalesce(avg(ndcg), 0.0) AS ndcg, coalesce(avg(ap), 0.0) AS map,
              coalesce(avg(hit), 0.0) AS hit_rate, coalesce(avg(precision), 0.0) AS prec,
              coalesce(avg(recall), 0.0) AS rec FROM per_user),
er AS (SELECT sqrt(avg(pow(rating - pred, 2))) AS rmse,
              1.0 - sum(pow(rating - pred, 2)) / (var_pop(rating) * count(*)) AS r2 FROM scored),
cv AS (SELECT count(DISTINCT item_id) / (SELECT count(*) FROM part) AS cc,
              count(DISTINCT user_id) / (SELECT count(*) FROM customer) AS uc FROM recs),
dv AS (SELECT coalesce(avg(d / n), 0.0) AS dv FROM (
         SELECT user_id, count(*) AS n, count(DISTINCT item_id) AS d FROM recs GROUP BY user_id)
       WHERE n > 1),
nv AS (SELECT coalesce(avg(1.0 - p.popularity), 0.0) AS nv
       FROM recs r JOIN popularity p ON r.item_id = p.item_id)
SELECT 'rmse' AS metric, rmse AS value FROM er UNION ALL
SELECT 'r2_score', r2 FROM er UNION ALL
SELECT 'hit_rate_20', hit_rate FROM rs UNION ALL
SELECT 'map_10', map FROM rs UNION ALL
SELECT 'ndcg_10', ndcg FROM rs UNION ALL
SELECT 'precision_10', prec FROM rs UNION ALL
SELECT 'recall_10', rec FROM rs UNION ALL
SELECT 'catalog_coverage', cc FROM cv UNION ALL
SELECT 'user_coverage', uc FROM cv UNION ALL
SELECT 'diversity', dv FROM dv UNION ALL
SELECT 'novelty', nv FROM nv"""


@register("eval_report", ops="M14", doubles=("value",), sql=EVAL_SQL)
def eval_report(spark, root):
    c = Canonical(spark, root, materialize=True, materialize_recs=True)
    return M.evaluation_report(c.recs, c.truth, c.scored, c.popularity, c.total_items(),
                               c.total_users())


_MULTI_K = []
for _k in (5, 10, 20):
    _MULTI_K.append(f"""
SELECT {_k} AS k, 'precision' AS metric, avg(h{_k} / {_k}.0) AS value FROM pk UNION ALL
SELECT {_k}, 'recall', avg(CASE WHEN s.n_truth_distinct > 0 THEN d{_k} / s.n_truth_distinct
                             ELSE 0.0 END) FROM pk JOIN tsize s USING (user_id) UNION ALL
SELECT {_k}, 'hit', avg(CASE WHEN h{_k} > 0 THEN 1.0 ELSE 0.0 END) FROM pk UNION ALL
SELECT {_k}, 'ndcg', avg(CASE WHEN i{_k} > 0 THEN dcg{_k} / i{_k} ELSE 0.0 END) FROM pk""")
_PK_COLS = ",\n".join(
    f"sum(CASE WHEN rank <= {k} THEN hit ELSE 0 END) AS h{k}, "
    f"count(DISTINCT CASE WHEN rank <= {k} AND hit = 1 THEN item_id END) AS d{k}, "
    f"sum(CASE WHEN rank <= {k} THEN hit / log2(rank + 1) ELSE 0 END) AS dcg{k}, "
    f"sum(CASE WHEN rank <= {k} AND hit = 1 THEN 1.0 / log2(ip{k} + 1) ELSE 0 END) AS i{k}"
    for k in (5, 10, 20))
_IP_COLS = ",\n".join(
    f"row_number() OVER (PARTITION BY user_id ORDER BY "
    f"CASE WHEN rank <= {k} THEN hit ELSE 0 END DESC, rank) AS ip{k}" for k in (5, 10, 20))


@register("metrics_multi_k", ops="M15", doubles=("value",), sql=P.WITH_HITS + f""",
hk AS (SELECT *, {_IP_COLS} FROM hits WHERE user_id IN (SELECT user_id FROM truth)),
pk AS (SELECT user_id, {_PK_COLS} FROM hk GROUP BY user_id)
""" + " UNION ALL ".join(_MULTI_K))
def metrics_multi_k(spark, root):
    c = Canonical(spark, root)
    return M.multi_k(c.recs, c.truth, (5, 10, 20))


@register("cold_start", ops="L11", doubles=("score",), sql=P.FULL + """,
cold AS (SELECT DISTINCT user_id FROM test
         WHERE user_id NOT IN (SELECT user_id FROM train))
SELECT c.user_id, p.item_id, CAST(p.cnt AS DOUBLE) AS score, CAST(p.prank AS INTEGER) AS rank
FROM cold c CROSS JOIN pool p WHERE p.prank <= 10""")
def cold_start(spark, root):
    """Users without history get the popularity list (no seen items)."""
    c = Canonical(spark, root)
    cold = c.test.select("user_id").join(c.train.select("user_id"), "user_id", "left_anti")
    # Cold users have no training rows, so nothing of theirs is in ``seen``.
    return R.popularity_recs(cold, c.seen, c.pool, 10)


HYBRID_SQL = P.FULL + """,
imean AS (SELECT item_id, avg(rating) AS sc FROM train GROUP BY item_id),
sc AS (SELECT c.user_id, c.item_id, CAST(c.cnt AS DOUBLE) AS a, m.sc AS b
       FROM cand c JOIN imean m ON c.item_id = m.item_id),
lim AS (SELECT user_id, min(a) AS a0, max(a) AS a1, min(b) AS b0, max(b) AS b1
        FROM sc GROUP BY user_id),
bl AS (SELECT sc.user_id, sc.item_id,
              (CASE WHEN a1 > a0 THEN (a - a0) / (a1 - a0) ELSE 1.0 END
               + CASE WHEN b1 > b0 THEN (b - b0) / (b1 - b0) ELSE 1.0 END) / 2.0 AS score
       FROM sc JOIN lim ON sc.user_id = lim.user_id)
SELECT user_id, item_id, score,
       CAST(row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, item_id)
            AS INTEGER) AS rank
FROM bl QUALIFY rank <= 10"""


def _minmax_per_user(df):
    w = Window.partitionBy("user_id")
    lo, hi = F.min("score").over(w), F.max("score").over(w)
    return df.select("user_id", "item_id",
                     F.when(hi > lo, (F.col("score") - lo) / (hi - lo)).otherwise(C.dbl(1.0))
                     .alias("s"))


def blend(a, b, n: int = 10):
    """L10 blend: min-max scale each list's score per user, average (a
    missing score counts 0), full outer join on (user, item), top ``n``."""
    sa = _minmax_per_user(a).withColumnRenamed("s", "sa")
    sb = _minmax_per_user(b).withColumnRenamed("s", "sb")
    bl = sa.join(sb, ["user_id", "item_id"], "full_outer").select(
        "user_id", "item_id",
        ((F.coalesce("sa", C.dbl(0)) + F.coalesce("sb", C.dbl(0))) / C.dbl(2)).alias("score"))
    # Both inputs are bounded top lists, so the blend is bounded per user.
    return R.rank_candidates(bl, n, bounded=True)


def hybrid_recs(c: Canonical, n: int = 10):
    """Blend of two scorers, popularity and mean rating, each min-max
    scaled per user over all unseen items of the catalog, averaged."""
    imean = c.train.groupBy("item_id").agg(F.avg("rating").alias("score"))
    popular = c.train.groupBy("item_id").agg(F.count(F.lit(1)).alias("score"))
    return R.blend_scan(c.truth.select("user_id"), c.seen, popular, imean, n)


@register("hybrid_blend", ops="L10", doubles=("score",), sql=HYBRID_SQL)
def hybrid_blend(spark, root):
    return hybrid_recs(Canonical(spark, root)).select("user_id", "item_id", "score", "rank")


@register("split", ops="L13", sql=P.BASE + """
SELECT user_id, item_id,
  CASE WHEN CAST(concat('0x', substr(md5(concat_ws('_', 'split42', CAST(user_id AS VARCHAR),
         CAST(item_id AS VARCHAR))), 1, 8)) AS BIGINT) / 4294967296.0 < 0.2
       THEN 'test' ELSE 'train' END AS part
FROM dedup""")
def split(spark, root):
    """Repeatable hash split (20 % test) independent of partitioning."""
    d = Canonical(spark, root, materialize=False).dedup
    u = C.unit_hash(F.lit("split42"), F.col("user_id"), F.col("item_id"))
    return d.select("user_id", "item_id",
                    F.when(u < C.dbl(0.2), "test").otherwise("train").alias("part"))


@register("rec_ctr", ops="V6", doubles=("ctr",), sql=P.FULL + """,
served AS (SELECT r.user_id, r.item_id, r.rank,
                  CASE WHEN t.item_id IS NULL THEN 0 ELSE 1 END AS clicked
           FROM recs r LEFT JOIN truth t ON r.user_id = t.user_id AND r.item_id = t.item_id)
SELECT rank, count(*) AS served, CAST(sum(clicked) AS BIGINT) AS clicks,
       sum(clicked) / count(*) AS ctr
FROM served GROUP BY rank""")
def rec_ctr(spark, root):
    """V6: served lists exploded to (user, position, item), joined to later
    positive interactions; click-through rate per list position."""
    c = Canonical(spark, root)
    lists = R.lists_from_ranked(c.recs)
    served = lists.select("user_id", F.posexplode("items").alias("pos", "item_id")) \
        .withColumn("rank", (F.col("pos") + 1).cast("int"))
    lab = M.label_hits(served, c.truth)
    return lab.groupBy("rank").agg(F.count(F.lit(1)).alias("served"),
                                   F.sum("hit").cast("long").alias("clicks"),
                                   (F.sum("hit") / F.count(F.lit(1))).alias("ctr"))


@register("fresh_recs", ops="V2", sql="""
WITH req AS (
  SELECT event_id, ts, user_id,
    concat_ws(':', 'rec', CAST(user_id AS VARCHAR),
              (['svd', 'nmf', 'hybrid'])[CAST(props->>'k' AS INTEGER) % 3 + 1],
              CAST(CAST(props->>'k' AS INTEGER) % 50 + 1 AS VARCHAR),
              CAST(CAST(props->>'k' AS INTEGER) % 2 AS VARCHAR)) AS cache_key
  FROM events WHERE event_type = 'view'),
st AS (SELECT cache_key, ts AS created_at, ts + INTERVAL 3600 SECOND AS expires_at, event_id
       FROM req),
live AS (SELECT * FROM st WHERE expires_at >= (SELECT max(ts) FROM events) - INTERVAL 1 DAY)
SELECT cache_key, event_id, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created
FROM live QUALIFY row_number() OVER (PARTITION BY cache_key ORDER BY created_at DESC,
                                     event_id DESC) = 1""")
def fresh_recs(spark, root):
    """V2: stored lists (one per served request, TTL 3600 s) that are still
    fresh at the as-of time; latest entry per cache key."""
    from rankforge.sources import events as ev
    from rankforge.sources.tables import Tables
    e = Tables(spark, root).events
    req = ev.requests(e).filter(F.col("event_type") == "view")
    stored = req.select(
        C.rec_key(F.col("user_id"), F.col("algorithm"), F.col("n_recs"),
                  F.col("exclude_seen")).alias("cache_key"),
        F.col("ts").alias("created_at"),
        (F.col("ts") + F.expr("INTERVAL 3600 SECONDS")).alias("expires_at"),
        "event_id")
    as_of = e.agg(F.max("ts")).scalar() - F.expr("INTERVAL 1 DAY")
    live = stored.filter(F.col("expires_at") >= as_of)
    latest = R.latest_per_key(live, ["cache_key"], ["created_at", "event_id"], [])
    return latest.select("cache_key", "event_id", C.ts_text("created_at").alias("created"))
