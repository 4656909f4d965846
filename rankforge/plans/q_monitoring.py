"""Registered queries: metric history and request-log monitoring
(Q1-Q11, G6-G10, V4, V5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.functions import columns as C
from rankforge.operators import monitoring as MO
from rankforge.operators import profiles
from rankforge.plans.canonical import Canonical
from rankforge.plans.registry import register
from rankforge.sources import events as ev
from rankforge.sources.tables import Tables


# Scale of the stand-in metric values into [0, 1); a prime keeps averages off
# exact half-way points at the 7th decimal, where rounding is engine-specific.
HIST_SCALE = 499.0


def metric_history(events: DataFrame) -> DataFrame:
    """Metric-history stand-in: each event is a recorded metric point; the
    metric name is one of the seven targets chosen by ``props.k``."""
    names = F.array(*[F.lit(n) for n in MO.TARGETS])
    k = ev.props_k()
    return events.select("event_id", "ts",
                         F.element_at(names, (k % len(MO.TARGETS)) + 1).alias("metric"),
                         (F.col("value") / C.dbl(HIST_SCALE)).alias("value"))


HIST_SQL = """
WITH hist AS (
  SELECT event_id, ts,
         (['ndcg_10', 'map_10', 'hit_rate_20', 'rmse', 'user_coverage', 'catalog_coverage',
           'r2_score'])[CAST(props->>'k' AS INTEGER) % 7 + 1] AS metric,
         value / 499.0 AS value
  FROM events),
cur AS (SELECT metric, arg_max(value, (ts, event_id)) AS current, max(ts) AS last_ts
        FROM hist GROUP BY metric),
targets AS (SELECT * FROM (VALUES ('ndcg_10', 0.78), ('map_10', 0.73), ('hit_rate_20', 0.91),
                                  ('rmse', 0.84), ('user_coverage', 0.942),
                                  ('catalog_coverage', 0.785), ('r2_score', 0.89))
            t(metric, target))
"""

REQ_SQL = """
WITH req AS (
  SELECT event_id, ts, user_id, event_type,
         CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
         value AS latency_ms,
         (['svd', 'nmf', 'hybrid'])[CAST(props->>'k' AS INTEGER) % 3 + 1] AS algorithm,
         CAST(props->>'k' AS INTEGER) % 2 AS cache_hit,
         CAST(props->>'k' AS INTEGER) % 50 + 1 AS n_recs,
         CASE WHEN event_type = 'view' THEN '/recommendations'
              WHEN event_type = 'click' THEN '/interactions' ELSE '/health' END AS endpoint,
         CASE WHEN event_type IN ('view', 'click') THEN 'POST' ELSE 'GET' END AS method
  FROM events)
"""


def _req(spark, root):
    return ev.requests(Tables(spark, root).events)


def _hist(spark, root):
    return metric_history(Tables(spark, root).events)


@register("metric_current", ops="Q1", doubles=("current",), sql=HIST_SQL + """
SELECT metric, current, strftime(last_ts, '%Y-%m-%d %H:%M:%S') AS last_ts FROM cur""")
def metric_current(spark, root):
    c = MO.current_values(_hist(spark, root))
    return c.select("metric", "current", C.ts_text("last_ts").alias("last_ts"))


@register("metric_summary", ops="Q2", doubles=("current", "target", "achievement_rate"),
          sql=HIST_SQL + """
SELECT t.metric, coalesce(c.current, 0.0) AS current, t.target,
       CASE WHEN t.target > 0 THEN coalesce(c.current, 0.0) / t.target ELSE 0.0 END
         AS achievement_rate,
       CASE WHEN t.metric = 'rmse' THEN coalesce(c.current, 0.0) <= t.target
            ELSE coalesce(c.current, 0.0) >= t.target END AS meets_target
FROM targets t LEFT JOIN cur c ON t.metric = c.metric""")
def metric_summary(spark, root):
    return MO.target_report(MO.current_values(_hist(spark, root)), MO.targets_table(spark))


@register("metric_trend", ops="Q3,W5,G6,G7",
          doubles=("slope", "current_value", "average_value", "std_deviation", "min_value",
                   "max_value"), sql=HIST_SQL + """,
last AS (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY ts DESC, event_id DESC) AS r
         FROM hist QUALIFY r <= 10),
lx AS (SELECT *, CAST(count(*) OVER (PARTITION BY metric) - r AS DOUBLE) AS x FROM last)
SELECT metric, count(*) AS n_points, regr_slope(value, x) AS slope,
       arg_max(value, x) AS current_value, avg(value) AS average_value,
       stddev_pop(value) AS std_deviation, min(value) AS min_value, max(value) AS max_value,
       CASE WHEN count(*) < 2 THEN 'insufficient_data'
            WHEN regr_slope(value, x) > 0 THEN 'improving'
            WHEN regr_slope(value, x) < 0 THEN 'declining' ELSE 'stable' END AS trend
FROM lx GROUP BY metric""")
def metric_trend(spark, root):
    return MO.trend(_hist(spark, root), 10)


@register("request_summary", ops="Q4",
          doubles=("p50", "p75", "p90", "p95", "p99", "min_ms", "max_ms", "mean_ms",
                   "success_rate", "request_rate"), sql=REQ_SQL + """
SELECT count(*) AS n_requests,
  quantile_cont(latency_ms, 0.5) AS p50, quantile_cont(latency_ms, 0.75) AS p75,
  quantile_cont(latency_ms, 0.9) AS p90, quantile_cont(latency_ms, 0.95) AS p95,
  quantile_cont(latency_ms, 0.99) AS p99,
  min(latency_ms) AS min_ms, max(latency_ms) AS max_ms, avg(latency_ms) AS mean_ms,
  CAST(count(*) FILTER (WHERE latency_ms > 100) AS BIGINT) AS slow_requests,
  avg(CASE WHEN status < 400 THEN 1.0 ELSE 0.0 END) AS success_rate,
  count(*) / (epoch(max(ts)) - epoch(min(ts))) AS request_rate
FROM req""")
def request_summary(spark, root):
    return MO.request_summary(_req(spark, root), exact=True)


@register("latency_5m", ops="Q5", doubles=("p50", "p95"), sql=REQ_SQL + """
SELECT strftime(time_bucket(INTERVAL 5 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       count(*) AS n, quantile_cont(latency_ms, 0.5) AS p50,
       quantile_cont(latency_ms, 0.95) AS p95
FROM req GROUP BY 1""")
def latency_5m(spark, root):
    w = MO.latency_windows(_req(spark, root), 5)
    return w.select(C.ts_text("w.start").alias("window_start"), "n", "p50", "p95")


@register("latency_sketch_15m", ops="Q5,Q4", doubles=("p50", "p95", "p99"), sql=REQ_SQL + """,
w AS (SELECT time_bucket(INTERVAL 1 MINUTE, ts) - to_minutes(5 * k + CAST(
             minute(ts) % 5 AS INTEGER)) AS ws, latency_ms FROM req, range(0, 3) t(k))
SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n,
       quantile_disc(latency_ms, 0.5) AS p50, quantile_disc(latency_ms, 0.95) AS p95,
       quantile_disc(latency_ms, 0.99) AS p99
FROM w GROUP BY 1""")
def latency_sketch_15m(spark, root):
    """Minute sketches folded to 15-minute windows sliding by 5 (exact up to
    1,024 rows a window, see ``fold_latency``)."""
    w = MO.fold_latency(MO.latency_sketches(_req(spark, root)), 15, (0.5, 0.95, 0.99), slide=5)
    return w.select(C.ts_text("w.start").alias("window_start"), "n", "p50", "p95", "p99")


@register("error_rate_5m", ops="Q6", doubles=("request_rate", "error_ratio"), sql=REQ_SQL + """
SELECT strftime(time_bucket(INTERVAL 5 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       count(*) AS n, count(*) / 300.0 AS request_rate,
       avg(CASE WHEN status >= 500 THEN 1.0 ELSE 0.0 END) AS error_ratio
FROM req GROUP BY 1""")
def error_rate_5m(spark, root):
    w = MO.error_windows(_req(spark, root), 5)
    return w.select(C.ts_text("w.start").alias("window_start"), "n", "request_rate",
                    "error_ratio")


@register("cache_hit_rate", ops="Q7", doubles=("hit_ratio",), sql=REQ_SQL + """
SELECT algorithm, CAST(sum(cache_hit) AS BIGINT) AS hits,
       CAST(sum(1 - cache_hit) AS BIGINT) AS misses,
       CASE WHEN count(*) > 0 THEN sum(cache_hit) / count(*) ELSE 0.0 END AS hit_ratio
FROM req GROUP BY algorithm""")
def cache_hit_rate(spark, root):
    return MO.cache_hit_rate(_req(spark, root))


@register("active_users", ops="Q8", sql=REQ_SQL + """
SELECT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d') AS day,
       count(DISTINCT user_id) AS active_users
FROM req GROUP BY 1""")
def active_users(spark, root):
    a = MO.active_users(_req(spark, root), "1 day")
    return a.select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "active_users")


@register("quality_series", ops="Q9", doubles=("avg_value",), sql=HIST_SQL + """
SELECT metric, strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS hour,
       avg(value) AS avg_value, count(*) AS n
FROM hist GROUP BY 1, 2""")
def quality_series(spark, root):
    h = _hist(spark, root)
    g = h.groupBy("metric", F.window(F.col("ts").cast("timestamp"), "1 hour").alias("w")).agg(
        F.avg("value").alias("avg_value"), F.count(F.lit(1)).alias("n"))
    return g.select("metric", C.ts_text("w.start").alias("hour"), "avg_value", "n")


@register("inflight", ops="Q10", sql=REQ_SQL + """,
ev AS (SELECT event_id, ts AS t, 1 AS delta FROM req
       UNION ALL
       SELECT event_id, ts + to_microseconds(CAST(round(latency_ms * 1000) AS BIGINT)), -1
       FROM req)
SELECT event_id, inflight FROM (
  SELECT event_id, delta,
         CAST(sum(delta) OVER (ORDER BY t, delta, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT)
           AS inflight FROM ev)
WHERE delta = 1""")
def inflight(spark, root):
    return MO.inflight(_req(spark, root))


@register("metric_band", ops="Q11", doubles=("value",), sql=HIST_SQL.replace(
    "WITH hist", REQ_SQL.strip() + ",\nhist") + """,
vals AS (
  SELECT 'ndcg_10' AS panel, (SELECT current FROM cur WHERE metric = 'ndcg_10') AS value
  UNION ALL SELECT 'cache_hit_rate', (SELECT avg(cache_hit) FROM req)
  UNION ALL SELECT 'error_rate', (SELECT avg(CASE WHEN status >= 500 THEN 1.0 ELSE 0.0 END)
                                  FROM req))
SELECT panel, value,
  CASE panel
    WHEN 'ndcg_10' THEN CASE WHEN value < 0.7 THEN 'red' WHEN value < 0.78 THEN 'yellow'
                             ELSE 'green' END
    WHEN 'cache_hit_rate' THEN CASE WHEN value < 0.8 THEN 'red' WHEN value < 0.9 THEN 'yellow'
                                    ELSE 'green' END
    ELSE CASE WHEN value < 0.01 THEN 'green' WHEN value < 0.05 THEN 'yellow' ELSE 'red' END
  END AS band
FROM vals""")
def metric_band(spark, root):
    req = _req(spark, root)
    cur = MO.current_values(_hist(spark, root))
    nd = cur.filter(F.col("metric") == "ndcg_10").select(
        F.lit("ndcg_10").alias("panel"), F.col("current").alias("value"))
    ch = req.agg(F.avg(F.col("cache_hit").cast("double")).alias("value")).select(
        F.lit("cache_hit_rate").alias("panel"), "value")
    er = req.agg(F.avg(F.when(F.col("status") >= 500, C.dbl(1.0)).otherwise(C.dbl(0.0)))
                 .alias("value")).select(F.lit("error_rate").alias("panel"), "value")
    vals = nd.unionByName(ch).unionByName(er)
    expr = None
    for panel, (lo, hi, b, m, a) in MO.BANDS.items():
        cond = F.col("panel") == panel
        e = MO.band(F.col("value"), lo, hi, b, m, a)
        expr = F.when(cond, e) if expr is None else expr.when(cond, e)
    return vals.withColumn("band", expr)


_LAT_B = ", ".join(
    f"CAST(count(*) FILTER (WHERE latency_ms / 1000.0 <= {b}) AS BIGINT) AS \"le_{b}\""
    for b in MO.LATENCY_BUCKETS_S)


@register("latency_hist", ops="G9", doubles=("sum",), sql=REQ_SQL + f"""
SELECT algorithm, {_LAT_B}, count(*) AS le_inf, sum(latency_ms / 1000.0) AS sum,
       count(*) AS count
FROM req GROUP BY algorithm""")
def latency_hist(spark, root):
    r = _req(spark, root).withColumn("latency_s", F.col("latency_ms") / C.dbl(1000.0))
    return profiles.histogram(r, "latency_s", MO.LATENCY_BUCKETS_S, ["algorithm"])


_SIZE_B = ", ".join(
    f"CAST(count(*) FILTER (WHERE n_recs <= {b}) AS BIGINT) AS \"le_{float(b)}\""
    for b in MO.LIST_SIZE_BUCKETS)


@register("list_size_hist", ops="G9", doubles=("sum",), sql=REQ_SQL + f"""
SELECT algorithm, {_SIZE_B}, count(*) AS le_inf, CAST(sum(n_recs) AS DOUBLE) AS sum,
       count(*) AS count
FROM req WHERE endpoint = '/recommendations' GROUP BY algorithm""")
def list_size_hist(spark, root):
    r = _req(spark, root).filter(F.col("endpoint") == "/recommendations")
    return profiles.histogram(r, "n_recs", [float(b) for b in MO.LIST_SIZE_BUCKETS],
                              ["algorithm"])


@register("request_counts", ops="G10", sql=REQ_SQL + """
SELECT 'requests' AS counter, endpoint AS label1, method AS label2,
       CAST(status AS VARCHAR) AS label3, count(*) AS n
FROM req GROUP BY endpoint, method, status
UNION ALL
SELECT 'recommendations', algorithm, CASE WHEN status < 400 THEN 'success' ELSE 'error' END,
       '', count(*)
FROM req WHERE endpoint = '/recommendations' GROUP BY 2, 3""")
def request_counts(spark, root):
    r = _req(spark, root)
    a = r.groupBy("endpoint", "method", "status").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("requests").alias("counter"), F.col("endpoint").alias("label1"),
        F.col("method").alias("label2"), F.col("status").cast("string").alias("label3"), "n")
    b = (r.filter(F.col("endpoint") == "/recommendations")
         .withColumn("outcome", F.when(F.col("status") < 400, "success").otherwise("error"))
         .groupBy("algorithm", "outcome").agg(F.count(F.lit(1)).alias("n"))
         .select(F.lit("recommendations").alias("counter"), F.col("algorithm").alias("label1"),
                 F.col("outcome").alias("label2"), F.lit("").alias("label3"), "n"))
    return a.unionByName(b)


@register("counters", ops="V5", sql=REQ_SQL + """
SELECT key, CAST(sum(amount) AS BIGINT) AS value FROM (
  SELECT 'requests:' || endpoint AS key, 1 AS amount FROM req
  UNION ALL SELECT 'cache_hits', cache_hit FROM req
  UNION ALL SELECT 'items_served:' || algorithm, n_recs FROM req
    WHERE endpoint = '/recommendations')
GROUP BY key""")
def counters(spark, root):
    r = _req(spark, root)
    inc = (r.select(F.concat(F.lit("requests:"), "endpoint").alias("key"),
                    F.lit(1).alias("amount"))
           .unionByName(r.select(F.lit("cache_hits").alias("key"),
                                 F.col("cache_hit").alias("amount")))
           .unionByName(r.filter(F.col("endpoint") == "/recommendations")
                        .select(F.concat(F.lit("items_served:"), "algorithm").alias("key"),
                                F.col("n_recs").alias("amount"))))
    return MO.counters(inc)


@register("model_stats", ops="V4", doubles=("value",), sql=HIST_SQL.replace(
    "WITH hist", "WITH " + __import__("rankforge.plans.sql_prelude", fromlist=["x"])
    .INTERACTIONS.strip() + ",\n" + __import__("rankforge.plans.sql_prelude", fromlist=["x"])
    .DEDUP.strip() + ",\nhist") + """
SELECT 'n_users' AS stat, CAST(count(DISTINCT user_id) AS DOUBLE) AS value FROM dedup
UNION ALL SELECT 'n_items', CAST(count(DISTINCT item_id) AS DOUBLE) FROM dedup
UNION ALL SELECT 'n_interactions', CAST(count(*) AS DOUBLE) FROM dedup
UNION ALL SELECT 'density', count(*) / (count(DISTINCT user_id) * count(DISTINCT item_id))
  FROM dedup
UNION ALL SELECT 'metric:' || metric, current FROM cur
UNION ALL SELECT 'last_update', max(epoch(ts)) FROM hist""")
def model_stats(spark, root):
    """V4: model statistics as a long table: matrix shape, current metrics,
    last update time."""
    shape = profiles.matrix_shape(Canonical(spark, root).dedup)
    s = shape.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("stat"), F.col(n).cast("double").alias("value"))
        for n in ("n_users", "n_items", "n_interactions", "density")])).alias("r")) \
        .select("r.stat", "r.value")
    h = _hist(spark, root)
    cur = MO.current_values(h).select(F.concat(F.lit("metric:"), "metric").alias("stat"),
                                      F.col("current").alias("value"))
    last = h.agg(F.max(C.epoch_seconds("ts")).alias("value")).select(
        F.lit("last_update").alias("stat"), "value")
    return s.unionByName(cur).unionByName(last)
