"""Metric history and request-log monitoring.

Percentiles: ``exact=True`` counts rows per value in value buckets (linear
interpolation); for large logs, minute sketches (KLL) of bounded size are
folded to any window, in batch and in streams.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.functions.columns import dbl, epoch_seconds, safe_div
from rankforge.operators.features import running_sum_in_buckets, with_value_bucket
from rankforge.operators.ranking import top_k_per_group

# Quality targets, percentiles, thresholds and buckets.
TARGETS = {
    "ndcg_10": 0.78,
    "map_10": 0.73,
    "hit_rate_20": 0.91,
    "rmse": 0.84,
    "user_coverage": 0.942,
    "catalog_coverage": 0.785,
    "r2_score": 0.89,
}
LOWER_IS_BETTER = ("rmse",)
PERCENTILES = (0.5, 0.75, 0.9, 0.95, 0.99)
SLOW_MS = 100.0
#: Accuracy of quantile sketches.
KLL_K = 1024
LATENCY_BUCKETS_S = (0.001, 0.005, 0.01, 0.05, 0.1, 0.5)
LIST_SIZE_BUCKETS = (1, 5, 10, 20, 30, 50)
BANDS = {  # panel: (low, high, colour below low, between, above high)
    "ndcg_10": (0.7, 0.78, "red", "yellow", "green"),
    "cache_hit_rate": (0.8, 0.9, "red", "yellow", "green"),
    "error_rate": (0.01, 0.05, "green", "yellow", "red"),
}


def targets_table(spark) -> DataFrame:
    return spark.createDataFrame([(k, float(v)) for k, v in TARGETS.items()],
                                 "metric string, target double")


def current_values(history: DataFrame) -> DataFrame:
    """Q1: latest value per metric (ties on time broken by ``event_id``)."""
    return history.groupBy("metric").agg(
        F.max_by("value", F.struct("ts", "event_id")).alias("current"),
        F.max("ts").alias("last_ts"))


def target_report(current: DataFrame, targets: DataFrame, parity: bool = False) -> DataFrame:
    """Q2: current (0 if missing), target, achievement, meets_target.

    ``meets_target`` is ``current <= target`` for lower-is-better metrics
    (RMSE); ``parity=True`` keeps the reference's ``>=`` for every metric.
    """
    j = targets.join(current.select("metric", "current"), "metric", "left")
    cur = F.coalesce(F.col("current"), dbl(0.0))
    lower = F.col("metric").isin(*LOWER_IS_BETTER)
    meets = (cur >= F.col("target")) if parity else \
        F.when(lower, cur <= F.col("target")).otherwise(cur >= F.col("target"))
    return j.select("metric", cur.alias("current"), "target",
                    F.when(F.col("target") > 0, cur / F.col("target")).otherwise(dbl(0.0))
                    .alias("achievement_rate"), meets.alias("meets_target"))


def trend(history: DataFrame, window_size: int = 10) -> DataFrame:
    """Q3 (+ W5, G6, G7): least-squares slope of the last ``window_size``
    points against 0..n-1 and summary statistics of those points."""
    last = top_k_per_group(history, ["metric"], [F.col("ts").desc(), F.col("event_id").desc()],
                           window_size, rank_col="_r", salt_col="event_id")
    n = F.count(F.lit(1)).over(Window.partitionBy("metric"))
    last = last.withColumn("_x", (n - F.col("_r")).cast("double"))
    g = last.groupBy("metric").agg(
        F.count(F.lit(1)).alias("n_points"),
        F.regr_slope("value", "_x").alias("slope"),
        F.max_by("value", "_x").alias("current_value"),
        F.avg("value").alias("average_value"),
        F.stddev_pop("value").alias("std_deviation"),
        F.min("value").alias("min_value"), F.max("value").alias("max_value"))
    label = (F.when(F.col("n_points") < 2, "insufficient_data")
             .when(F.col("slope") > 0, "improving")
             .when(F.col("slope") < 0, "declining").otherwise("stable"))
    return g.withColumn("trend", label)


def exact_percentiles(df: DataFrame, value_col: str, percents: Sequence[float],
                      key_cols: Sequence[str]) -> DataFrame:
    """Exact percentiles (linear interpolation) per key as columns ``p50``, ...

    Rows are counted per value, running counts come from value buckets, and a
    percentile is the first value whose running count passes its position, so
    no task holds the values of a whole key.  Nulls are left out.
    """
    keys = list(key_cols)
    c = df.filter(F.col(value_col).isNotNull()).groupBy(*keys, F.col(value_col).alias("_v")) \
        .agg(F.count(F.lit(1)).alias("_cnt"))
    n = c.groupBy(*keys).agg(F.sum("_cnt").alias("_n"))
    c = running_sum_in_buckets(with_value_bucket(c, keys, "_v", "_vb"), keys, ["_v"], ["_cnt"],
                               "_vb", ["_upto"]).join(n, keys)
    aggs = []
    for p in percents:
        pos = dbl(p) * (F.col("_n") - F.lit(1))
        low = F.min(F.when(F.col("_upto") > F.floor(pos), F.col("_v")))
        high = F.min(F.when(F.col("_upto") > F.ceil(pos), F.col("_v")))
        aggs.append((low + (high - low) * F.max(pos - F.floor(pos)))
                    .alias(f"p{int(round(p * 100))}"))
    return c.groupBy(*keys).agg(*aggs)


def request_summary(req: DataFrame, exact: bool = True,
                    group_cols: Sequence[str] = ()) -> DataFrame:
    """Q4: latency percentiles, min/max/mean, slow requests, success rate,
    request rate (requests per second over the observed span)."""
    lat = F.col("latency_ms")
    names = [f"p{int(round(p * 100))}" for p in PERCENTILES]
    aggs = [F.count(F.lit(1)).alias("n_requests")]
    if not exact:
        aggs += [F.percentile_approx(lat, p, 10000).cast("double").alias(c)
                 for p, c in zip(PERCENTILES, names)]
    aggs += [F.min(lat).alias("min_ms"), F.max(lat).alias("max_ms"), F.avg(lat).alias("mean_ms"),
             F.sum(F.when(lat > dbl(SLOW_MS), 1).otherwise(0)).cast("long").alias("slow_requests"),
             F.avg(F.when(F.col("status") < 400, dbl(1.0)).otherwise(dbl(0.0)))
             .alias("success_rate"),
             F.min("ts").alias("_t0"), F.max("ts").alias("_t1")]
    req = req.withColumn("_all", F.lit(1))                 # one key where no other is given
    keys = list(group_cols) or ["_all"]
    g = req.groupBy(*keys).agg(*aggs)
    if exact:
        g = g.join(exact_percentiles(req, "latency_ms", PERCENTILES, keys), keys, "left")
    span = epoch_seconds("_t1") - epoch_seconds("_t0")
    return g.select(*group_cols, "n_requests", *names, "min_ms", "max_ms", "mean_ms",
                    "slow_requests", "success_rate",
                    safe_div(F.col("n_requests"), span).alias("request_rate"))


def windowed(req: DataFrame, minutes: int = 5) -> DataFrame:
    return req.withColumn("w", F.window(F.col("ts").cast("timestamp"), f"{minutes} minutes"))


def latency_windows(req: DataFrame, minutes: int = 5, exact: bool = True) -> DataFrame:
    """Q5: p50 / p95 latency per tumbling window.

    ``exact`` interpolates between exact ranks from value buckets, so no buffer
    holds the values of a window; otherwise one sketch a minute is folded.
    """
    if not exact:
        return fold_latency(latency_sketches(req), minutes, (0.5, 0.95))
    rows = windowed(req, minutes)
    n = rows.groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    return n.join(exact_percentiles(rows, "latency_ms", (0.5, 0.95), ["w"]), "w", "left")


def latency_sketches(req: DataFrame, k: int = KLL_K, ts: Column | None = None,
                     value_col: str = "latency_ms") -> DataFrame:
    """One mergeable quantile sketch (KLL) of all latencies a minute:
    (minute, n, sketch).  Batch and stream alike (a stream gives its watermarked
    column as ``ts``); nulls are left out.

    A sketch has a bounded size whatever the rows; ranks read from it (or from
    any merge) are off by less than about 2.3 / k ** 0.9 of the rows (0.44 % for
    1,024) in 99 of 100 cases, and exact up to ``k`` rows.
    """
    return (req.filter(F.col(value_col).isNotNull())
            .groupBy(F.window(F.col("ts").cast("timestamp") if ts is None else ts, "1 minute")
                     .alias("m"))
            .agg(F.count(F.lit(1)).alias("n"),
                 F.kll_sketch_agg_double(F.col(value_col).cast("double"), k).alias("sketch"))
            .select(F.col("m.start").alias("minute"), "n", "sketch"))


def fold_latency(sketches: DataFrame, minutes: int, percents: Sequence[float],
                 slide: int | None = None, k: int = KLL_K) -> DataFrame:
    """Percentiles per window of any length from minute sketches: (w, n, p50, ...).

    ``slide`` minutes between windows (default: they tumble).  A percentile p is
    the smallest value with a share of at least p of the rows up to it.
    """
    w = F.window("minute", f"{minutes} minutes", f"{slide or minutes} minutes").alias("w")
    g = sketches.groupBy(w).agg(F.sum("n").alias("n"),
                                F.kll_merge_agg_double("sketch", k).alias("s"))
    return g.select("w", "n", *[F.kll_sketch_get_quantile_double("s", F.lit(float(p)))
                                .alias(f"p{int(round(p * 100))}") for p in percents])


def error_windows(req: DataFrame, minutes: int = 5) -> DataFrame:
    """Q6: request rate and 5xx ratio per tumbling window."""
    return windowed(req, minutes).groupBy("w").agg(
        F.count(F.lit(1)).alias("n"),
        (F.count(F.lit(1)) / dbl(minutes * 60.0)).alias("request_rate"),
        F.avg(F.when(F.col("status") >= 500, dbl(1.0)).otherwise(dbl(0.0))).alias("error_ratio"))


def cache_hit_rate(req: DataFrame, group_cols: Sequence[str] = ("algorithm",)) -> DataFrame:
    """Q7: hits / (hits + misses) with zero guard."""
    g = req.groupBy(*group_cols).agg(
        F.sum(F.col("cache_hit")).cast("long").alias("hits"),
        F.sum(F.lit(1) - F.col("cache_hit")).cast("long").alias("misses"))
    return g.withColumn("hit_ratio", safe_div(F.col("hits"), F.col("hits") + F.col("misses")))


def active_users(req: DataFrame, window: str = "1 day", exact: bool = True) -> DataFrame:
    """Q8: distinct users per tumbling window (HLL estimate when not exact)."""
    agg = F.count_distinct("user_id") if exact else F.approx_count_distinct("user_id")
    return req.groupBy(F.window(F.col("ts").cast("timestamp"), window).alias("w")).agg(
        agg.alias("active_users"))


def inflight(req: DataFrame, bucket: str = "1 minute") -> DataFrame:
    """Q10: concurrent requests at each request start.

    +1 at start, -1 at end (start + latency).  A running sum over one global
    order would run in a single task, so it is computed in levels:
    a running sum inside each time bucket, plus the net total of the day's
    earlier buckets, plus that of all earlier days (one row a day in one order).
    """
    start = req.select("event_id", F.col("ts").cast("timestamp").alias("t"),
                       F.lit(1).alias("delta"))
    end = req.select("event_id", (F.col("ts").cast("timestamp")
                                  + F.make_dt_interval(secs=(F.col("latency_ms") / dbl(1000.0))
                                                       .cast("decimal(18,6)")))
                     .alias("t"), F.lit(-1).alias("delta"))
    ev = start.unionByName(end).withColumn("b", F.window("t", bucket).start)
    w = (Window.partitionBy("b").orderBy("t", "delta", "event_id")
         .rowsBetween(Window.unboundedPreceding, 0))
    ev = ev.withColumn("_in", F.sum("delta").over(w))
    tot = ev.groupBy("b").agg(F.sum("delta").alias("_net"))
    # Buckets are summed within their day, and only days in one order.
    tot = tot.withColumn("_day", F.date_trunc("day", "b"))
    days = tot.groupBy("_day").agg(F.sum("_net").alias("_dnet"))
    earlier = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = days.select("_day", F.coalesce(F.sum("_dnet").over(earlier), F.lit(0)).alias("_dcarry"))
    wb = Window.partitionBy("_day").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.join(days, "_day").select(
        "b", (F.coalesce(F.sum("_net").over(wb), F.lit(0)) + F.col("_dcarry")).alias("_carry"))
    j = ev.join(tot, "b")
    return j.filter(F.col("delta") == 1).select(
        "event_id", (F.col("_in") + F.col("_carry")).cast("long").alias("inflight"))


def band(value, low: float, high: float, below: str, mid: str, above: str):
    """Q11: threshold banding."""
    return (F.when(value < dbl(low), F.lit(below)).when(value < dbl(high), F.lit(mid))
            .otherwise(F.lit(above)))


def counters(increments: DataFrame) -> DataFrame:
    """V5: named counters = sum of increments per key."""
    return increments.groupBy("key").agg(F.sum("amount").cast("long").alias("value"))
