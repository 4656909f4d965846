"""Registered queries: streaming jobs (rows-only checks).

Each query replays messages derived from the given tables through a
Structured Streaming job with ``availableNow``, then returns the job's sink
as a batch DataFrame.  Working directories live below the shared
checkpoint root (``spark.checkpoint.dir``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from rankforge.functions import columns as C
from rankforge.operators import moments
from rankforge.operators import monitoring as MO
from rankforge.operators import profiles
from rankforge.plans import sql_prelude as P
from rankforge.plans.registry import register
from rankforge.session import scratch_path, written
from rankforge.sources.tables import Tables, interactions, items, users
from rankforge.streaming import jobs as J

AVAILABLE_NOW = {"availableNow": True}
N_SLICES = 4


def _interaction_source(spark, root, with_bad: bool = False):
    t = Tables(spark, root)
    # The join of lineitem and orders runs once, not for the time bounds and each slice.
    msgs = J.interaction_messages(written(interactions(t), "stream-rows"))
    if with_bad:
        # Undecodable messages derived from error events (truncated JSON).
        bad = t.events.filter(F.col("event_type") == "error").select(
            F.lit("user_interactions").alias("topic"),
            F.col("user_id").cast("string").alias("key"),
            F.concat(F.lit('{"user_id": '), F.col("user_id").cast("string")).alias("value"),
            F.lit(0.0).alias("_t"))
        msgs = msgs.unionByName(bad)
    base = scratch_path(spark, "stream")
    return base, lambda job: J.replay(msgs, base + "/source", N_SLICES, job)


def _event_source(spark, root, copies: int = 1):
    t = Tables(spark, root)
    base = scratch_path(spark, "stream")
    # Several files per slice, as a cluster would write them: one a core.
    files = max(4, spark.sparkContext.defaultParallelism)
    msgs = J.event_messages(t.events, copies).repartition(files)
    return base, lambda job: J.replay(msgs, base + "/source", N_SLICES, job)


@register("stream_ingest", ops="S6,S7,S10,X1,X2,F1,F3,V3", doubles=("rating", "timestamp"),
          sql=P.INTERACTIONS_ONLY + """
SELECT user_id, item_id, rating, interaction_type, "timestamp", session_id FROM inter""")
def stream_ingest(spark, root):
    base, replay = _interaction_source(spark, root, with_bad=True)
    paths = replay(lambda src: J.ingest(spark, src, base, AVAILABLE_NOW))
    good = spark.read.parquet(paths["interactions"]).select(
        "user_id", "item_id", "rating", "interaction_type", "timestamp", "session_id")
    return good


@register("stream_dead_letter", ops="F3", sql="""
SELECT CAST(user_id AS VARCHAR) AS key, 'undecodable' AS reject_reason
FROM events WHERE event_type = 'error'""")
def stream_dead_letter(spark, root):
    base, replay = _interaction_source(spark, root, with_bad=True)
    paths = replay(lambda src: J.ingest(spark, src, base, AVAILABLE_NOW))
    return spark.read.parquet(paths["dead_letter"]).select("key", "reject_reason")


@register("stream_features", ops="X3,X4,L1,L2,L3,L4,G3,F5")
def stream_features(spark, root):
    t = Tables(spark, root)
    base, replay = _interaction_source(spark, root)
    out = replay(lambda src: J.feature_job(spark, src, base, users(t), items(t),
                                           AVAILABLE_NOW))
    return spark.read.parquet(out["batch_stats"]).select("batch_id", "name", "value")


_PAIRS = [(a, b) for i, a in enumerate(J.feature_columns()) for b in J.feature_columns()[i:]]


@register("stream_moments", ops="X3,G3", doubles=("mean_a", "cov"), sql=P.INTERACTIONS_ONLY + """,
e AS (SELECT c.c_acctbal::DOUBLE AS user_acctbal, p.p_retailprice::DOUBLE AS item_price,
        p.p_size::DOUBLE AS item_size, i.rating, c.c_nationkey::DOUBLE AS user_nation,
        hour(make_timestamp(CAST(i."timestamp" AS BIGINT) * 1000000))::DOUBLE AS hour_of_day,
        (dayofweek(make_timestamp(CAST(i."timestamp" AS BIGINT) * 1000000)) + 1)::DOUBLE
          AS day_of_week,
        CASE WHEN dayofweek(make_timestamp(CAST(i."timestamp" AS BIGINT) * 1000000)) IN (0, 6)
             THEN 1.0 ELSE 0.0 END AS is_weekend
      FROM inter i JOIN customer c ON i.user_id = c.c_custkey JOIN part p ON i.item_id = p.p_partkey)
""" + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, count(*) AS n, avg({a}) AS mean_a, covar_samp({a}, {b}) AS cov "
    f"FROM e" for a, b in _PAIRS))
def stream_moments(spark, root):
    """Moments of every micro-batch, folded to those of the whole stream."""
    t = Tables(spark, root)
    base, replay = _interaction_source(spark, root)
    out = replay(lambda src: J.feature_job(spark, src, base, users(t), items(t),
                                           AVAILABLE_NOW))
    cols = J.feature_columns()
    whole = moments.merge_moments(spark.read.parquet(out["batch_moments"]), len(cols))
    return moments.covariances(whole, cols).select("a", "b", "n", "mean_a", "cov")


@register("stream_profiles", ops="X5,G11,S4", doubles=("avg_rating", "last_interaction"),
          sql=P.INTERACTIONS_ONLY + """
SELECT user_id, avg(rating) AS avg_rating, count(*) AS interaction_count,
       max("timestamp") AS last_interaction, CAST(count(DISTINCT item_id) AS INTEGER) AS n_items
FROM inter GROUP BY user_id""")
def stream_profiles(spark, root):
    t = Tables(spark, root)
    base, replay = _interaction_source(spark, root)
    out = replay(lambda src: J.feature_job(spark, src, base, users(t), items(t),
                                           AVAILABLE_NOW))
    merged = profiles.merge_profiles(spark.read.parquet(out["user_partials"]))
    return merged.select("user_id", "avg_rating", "interaction_count", "last_interaction",
                         F.size("interacted_items").alias("n_items"))


@register("stream_items", ops="X5,G11,G2", doubles=("avg_rating", "last_interaction"),
          sql=P.INTERACTIONS_ONLY + """
SELECT item_id, avg(rating) AS avg_rating, count(*) AS interaction_count,
       count(DISTINCT user_id) AS unique_users, max("timestamp") AS last_interaction
FROM inter GROUP BY item_id""")
def stream_items(spark, root):
    """Item partials of every micro-batch (bitmaps of users), folded at read."""
    t = Tables(spark, root)
    base, replay = _interaction_source(spark, root)
    out = replay(lambda src: J.feature_job(spark, src, base, users(t), items(t),
                                           AVAILABLE_NOW))
    return profiles.merge_items(spark.read.parquet(out["item_partials"]))


@register("stream_sessions", ops="X6", doubles=("duration_s",), sql="""
WITH g AS (
  SELECT user_id, ts, event_id,
         CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL
                OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)
                   >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS new_s
  FROM events),
s AS (SELECT *, sum(new_s) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                 ROWS UNBOUNDED PRECEDING) AS sid FROM g),
ss AS (SELECT user_id, min(ts) AS t0, max(ts) AS t1, count(*) AS n_events
       FROM s GROUP BY user_id, sid)
SELECT user_id, strftime(t0, '%Y-%m-%d %H:%M:%S.%f') AS session_start,
       epoch(t1) - epoch(t0) AS duration_s, n_events
FROM ss
WHERE t1 + INTERVAL 30 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 30 MINUTE""")
def stream_sessions(spark, root):
    """Sessions closed by the watermark (open ones stay in state)."""
    base, replay = _event_source(spark, root)
    s = spark.read.parquet(replay(
        lambda src: J.session_job(spark, src, base, trigger=AVAILABLE_NOW)))
    return s.select("user_id",
                    F.date_format("first_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("session_start"),
                    (C.epoch_seconds("last_ts") - C.epoch_seconds("first_ts")).alias("duration_s"),
                    "n_events")


@register("stream_rates", ops="X7", doubles=("request_rate",), sql="""
WITH w AS (
  SELECT time_bucket(INTERVAL 1 MINUTE, ts) - to_minutes(k) AS ws, event_type
  FROM events, range(0, 5) t(k))
SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n,
       CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS errors,
       count(*) / 300.0 AS request_rate
FROM w
WHERE ws + INTERVAL 5 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE
GROUP BY ws""")
def stream_rates(spark, root):
    """Sliding 5-minute windows emitted once the watermark passes them."""
    base, replay = _event_source(spark, root)
    r = spark.read.parquet(replay(
        lambda src: J.rates_job(spark, src, base, trigger=AVAILABLE_NOW)))
    return r.select(C.ts_text("window_start").alias("window_start"), "n",
                    F.col("errors").cast("long").alias("errors"), "request_rate")


@register("stream_dedup", ops="D8", doubles=("value",), sql="""
SELECT CASE event_type WHEN 'view' THEN 'recommendations_served'
                       WHEN 'error' THEN 'model_updates' ELSE 'user_interactions' END AS topic,
       event_id, user_id, event_type, value,
       strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts
FROM events""")
def stream_dedup(spark, root):
    base, replay = _event_source(spark, root, copies=3)
    d = spark.read.parquet(replay(
        lambda src: J.dedup_job(spark, src, base, trigger=AVAILABLE_NOW)))
    return d.select("topic", "event_id", "user_id", "event_type", "value",
                    F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"))


@register("stream_route", ops="S9", sql="""
SELECT CASE event_type WHEN 'view' THEN 'recommendations_served'
                       WHEN 'error' THEN 'model_updates' ELSE 'user_interactions' END AS topic,
       count(*) AS n
FROM events GROUP BY 1""")
def stream_route(spark, root):
    base, replay = _event_source(spark, root)
    paths = replay(lambda src: J.route_job(spark, src, base, AVAILABLE_NOW))
    parts = [spark.read.parquet(p).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
             for p in paths.values()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("stream_latency", ops="X7,Q5", doubles=("p50", "p95"), sql="""
WITH w AS (
  SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS m, value FROM events
  WHERE time_bucket(INTERVAL 1 MINUTE, ts) + INTERVAL 1 MINUTE
        <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE),
s AS (SELECT m - to_minutes(k) AS ws, value FROM w, range(0, 5) t(k))
SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n,
       quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.95) AS p95
FROM s GROUP BY 1""")
def stream_latency(spark, root):
    """Minute sketches of the stream, folded to 5-minute windows sliding by one."""
    base, replay = _event_source(spark, root)
    minutes = spark.read.parquet(replay(
        lambda src: J.latency_job(spark, src, base, trigger=AVAILABLE_NOW)))
    w = MO.fold_latency(minutes, 5, (0.5, 0.95), slide=1)
    return w.select(C.ts_text("w.start").alias("window_start"), "n", "p50", "p95")


@register("stream_ctr", ops="V6", sql="""
WITH served AS (SELECT event_id AS served_id, user_id, ts FROM events WHERE event_type = 'view'),
clicks AS (SELECT event_id AS click_id, user_id, ts FROM events WHERE event_type = 'click'),
hits AS (SELECT s.served_id, s.user_id, s.ts, c.click_id FROM served s JOIN clicks c
         ON c.user_id = s.user_id AND c.ts >= s.ts AND c.ts <= s.ts + INTERVAL 30 MINUTE),
mark AS (SELECT least((SELECT max(ts) FROM served), (SELECT max(ts) FROM clicks))
                - INTERVAL 10 MINUTE AS m),
allrows AS (
  SELECT served_id, user_id, ts, click_id FROM hits
  UNION ALL
  SELECT served_id, user_id, ts, NULL FROM served, mark
  WHERE served_id NOT IN (SELECT served_id FROM hits) AND ts + INTERVAL 30 MINUTE < m)
SELECT served_id, user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS served_ts,
  coalesce(CAST(click_id AS VARCHAR), 'none') AS click FROM allrows""")
def stream_ctr(spark, root):
    """V6: served lists with their clicks within 30 minutes, and lists that
    nobody clicked once the watermark has passed them."""
    base, replay = _event_source(spark, root)
    s = spark.read.parquet(replay(
        lambda src: J.ctr_job(spark, src, base, trigger=AVAILABLE_NOW)))
    return s.select("served_id", "user_id", F.date_format(
        "served_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("served_ts"),
        F.coalesce(F.col("click_id").cast("string"), F.lit("none")).alias("click"))


def _profile_state(spark, root):
    base, replay = _event_source(spark, root)
    return spark.read.parquet(replay(
        lambda src: J.profile_state_job(spark, src, base, trigger=AVAILABLE_NOW)))


@register("stream_recency", ops="W7,W6,X5", doubles=("since_last", "session_seconds"), sql="""
WITH g AS (SELECT event_id, user_id, ts,
             lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
s AS (SELECT *, sum(CASE WHEN prev IS NULL OR ts - prev >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
             OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid
      FROM g)
SELECT event_id, user_id, epoch_us(ts) / 1e6 - epoch_us(prev) / 1e6 AS since_last,
  (epoch_us(ts) - epoch_us(min(ts) OVER (PARTITION BY user_id, sid))) / 1e6 AS session_seconds
FROM s""")
def stream_recency(spark, root):
    """W7, W6 in the stream: seconds since the user's last event and since the
    session began, for every event, from state kept across restarts."""
    return _profile_state(spark, root).select("event_id", "user_id", "since_last",
                                              "session_seconds")


@register("stream_profile_state", ops="X5,G1", doubles=("value_sum",), sql="""
SELECT event_id, user_id,
  count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS n,
  sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS value_sum
FROM events""")
def stream_profile_state(spark, root):
    """The profile so far (events and the sum of their values) at every event."""
    return _profile_state(spark, root).select("event_id", "user_id", "n", "value_sum")
