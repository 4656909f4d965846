"""Registered queries: sources, projections, dedup, joins, aggregations, windows."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.functions import columns as C
from rankforge.operators import features, profiles
from rankforge.plans import sql_prelude as P
from rankforge.plans.canonical import Canonical
from rankforge.plans.registry import register
from rankforge.sources import events as ev
from rankforge.session import scratch_path
from rankforge.sources.tables import Tables, bucketed_tables, interactions, items, users

IC = "user_id, item_id, rating, interaction_type, \"timestamp\", session_id"


# --- S1 -------------------------------------------------------------------
@register("scan_interactions", ops="S1", doubles=("rating", "timestamp"),
          sql=P.INTERACTIONS_ONLY + f" SELECT {IC} FROM inter")
def scan_interactions(spark, root):
    return interactions(Tables(spark, root))


@register("scan_bucketed", ops="S1,S3", doubles=("rating", "timestamp"),
          sql=P.INTERACTIONS_ONLY + f" SELECT {IC} FROM inter")
def scan_bucketed(spark, root):
    """The interactions from tables bucketed by order key: no exchange."""
    path = scratch_path(spark, "bucketed")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = "t_" + path.rsplit("-", 1)[-1]
    t = bucketed_tables(Tables(spark, root), path, name, buckets)
    return interactions(t)


# --- D2 / D3 ----------------------------------------------------------------
@register("dedup_last", ops="D2", doubles=("rating", "timestamp"),
          sql=P.BASE + f" SELECT {IC}, l_orderkey, l_linenumber FROM dedup")
def dedup_last(spark, root):
    return Canonical(spark, root, materialize=False).dedup.select(
        "user_id", "item_id", "rating", "interaction_type", "timestamp", "session_id",
        "l_orderkey", "l_linenumber")


@register("last_nonnull", ops="D3", doubles=("rating",), sql=P.INTERACTIONS_ONLY + """
SELECT user_id, item_id,
  arg_max(rating, ("timestamp", l_orderkey, l_linenumber, l_suppkey))
    FILTER (WHERE rating IS NOT NULL) AS rating,
  arg_max(interaction_type, ("timestamp", l_orderkey, l_linenumber, l_suppkey))
    FILTER (WHERE interaction_type IS NOT NULL) AS interaction_type,
  arg_max(session_id, ("timestamp", l_orderkey, l_linenumber, l_suppkey))
    FILTER (WHERE session_id IS NOT NULL) AS session_id
FROM inter GROUP BY user_id, item_id""")
def last_nonnull(spark, root):
    raw = interactions(Tables(spark, root), with_keys=True)
    return features.last_nonnull(raw)


# --- G1 / G2 / G11 / G12 ----------------------------------------------------------
@register("user_profiles", ops="G1", doubles=("avg_rating", "last_interaction"),
          sql=P.INTERACTIONS_ONLY + """
SELECT user_id, avg(rating) AS avg_rating, count(*) AS interaction_count,
       max("timestamp") AS last_interaction,
       string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR))
         AS interacted_items_hash_src, count(DISTINCT item_id) AS n_items
FROM inter GROUP BY user_id""")
def user_profiles(spark, root):
    p = profiles.user_profiles(interactions(Tables(spark, root)))
    # Arrays are compared as sorted text (text sort order, like the oracle).
    return p.select("user_id", "avg_rating", "interaction_count", "last_interaction",
                    F.array_join(F.array_sort(F.transform("interacted_items",
                                                          lambda x: x.cast("string"))), ",")
                    .alias("interacted_items_hash_src"),
                    F.size("interacted_items").cast("long").alias("n_items"))


@register("item_features", ops="G2", doubles=("avg_rating", "last_interaction"),
          sql=P.INTERACTIONS_ONLY + """
SELECT item_id, avg(rating) AS avg_rating, count(*) AS interaction_count,
       count(DISTINCT user_id) AS unique_users, max("timestamp") AS last_interaction
FROM inter GROUP BY item_id""")
def item_features(spark, root):
    return profiles.item_features(interactions(Tables(spark, root)))


@register("profile_merge", ops="G11,S4,S5", doubles=("avg_rating", "last_interaction"),
          sql=P.INTERACTIONS_ONLY + """
SELECT user_id, avg(rating) AS avg_rating, count(*) AS interaction_count,
       max("timestamp") AS last_interaction, count(DISTINCT item_id) AS n_items
FROM inter GROUP BY user_id""")
def profile_merge(spark, root):
    """Partials per yearly batch, folded: equals the one-shot profile."""
    df = interactions(Tables(spark, root))
    batch = F.year(C.from_epoch(F.col("timestamp")))
    parts = df.withColumn("_b", batch).groupBy("_b", "user_id").agg(
        F.sum("rating").alias("rating_sum"), F.count("rating").alias("rating_count"),
        F.count(F.lit(1)).alias("interaction_count"),
        F.max("timestamp").alias("last_interaction"),
        F.collect_set("item_id").alias("interacted_items"))
    m = profiles.merge_profiles(parts)
    return m.select("user_id", "avg_rating", "interaction_count", "last_interaction",
                    F.size("interacted_items").cast("long").alias("n_items"))


@register("item_merge", ops="G11,G2", doubles=("avg_rating", "last_interaction"),
          sql=P.INTERACTIONS_ONLY + """
SELECT item_id, avg(rating) AS avg_rating, count(*) AS interaction_count,
       count(DISTINCT user_id) AS unique_users, max("timestamp") AS last_interaction
FROM inter GROUP BY item_id""")
def item_merge(spark, root):
    """Item partials per yearly batch with bitmaps of users, folded: equals
    the one-shot features with their exact distinct users."""
    df = interactions(Tables(spark, root)).withColumn(
        "year", F.year(C.from_epoch(F.col("timestamp"))))
    years = [r["year"] for r in df.select("year").distinct().orderBy("year").collect()]
    parts = None
    for y in years:                           # a handful of years, one partial table each
        part = profiles.item_partials(df.filter(F.col("year").eqNullSafe(F.lit(y))), y)
        parts = part if parts is None else parts.unionByName(part)
    return profiles.merge_items(parts if parts is not None else profiles.item_partials(df, 0))


@register("profile_evolve", ops="S5", doubles=("avg_rating", "n_items"),
          sql=P.INTERACTIONS_ONLY + """
SELECT 0 AS batch, user_id, avg(rating) AS avg_rating, count(*) AS interaction_count,
       CAST(NULL AS DOUBLE) AS n_items
FROM inter WHERE "timestamp" < 946684800.0 GROUP BY user_id
UNION ALL
SELECT 1 AS batch, user_id, avg(rating), count(*), CAST(count(DISTINCT item_id) AS DOUBLE)
FROM inter WHERE "timestamp" >= 946684800.0 GROUP BY user_id""")
def profile_evolve(spark, root):
    """An old batch without ``interacted_items`` unioned by name with a
    newer batch that has it; the missing column reads as NULL."""
    df = interactions(Tables(spark, root))
    old = profiles.user_profiles(df.filter(F.col("timestamp") < C.dbl(946684800.0))) \
        .drop("interacted_items", "last_interaction").withColumn("batch", F.lit(0))
    new = profiles.user_profiles(df.filter(F.col("timestamp") >= C.dbl(946684800.0))) \
        .drop("last_interaction").withColumn("batch", F.lit(1))
    u = old.unionByName(new, allowMissingColumns=True)
    return u.select("batch", "user_id", "avg_rating", "interaction_count",
                    F.size("interacted_items").cast("double").alias("n_items")) \
        .withColumn("n_items", F.when(F.col("batch") == 0, F.lit(None).cast("double"))
                    .otherwise(F.col("n_items")))


@register("item_popularity", ops="G12", doubles=("popularity",),
          sql=P.SPLIT_BASE + "," + P.RECS.strip() +
          " SELECT item_id, cnt, popularity FROM popularity")
def item_popularity(spark, root):
    return Canonical(spark, root).popularity


@register("matrix_shape", ops="D5,G4", doubles=("density",), sql=P.BASE + """
SELECT count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items,
       count(*) AS n_interactions,
       CAST(count(*) AS DOUBLE) / (count(DISTINCT user_id) * count(DISTINCT item_id)) AS density
FROM dedup""")
def matrix_shape(spark, root):
    return profiles.matrix_shape(Canonical(spark, root, materialize=False).dedup) \
        .drop("n_items_approx")


@register("feature_stats", ops="G3,D7", doubles=("value",), sql=P.INTERACTIONS_ONLY + """
SELECT name, value FROM (
  SELECT CAST(count(rating) AS DOUBLE) AS rating_count, avg(rating) AS rating_mean,
         stddev_samp(rating) AS rating_stddev, min(rating) AS rating_min,
         max(rating) AS rating_max,
         CAST(count("timestamp") AS DOUBLE) AS timestamp_count,
         avg("timestamp") AS timestamp_mean, stddev_samp("timestamp") AS timestamp_stddev,
         min("timestamp") AS timestamp_min, max("timestamp") AS timestamp_max
  FROM inter) UNPIVOT (value FOR name IN (rating_count, rating_mean, rating_stddev,
     rating_min, rating_max, timestamp_count, timestamp_mean, timestamp_stddev,
     timestamp_min, timestamp_max))""")
def feature_stats(spark, root):
    df = interactions(Tables(spark, root))
    return profiles.feature_stats(df, ["rating", "timestamp"])


@register("distinct_keys", ops="D1", sql=P.INTERACTIONS_ONLY + """
SELECT DISTINCT 'user' AS kind, user_id AS id FROM inter
UNION ALL SELECT DISTINCT 'item' AS kind, item_id AS id FROM inter""")
def distinct_keys(spark, root):
    return features.distinct_keys(interactions(Tables(spark, root)))


@register("user_item_lists", ops="D6", sql=P.BASE + """
SELECT user_id, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS items,
       count(*) AS n
FROM dedup GROUP BY user_id""")
def user_item_lists(spark, root):
    lists = features.user_item_lists(Canonical(spark, root, materialize=False).dedup)
    return lists.select("user_id", F.array_join("items", ",").alias("items"),
                        F.size("items").cast("long").alias("n"))


@register("pivot_matrix", ops="D4", doubles=("purchase", "rating", "view"),
          sql=P.BASE + """
SELECT user_id,
  coalesce(sum(CASE WHEN interaction_type = 'purchase' THEN rating END), 0.0) AS purchase,
  coalesce(sum(CASE WHEN interaction_type = 'rating' THEN rating END), 0.0) AS rating,
  coalesce(sum(CASE WHEN interaction_type = 'view' THEN rating END), 0.0) AS "view"
FROM dedup GROUP BY user_id""")
def pivot_matrix(spark, root):
    d = Canonical(spark, root, materialize=False).dedup
    return profiles.pivot_sum(d, "user_id", "interaction_type",
                              ["purchase", "rating", "view"], "rating")


@register("type_counts", ops="W8", sql=P.INTERACTIONS_ONLY + """
SELECT user_id,
  CAST(count(*) FILTER (WHERE interaction_type = 'click') AS BIGINT) AS click_count,
  CAST(count(*) FILTER (WHERE interaction_type = 'view') AS BIGINT) AS view_count,
  CAST(count(*) FILTER (WHERE interaction_type = 'purchase') AS BIGINT) AS purchase_count,
  CAST(count(*) FILTER (WHERE interaction_type = 'cart_add') AS BIGINT) AS cart_add_count,
  CAST(count(*) FILTER (WHERE interaction_type = 'page_view') AS BIGINT) AS page_view_count
FROM inter GROUP BY user_id""")
def type_counts(spark, root):
    return profiles.type_counts(interactions(Tables(spark, root)),
                                ["click", "view", "purchase", "cart_add", "page_view"])


# --- P1-P5 ----------------------------------------------------------------
@register("time_features", ops="P1,P2,P3,P4,P5", doubles=("value",), sql="""
SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour_of_day,
       CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week,
       CASE WHEN dayofweek(ts) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS interaction_time,
       0.0 AS session_placeholder, value
FROM events""")
def time_features(spark, root):
    e = Tables(spark, root).events.select("event_id", "ts", "value")
    e = e.withColumn("timestamp", C.epoch_seconds("ts"))
    f = features.time_features(e)
    return f.select("event_id", "hour_of_day", "day_of_week", "is_weekend",
                    C.ts_text("interaction_time").alias("interaction_time"),
                    C.dbl(0.0).alias("session_placeholder"), "value")


@register("case_label", ops="P6", sql="""
SELECT c_custkey AS user_id,
       CASE WHEN c_acctbal >= 0 THEN 'credit' ELSE 'debit' END AS balance_label,
       CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS user_gender
FROM customer""")
def case_label(spark, root):
    c = Tables(spark, root).customer
    return c.select(F.col("c_custkey").alias("user_id"),
                    F.when(F.col("c_acctbal") >= 0, "credit").otherwise("debit")
                    .alias("balance_label"),
                    F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("user_gender"))


@register("clip_rating", ops="P7,P8", doubles=("pred", "clipped", "centered_floor"),
          sql=P.FULL + """
SELECT user_id, item_id, pred,
       greatest(2.0::DOUBLE, least(4.0::DOUBLE, pred)) AS clipped,
       greatest(0.0::DOUBLE, pred - 3.0) AS centered_floor
FROM scored""")
def clip_rating(spark, root):
    s = Canonical(spark, root).scored
    return s.select("user_id", "item_id", "pred",
                    C.clip(F.col("pred"), 2.0, 4.0).alias("clipped"),
                    C.floor_zero(F.col("pred") - C.dbl(3.0)).alias("centered_floor"))


@register("cast_cols", ops="P9", sql="""
SELECT event_id, CAST(user_id AS VARCHAR) AS user_key,
       TRY_CAST(props->>'k' AS INTEGER) AS k,
       CAST(TRY_CAST(CASE WHEN event_type = 'view' THEN props->>'k' ELSE event_type END
                     AS INTEGER) AS DOUBLE) AS type_as_int,
       CAST(CAST(value AS DECIMAL(10, 2)) AS VARCHAR) AS value_text
FROM events""")
def cast_cols(spark, root):
    e = Tables(spark, root).events
    return e.select("event_id", F.col("user_id").cast("string").alias("user_key"),
                    F.get_json_object("props", "$.k").try_cast("int").alias("k"),
                    F.when(F.col("event_type") == "view", F.get_json_object("props", "$.k"))
                    .otherwise(F.col("event_type")).try_cast("int").cast("double")
                    .alias("type_as_int"),
                    F.col("value").cast(T.DecimalType(10, 2)).cast("string").alias("value_text"))


@register("rec_key", ops="P10,P11", sql="""
SELECT event_id,
  concat_ws(':', 'rec', CAST(user_id AS VARCHAR),
            (['svd', 'nmf', 'hybrid'])[CAST(props->>'k' AS INTEGER) % 3 + 1],
            CAST(CAST(props->>'k' AS INTEGER) % 50 + 1 AS VARCHAR),
            CAST(CAST(props->>'k' AS INTEGER) % 2 AS VARCHAR)) AS cache_key,
  sha256(concat_ws(':', 'user', CAST(user_id AS VARCHAR))) AS user_hash
FROM events""")
def rec_key(spark, root):
    r = ev.requests(Tables(spark, root).events)
    return r.select("event_id",
                    C.rec_key(F.col("user_id"), F.col("algorithm"), F.col("n_recs"),
                              F.col("exclude_seen")).alias("cache_key"),
                    C.namespaced_sha256(F.lit("user"), F.col("user_id")).alias("user_hash"))


@register("parse_props", ops="S7,P12", sql="""
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       len(json_keys(props)) AS n_keys
FROM events""")
def parse_props(spark, root):
    e = Tables(spark, root).events
    m = F.from_json("props", T.MapType(T.StringType(), T.StringType()))
    return e.select("event_id", m.alias("ctx")).select(
        "event_id", F.col("ctx")["k"].try_cast("int").alias("k"),
        F.size(F.map_keys("ctx")).cast("bigint").alias("n_keys"))


@register("event_envelope", ops="S8", sql="""
SELECT CASE event_type WHEN 'view' THEN 'recommendations_served'
                       WHEN 'error' THEN 'model_updates'
                       ELSE 'user_interactions' END AS topic,
       CAST(user_id AS VARCHAR) AS key,
       json_object('event_id', event_id, 'user_id', user_id, 'event_type', event_type,
                   'value', value, 'timestamp', strftime(ts, '%Y-%m-%d %H:%M:%S'))::VARCHAR AS value
FROM events""")
def event_envelope(spark, root):
    return ev.envelope(Tables(spark, root).events)


@register("dead_letter", ops="F3", sql="""
SELECT event_id, props FROM events
WHERE TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) IS NULL""")
def dead_letter(spark, root):
    _, bad = ev.decode_props(Tables(spark, root).events)
    return bad.select("event_id", "props")


@register("validate", ops="F1", sql=P.INTERACTIONS_ONLY + """
SELECT CASE WHEN user_id IS NULL THEN 'missing_user'
            WHEN item_id IS NULL THEN 'missing_item'
            WHEN rating IS NULL THEN 'missing_rating'
            WHEN rating < 0 OR rating > 5 THEN 'rating_out_of_range'
            WHEN interaction_type NOT IN ('rating', 'view', 'purchase', 'click', 'cart_add',
                                          'page_view') OR interaction_type IS NULL
              THEN 'unknown_type' END AS reject_reason,
       count(*) AS n
FROM inter GROUP BY 1""")
def validate(spark, root):
    v = features.validate(interactions(Tables(spark, root)))
    return v.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


@register("validate_rejects", ops="F1", sql=P.INTERACTIONS_ONLY + """,
bent AS (SELECT CASE WHEN l_linenumber = 2 THEN NULL ELSE user_id END AS user_id,
                CASE WHEN l_linenumber = 3 THEN NULL ELSE item_id END AS item_id,
                CASE WHEN l_linenumber = 4 THEN NULL
                     WHEN l_linenumber = 5 THEN rating + 5 ELSE rating END AS rating,
                CASE WHEN l_linenumber = 6 THEN 'other' ELSE interaction_type END
                  AS interaction_type
         FROM inter)
SELECT CASE WHEN user_id IS NULL THEN 'missing_user'
            WHEN item_id IS NULL THEN 'missing_item'
            WHEN rating IS NULL THEN 'missing_rating'
            WHEN rating < 0 OR rating > 5 THEN 'rating_out_of_range'
            WHEN interaction_type = 'other' THEN 'unknown_type' END AS reject_reason,
       count(*) AS n
FROM bent GROUP BY 1""")
def validate_rejects(spark, root):
    """F1 on rows that are spoilt by line number, so that every reason occurs."""
    line = F.col("l_linenumber")
    i = interactions(Tables(spark, root), with_keys=True)
    i = i.withColumn("user_id", F.when(line != 2, F.col("user_id"))) \
        .withColumn("item_id", F.when(line != 3, F.col("item_id"))) \
        .withColumn("rating", F.when(line == 5, F.col("rating") + 5).when(line != 4, F.col("rating"))) \
        .withColumn("interaction_type", F.when(line == 6, "other")
                    .otherwise(F.col("interaction_type")))
    return features.validate(i).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


@register("dead_letter_rejects", ops="F3", sql="""
SELECT event_id, left(props, length(props) - 1) AS props FROM events WHERE event_type = 'error'""")
def dead_letter_rejects(spark, root):
    """F3 on payloads of error events that lost their last character."""
    e = Tables(spark, root).events
    cut = F.expr("left(props, length(props) - 1)")
    _, bad = ev.decode_props(e.withColumn("props", F.when(F.col("event_type") == "error", cut)
                                          .otherwise(F.col("props"))))
    return bad.select("event_id", "props")


@register("type_counts_events", ops="W8", sql="""
SELECT user_id, CAST(count(*) FILTER (WHERE event_type = 'click') AS BIGINT) AS click_count,
  CAST(count(*) FILTER (WHERE event_type = 'view') AS BIGINT) AS view_count,
  CAST(count(*) FILTER (WHERE event_type = 'purchase') AS BIGINT) AS purchase_count
FROM events GROUP BY user_id""")
def type_counts_events(spark, root):
    e = Tables(spark, root).events.withColumnRenamed("event_type", "interaction_type")
    return profiles.type_counts(e, ["click", "view", "purchase"])


@register("orphan_rows_filtered", ops="F4", sql="""
SELECT e.user_id AS id, count(*) AS n FROM events e
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = e.user_id
                                             AND c.c_mktsegment <> 'BUILDING')
GROUP BY e.user_id""")
def orphan_rows_filtered(spark, root):
    """F4 against the customers outside one market segment."""
    t = Tables(spark, root)
    cust = t.customer.filter(F.col("c_mktsegment") != "BUILDING") \
        .select(F.col("c_custkey").alias("id"))
    return t.events.select(F.col("user_id").alias("id")).join(cust, "id", "left_anti") \
        .groupBy("id").agg(F.count(F.lit(1)).alias("n"))


@register("orphan_rows", ops="F4", sql="""
SELECT 'event_user' AS kind, e.user_id AS id, count(*) AS n FROM events e
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = e.user_id) GROUP BY e.user_id
UNION ALL
SELECT 'lineitem_part', l.l_partkey, count(*) FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey) GROUP BY l.l_partkey
UNION ALL
SELECT 'order_customer', o.o_custkey, count(*) FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)
GROUP BY o.o_custkey""")
def orphan_rows(spark, root):
    t = Tables(spark, root)
    cust = t.customer.select(F.col("c_custkey").alias("id"))
    part = t.part.select(F.col("p_partkey").alias("id"))
    e = t.events.select(F.col("user_id").alias("id")).join(cust, "id", "left_anti")
    li = t.lineitem.select(F.col("l_partkey").alias("id")).join(part, "id", "left_anti")
    o = t.orders.select(F.col("o_custkey").alias("id")).join(cust, "id", "left_anti")

    def cnt(df, kind):
        return df.groupBy("id").agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(kind).alias("kind"), "id", "n")
    return cnt(e, "event_user").unionByName(cnt(li, "lineitem_part")) \
        .unionByName(cnt(o, "order_customer"))


# --- J1 / J2 / J7 / J9 --------------------------------------------------------------
@register("enrich", ops="J1,J2", doubles=("rating", "user_acctbal", "item_price"),
          sql=P.INTERACTIONS_ONLY + """
SELECT i.item_id, i.user_id, i.rating, i.l_orderkey, i.l_linenumber,
       c.c_acctbal AS user_acctbal, c.c_mktsegment AS user_segment, n.n_name AS user_location,
       r.r_name AS user_region, p.p_type AS item_category, p.p_brand AS item_brand,
       p.p_retailprice AS item_price
FROM inter i
LEFT JOIN customer c ON i.user_id = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN part p ON i.item_id = p.p_partkey""")
def enrich(spark, root):
    t = Tables(spark, root)
    df = interactions(t, with_keys=True)
    e = features.enrich(df, users(t), items(t))
    return e.select("item_id", "user_id", "rating", "l_orderkey", "l_linenumber",
                    "user_acctbal", "user_segment", "user_location", "user_region",
                    "item_category", "item_brand", "item_price")


@register("profile_features", ops="J7", doubles=("user_avg_rating", "item_popularity",
                                                 "item_avg_rating"),
          sql=P.SPLIT_BASE + "," + P.RECS.strip() + """,
uprof AS (SELECT user_id, avg(rating) AS ua, count(*) AS uc FROM train GROUP BY user_id),
iprof AS (SELECT p.item_id, p.popularity, a.ia FROM popularity p
          JOIN (SELECT item_id, avg(rating) AS ia FROM train GROUP BY item_id) a
          ON p.item_id = a.item_id)
SELECT t.user_id, t.item_id,
       coalesce(u.ua, 3.5) AS user_avg_rating, coalesce(u.uc, 0) AS user_interaction_count,
       coalesce(i.popularity, 0.0) AS item_popularity, coalesce(i.ia, 4.0) AS item_avg_rating
FROM test t LEFT JOIN uprof u ON t.user_id = u.user_id
LEFT JOIN iprof i ON t.item_id = i.item_id""")
def profile_features(spark, root):
    c = Canonical(spark, root)
    up = profiles.user_profiles(c.train)
    ia = c.train.groupBy("item_id").agg(F.avg("rating").alias("avg_rating"))
    ip = c.popularity.join(ia, "item_id")
    out = features.profile_lookup(c.test.select("user_id", "item_id"), up, ip)
    return out.select("user_id", "item_id", "user_avg_rating", "user_interaction_count",
                      "item_popularity", "item_avg_rating")


@register("profile_asof", ops="J9", doubles=("prior_avg_rating",), sql=P.INTERACTIONS_ONLY + """
SELECT user_id, item_id, l_orderkey, l_linenumber, l_suppkey,
  CAST(count(*) OVER w AS BIGINT) AS prior_count,
  sum(rating) OVER w / nullif(count(rating) OVER w, 0) AS prior_avg_rating
FROM inter
WINDOW w AS (PARTITION BY user_id ORDER BY "timestamp", l_orderkey, l_linenumber, l_suppkey,
                                         item_id, rating
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def profile_asof(spark, root):
    df = interactions(Tables(spark, root), with_keys=True)
    a = features.profile_asof(df)
    return a.select("user_id", "item_id", "l_orderkey", "l_linenumber", "l_suppkey", "prior_count",
                    "prior_avg_rating")


# --- W6 / W7 ----------------------------------------------------------------
@register("session_features", ops="W6", doubles=("session_duration",),
          sql=P.INTERACTIONS_ONLY + """
SELECT session_id, max("timestamp") - min("timestamp") AS session_duration,
       count(*) AS interactions_in_session, count(DISTINCT user_id) AS n_users
FROM inter GROUP BY session_id""")
def session_features(spark, root):
    df = interactions(Tables(spark, root))
    s = features.session_features(df)
    return s.groupBy("session_id").agg(
        F.first("session_duration").alias("session_duration"),
        F.first("interactions_in_session").alias("interactions_in_session"),
        F.count_distinct("user_id").alias("n_users"))


@register("event_sessions", ops="W6", doubles=("duration_s",), sql="""
WITH g AS (
  SELECT user_id, ts, event_id,
         CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL
                OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)
                   >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS new_s
  FROM events),
s AS (SELECT *, sum(new_s) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                 ROWS UNBOUNDED PRECEDING) AS sid FROM g)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS session_start,
       epoch(max(ts)) - epoch(min(ts)) AS duration_s, count(*) AS n_events
FROM s GROUP BY user_id, sid""")
def event_sessions(spark, root):
    """W6 without a session id: 30-minute inactivity sessions per user (the
    batch twin of the streaming X6), skew-aware gap sessions."""
    e = Tables(spark, root).events.select("user_id", "ts", "event_id")
    g = features.gap_sessions(e, "user_id", "ts", "event_id", 1800.0)
    return g.select("user_id", C.ts_text("session_start").alias("session_start"),
                    (C.epoch_seconds("session_last") - C.epoch_seconds("session_start"))
                    .alias("duration_s"), "n_events")


@register("recency", ops="W7", doubles=("time_since_last_interaction",), sql="""
SELECT event_id, user_id,
  epoch(ts) - epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))
    AS time_since_last_interaction
FROM events""")
def recency(spark, root):
    e = Tables(spark, root).events.select("event_id", "user_id", "ts")
    e = e.withColumn("timestamp", C.epoch_seconds("ts"))
    r = features.recency(e, tie_cols=["event_id"], bucket_seconds=86400.0)
    return r.select("event_id", "user_id", "time_since_last_interaction")
