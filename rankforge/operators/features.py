"""Row-level features, dedup, enrichment joins and per-user sequences
(P1-P14, F1-F5, D1-D3, D6, J1-J2, J7, J9, W6-W7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankforge.functions.columns import (clip, dbl, from_epoch, is_weekend)
from rankforge.operators.ranking import latest_per_key

# Total order used for "last row wins": time first, then the unique
# lineitem key, then every remaining column (rows equal under all of these
# are identical, so the pick is deterministic).
ORDER_COLS = ("timestamp", "l_orderkey", "l_linenumber", "l_suppkey")
PAYLOAD_COLS = ("rating", "interaction_type", "session_id")

# Known interaction types and the valid rating range.
KNOWN_TYPES = ("rating", "view", "purchase", "click", "cart_add", "page_view")
RATING_MIN, RATING_MAX = 0.0, 5.0


def dedup_last(df: DataFrame, keys=("user_id", "item_id"), order_cols=ORDER_COLS,
               payload_cols=PAYLOAD_COLS) -> DataFrame:
    """Keep the last row per (user, item) under a total order.

    Written as max(struct) aggregation instead of a row_number window: it is
    combined map-side, so a user or item with a huge share of the rows does
    not pile up in one window partition.
    """
    return latest_per_key(df, keys, order_cols, payload_cols)


def last_nonnull(df: DataFrame, keys=("user_id", "item_id"), order_cols=ORDER_COLS,
                 value_cols=PAYLOAD_COLS) -> DataFrame:
    """D3: per column, the last non-null value per key (pandas ``groupby.last``).

    ``max_by`` ignores rows whose ordering value is NULL, so a NULL value
    never wins over an earlier non-null one.
    """
    order = F.struct(*[F.col(c) for c in order_cols])
    return df.groupBy(*keys).agg(*[
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in value_cols])


def time_features(df: DataFrame, epoch_col: str = "timestamp") -> DataFrame:
    """Event time from epoch seconds, hour, day of week (1 = Sunday),
    weekend flag."""
    t = from_epoch(F.col(epoch_col))
    return (df.withColumn("interaction_time", t)
            .withColumn("hour_of_day", F.hour("interaction_time"))
            .withColumn("day_of_week", F.dayofweek("interaction_time"))
            .withColumn("is_weekend", is_weekend(F.col("interaction_time"))))


def validate(df: DataFrame) -> DataFrame:
    """NULL-safe domain check; adds ``is_valid`` and ``reject_reason``.

    Split into valid/reject outputs with two filters on ``is_valid``.
    """
    reason = (F.when(F.col("user_id").isNull(), F.lit("missing_user"))
              .when(F.col("item_id").isNull(), F.lit("missing_item"))
              .when(F.col("rating").isNull(), F.lit("missing_rating"))
              .when((F.col("rating") < dbl(RATING_MIN)) | (F.col("rating") > dbl(RATING_MAX)),
                    F.lit("rating_out_of_range"))
              .when(~F.coalesce(F.col("interaction_type").isin(*KNOWN_TYPES), F.lit(False)),
                    F.lit("unknown_type")))
    return df.withColumn("reject_reason", reason).withColumn(
        "is_valid", F.col("reject_reason").isNull())


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    v = validate(df)
    return v.filter(F.col("is_valid")), v.filter(~F.col("is_valid"))


def enrich(df: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """J1 + J2: left join user then item attributes (USING join, key once).

    Dimension tables are not force-broadcast: they grow with the data, so
    the size-checked broadcast threshold and AQE choose the strategy.
    """
    return df.join(users, "user_id", "left").join(items, "item_id", "left")


def session_features(df: DataFrame, session_col: str = "session_id",
                     copies_col: str | None = None) -> DataFrame:
    """Session duration (max - min time) and interactions per session, a row of
    ``copies_col`` as so many.

    Aggregate per session (map-side combined), then join back, instead of a
    window over a possibly huge session.
    """
    s = df.groupBy(session_col).agg(
        (F.max("timestamp") - F.min("timestamp")).alias("session_duration"),
        (F.sum(copies_col) if copies_col else F.count(F.lit(1))).alias("interactions_in_session"))
    return df.join(s, session_col, "left")


def profile_lookup(df: DataFrame, user_prof: DataFrame, item_prof: DataFrame) -> DataFrame:
    """Profile features with the reference's defaults for unknown keys."""
    up = user_prof.select("user_id", F.col("avg_rating").alias("_uavg"),
                          F.col("interaction_count").alias("_ucnt"))
    ip = item_prof.select("item_id", F.col("popularity").alias("_ipop"),
                          F.col("avg_rating").alias("_iavg"))
    j = df.join(up, "user_id", "left").join(ip, "item_id", "left")
    return (j.withColumn("user_avg_rating", F.coalesce("_uavg", dbl(3.5)))
            .withColumn("user_interaction_count", F.coalesce("_ucnt", F.lit(0).cast("long")))
            .withColumn("item_popularity", F.coalesce("_ipop", dbl(0.0)))
            .withColumn("item_avg_rating", F.coalesce("_iavg", dbl(4.0)))
            .drop("_uavg", "_ucnt", "_ipop", "_iavg"))


def lag_in_buckets(df: DataFrame, key_cols: Sequence[str], order_cols: Sequence,
                   value_col: str, bucket_col: str, out_col: str) -> DataFrame:
    """``lag(value)`` per key under ``order_cols``, computed in two levels.

    ``bucket_col`` must be monotone in the order (e.g. a time bucket).  The
    window runs per (key, bucket), so a heavy key is spread over many
    tasks; the first row of a bucket takes the last value of the key's
    previous non-empty bucket from the small per-(key, bucket) aggregate.
    """
    keys = list(key_cols)
    order = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    w = Window.partitionBy(*keys, bucket_col).orderBy(*order)
    b = df.withColumn("_lag", F.lag(value_col).over(w))
    last = b.groupBy(*keys, bucket_col).agg(
        F.max_by(F.col(value_col), F.struct(*order)).alias("_blast"))
    wb = Window.partitionBy(*keys).orderBy(bucket_col)
    last = last.withColumn("_carry", F.lag("_blast").over(wb)).drop("_blast")
    return (b.join(last, [*keys, bucket_col], "left")
            .withColumn(out_col, F.coalesce(F.col("_lag"), F.col("_carry")))
            .drop("_lag", "_carry"))


def running_sum_in_buckets(df: DataFrame, key_cols: Sequence[str], order_cols: Sequence,
                           value_cols: Sequence[str], bucket_col: str,
                           out_cols: Sequence[str], inclusive: bool = True) -> DataFrame:
    """Running ``sum`` of each value column per key (including or excluding
    the current row) in two levels: one window per (key, bucket) plus the
    totals of all earlier buckets of the key (prefix sums over the small
    per-bucket table).  All columns share one window and one join."""
    keys = list(key_cols)
    order = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    w = (Window.partitionBy(*keys, bucket_col).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1))
    b = df
    for v, o in zip(value_cols, out_cols):
        b = b.withColumn(f"_in_{o}", F.coalesce(F.sum(v).over(w), F.lit(0)))
    tot = b.groupBy(*keys, bucket_col).agg(*[F.sum(v).alias(f"_bt_{o}")
                                             for v, o in zip(value_cols, out_cols)])
    wb = (Window.partitionBy(*keys).orderBy(bucket_col)
          .rowsBetween(Window.unboundedPreceding, -1))
    tot = tot.select(*keys, bucket_col, *[
        F.coalesce(F.sum(f"_bt_{o}").over(wb), F.lit(0)).alias(f"_carry_{o}") for o in out_cols])
    b = b.join(tot, [*keys, bucket_col], "left")
    for o in out_cols:
        b = b.withColumn(o, F.col(f"_in_{o}") + F.col(f"_carry_{o}")) \
            .drop(f"_in_{o}", f"_carry_{o}")
    return b


def with_value_bucket(df: DataFrame, key_cols: Sequence[str], value_col: str, bucket_col: str,
                      buckets: int = 256) -> DataFrame:
    """``df`` with a bucket number that grows with the value: buckets of about
    equal numbers of rows within each key (approximate quantiles, one small
    row a key), so that an outlier does not fill one bucket with all others."""
    at = F.array(*[dbl(i / buckets) for i in range(1, buckets)])
    bounds = df.groupBy(*key_cols).agg(F.array_distinct(F.percentile_approx(
        value_col, at, 10 * buckets)).alias("_bounds"))
    below = F.filter("_bounds", lambda b: b < F.col(value_col))
    return df.join(bounds, list(key_cols)).withColumn(bucket_col, F.size(below)).drop("_bounds")


def recency(df: DataFrame, user_col: str = "user_id", tie_cols: Sequence[str] = (),
            bucket_seconds: float = 86400.0 * 30, least_by: Sequence[str] = ()) -> DataFrame:
    """Seconds since the user's previous interaction (NULL for the first),
    by ``lag_in_buckets`` over time buckets (skew-aware).

    With ``least_by``, the least of all rows of the user that are equal in these
    columns and in time (NULL where one of these is): they share a bucket, so
    they are where they have to be already."""
    b = df.withColumn("_tb", F.floor(F.col("timestamp") / dbl(bucket_seconds)))
    r = lag_in_buckets(b, [user_col], ["timestamp", *tie_cols], "timestamp", "_tb", "_prev")
    since = F.col("timestamp") - F.col("_prev")
    if least_by:
        same = [user_col, *least_by, "timestamp"]
        known = F.lit(True)
        for c in same:
            known = known & F.col(c).isNotNull()
        since = F.when(known, F.min(since).over(Window.partitionBy("_tb", *same)))
    return r.withColumn("time_since_last_interaction", since).drop("_prev", "_tb")


def profile_asof(df: DataFrame, user_col: str = "user_id",
                 tie_cols: Sequence[str] = ORDER_COLS[1:] + ("item_id", "rating"),
                 bucket_seconds: float = 86400.0 * 30) -> DataFrame:
    """Profile known strictly before each event (no leakage): prior
    count and prior average rating of the user (exclusive running sums in
    time buckets, skew-aware)."""
    order = ["timestamp", *tie_cols]
    b = (df.withColumn("_tb", F.floor(F.col("timestamp") / dbl(bucket_seconds)))
         .withColumn("_one", F.lit(1))
         .withColumn("_has", F.when(F.col("rating").isNotNull(), 1).otherwise(0)))
    b = running_sum_in_buckets(b, [user_col], order, ["_one", "rating", "_has"], "_tb",
                               ["_c", "_s", "_n"], inclusive=False)
    return (b.withColumn("prior_count", F.col("_c").cast("long"))
            .withColumn("prior_avg_rating",
                        F.when(F.col("_n") > 0, F.col("_s") / F.col("_n")))
            .drop("_c", "_s", "_n", "_tb", "_one", "_has"))


def gap_sessions(df: DataFrame, user_col: str, ts_col: str, tie_col: str,
                 gap_seconds: float = 1800.0, bucket_seconds: float = 86400.0) -> DataFrame:
    """W6 without a session id: a new session starts when the gap to the
    user's previous event is >= ``gap_seconds``.  Session ids are running
    counts of session starts; both steps run in time buckets, then one
    grouped aggregation per (user, session) -- no per-user merge task."""
    t = F.unix_micros(F.col(ts_col).cast("timestamp")) / dbl(1e6)
    b = df.withColumn("_t", t).withColumn("_tb", F.floor(F.col("_t") / dbl(bucket_seconds)))
    b = lag_in_buckets(b, [user_col], ["_t", tie_col], "_t", "_tb", "_prev")
    b = b.withColumn("_new", F.when(F.col("_prev").isNull()
                                    | (F.col("_t") - F.col("_prev") >= dbl(gap_seconds)), 1)
                     .otherwise(0))
    b = running_sum_in_buckets(b, [user_col], ["_t", tie_col], ["_new"], "_tb", ["session_no"])
    return b.groupBy(user_col, "session_no").agg(
        F.min(ts_col).alias("session_start"), F.max(ts_col).alias("session_last"),
        F.count(F.lit(1)).alias("n_events"))


def distinct_keys(df: DataFrame) -> DataFrame:
    """Distinct users and items as (kind, id)."""
    u = df.select(F.lit("user").alias("kind"), F.col("user_id").alias("id")).distinct()
    i = df.select(F.lit("item").alias("kind"), F.col("item_id").alias("id")).distinct()
    return u.unionByName(i)


def user_item_lists(df: DataFrame) -> DataFrame:
    """Sorted distinct items per user as an array."""
    return df.groupBy("user_id").agg(F.array_sort(F.collect_set("item_id")).alias("items"))


def clip_rating(c, lo: float = 1.0, hi: float = 5.0):
    """P7."""
    return clip(c, lo, hi)
