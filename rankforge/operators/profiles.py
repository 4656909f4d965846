"""Aggregations: user profiles, item features, mergeable partials, stats.

All are ``groupBy`` aggregations, which Spark combines map-side before the
shuffle; a hot key therefore costs one partial row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.functions.columns import dbl, safe_div


def user_profiles(df: DataFrame) -> DataFrame:
    """G1: avg rating, count(*), last interaction, sorted set of items."""
    return df.groupBy("user_id").agg(
        F.avg("rating").alias("avg_rating"),
        F.count(F.lit(1)).alias("interaction_count"),
        F.max("timestamp").alias("last_interaction"),
        F.array_sort(F.collect_set("item_id")).alias("interacted_items"))


def item_features(df: DataFrame) -> DataFrame:
    """Avg rating, count(*), distinct users, last interaction per item."""
    return df.groupBy("item_id").agg(
        F.avg("rating").alias("avg_rating"),
        F.count(F.lit(1)).alias("interaction_count"),
        F.count_distinct("user_id").alias("unique_users"),
        F.max("timestamp").alias("last_interaction"))


def profile_partials(df: DataFrame, batch_id) -> DataFrame:
    """Mergeable per-batch user partials (input of G11).

    ``avg`` is not mergeable, so we keep the sum and the non-null count.
    """
    return df.groupBy("user_id").agg(
        F.sum("rating").alias("rating_sum"),
        F.count("rating").alias("rating_count"),
        F.count(F.lit(1)).alias("interaction_count"),
        F.max("timestamp").alias("last_interaction"),
        F.collect_set("item_id").alias("interacted_items")).withColumn(
        "batch_id", F.lit(batch_id).cast("long"))


def merge_profiles(partials: DataFrame) -> DataFrame:
    """Fold partial rows into one row per user.

    Equal to ``user_profiles`` over the union of the batches.
    """
    return partials.groupBy("user_id").agg(
        (F.sum("rating_sum") / F.sum("rating_count")).alias("avg_rating"),
        F.sum("interaction_count").alias("interaction_count"),
        F.max("last_interaction").alias("last_interaction"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("interacted_items"))))
        .alias("interacted_items"))


def distinct_bitmaps(df: DataFrame, key: str, member: str) -> DataFrame:
    """Exact mergeable sets: (key, bucket, members), a bitmap of the 64 member
    ids of each bucket that the key has met.

    A row is three numbers, so a set takes no more than its members do, however
    they are spread, and a 64th of that where they are dense; a key with very
    many members has very many rows.
    """
    bit = F.call_function("shiftleft", F.lit(1).cast("long"),
                          F.pmod(F.col(member).cast("long"), F.lit(64)).cast("int"))
    return (df.filter(F.col(member).isNotNull())
            .groupBy(key, F.call_function("shiftright", F.col(member).cast("long"), F.lit(6)).alias("bucket"))
            .agg(F.bit_or(bit).alias("members")))


def distinct_counts(bitmaps: DataFrame, key: str, out_col: str) -> DataFrame:
    """(key, out_col): members of each key over any number of bitmap tables."""
    merged = bitmaps.groupBy(key, "bucket").agg(F.bit_or("members").alias("members"))
    return merged.groupBy(key).agg(F.sum(F.bit_count("members")).cast("long").alias(out_col))


def item_partials(df: DataFrame, batch_id) -> DataFrame:
    """Mergeable item partials of one batch: one row of sums for each item
    (``bucket`` null) and one row for each bitmap of its users."""
    sums = df.groupBy("item_id").agg(
        F.sum("rating").alias("rating_sum"),
        F.count("rating").alias("rating_count"),
        F.count(F.lit(1)).alias("interaction_count"),
        F.max("timestamp").alias("last_interaction"))
    users = distinct_bitmaps(df, "item_id", "user_id")
    return sums.unionByName(users, allowMissingColumns=True).withColumn(
        "batch_id", F.lit(batch_id).cast("long"))


def merge_items(partials: DataFrame) -> DataFrame:
    """Partials of any batches to one row per item, equal to ``item_features``
    over the union of the batches."""
    sums = partials.filter(F.col("bucket").isNull()).groupBy("item_id").agg(
        (F.sum("rating_sum") / F.sum("rating_count")).alias("avg_rating"),
        F.sum("interaction_count").alias("interaction_count"),
        F.max("last_interaction").alias("last_interaction"))
    users = distinct_counts(partials.filter(F.col("bucket").isNotNull()), "item_id",
                            "unique_users")
    return sums.join(users, "item_id", "left").select(
        "item_id", "avg_rating", "interaction_count",
        F.coalesce("unique_users", F.lit(0).cast("long")).alias("unique_users"),
        "last_interaction")


def item_popularity(df: DataFrame) -> DataFrame:
    """Interaction count / max count over all items, in [0, 1].

    The maximum is a scalar subquery (one value), not a global window.
    """
    counts = df.groupBy("item_id").agg(F.count(F.lit(1)).alias("cnt"))
    mx = counts.agg(F.max("cnt")).scalar()
    return counts.select("item_id", "cnt", safe_div(F.col("cnt"), mx).alias("popularity"))


def matrix_shape(df: DataFrame) -> DataFrame:
    """D5 + G4: users x items, interactions, density, and an HLL estimate."""
    a = df.agg(F.count_distinct("user_id").alias("n_users"),
               F.count_distinct("item_id").alias("n_items"),
               F.count(F.lit(1)).alias("n_interactions"),
               F.approx_count_distinct("item_id").alias("n_items_approx"))
    return a.select("n_users", "n_items", "n_interactions",
                    safe_div(F.col("n_interactions"),
                             F.col("n_users") * F.col("n_items")).alias("density"),
                    "n_items_approx")


NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)


def feature_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """G3 + D7: count/mean/stddev/min/max of numeric columns, as long
    (name = '{column}_{stat}', value).  String columns are skipped (T19)."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.count(x).cast("double").alias(f"{c}_count"), F.avg(x).alias(f"{c}_mean"),
                 F.stddev_samp(x).alias(f"{c}_stddev"), F.min(x).alias(f"{c}_min"),
                 F.max(x).alias(f"{c}_max")]
    wide = df.agg(*aggs)
    names = [a for c in columns for a in
             (f"{c}_count", f"{c}_mean", f"{c}_stddev", f"{c}_min", f"{c}_max")]
    return wide.unpivot([], names, "name", "value")


def type_counts(df: DataFrame, types: Sequence[str]) -> DataFrame:
    """Per-user count of each interaction type (conditional counts)."""
    return df.groupBy("user_id").agg(*[
        F.sum(F.when(F.col("interaction_type") == t, 1).otherwise(0)).cast("long")
        .alias(f"{t}_count") for t in types])


def pivot_sum(df: DataFrame, row: str, pivot_col: str, values: Sequence[str],
              value_col: str) -> DataFrame:
    """Wide table with an explicit value list (no extra distinct job), 0 fill."""
    return (df.groupBy(row).pivot(pivot_col, list(values)).agg(F.sum(value_col))
            .na.fill(0.0))


def best_by_min(df: DataFrame, group_cols: Sequence[str], value_col: str, ord_col: str,
                payload_col: str) -> DataFrame:
    """Arg-min of ``value_col`` (first ``ord_col`` on ties)."""
    return df.groupBy(*group_cols).agg(
        F.min_by(F.col(payload_col), F.struct(F.col(value_col), F.col(ord_col)))
        .alias(payload_col),
        F.min(value_col).alias(value_col))


def histogram(df: DataFrame, value_col: str, bounds: Sequence[float],
              group_cols: Sequence[str] = ()) -> DataFrame:
    """Cumulative ``le`` buckets plus +Inf, sum and count."""
    aggs = [F.sum(F.when(F.col(value_col) <= dbl(b), 1).otherwise(0)).cast("long")
            .alias(f"le_{b}") for b in bounds]
    aggs += [F.count(F.lit(1)).alias("le_inf"), F.sum(value_col).alias("sum"),
             F.count(F.lit(1)).alias("count")]
    return df.groupBy(*group_cols).agg(*aggs)
