"""Generated interaction tables (S12, S13): ``spark.range`` + expressions,
so generation itself is distributed and deterministic per row id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.functions.columns import clip, dbl

# The seed-data patterns (rows, users, items, sessions).
SMALL = dict(rows=1000, users=20, items=50, rating_mod=2, sessions=None)
LARGE = dict(rows=10000, users=1000, items=500, rating_mod=3, sessions=100)
START_EPOCH = 1640995200.0
TYPES = ("rating", "view", "purchase")


def modulo_interactions(spark: SparkSession, rows: int, users: int, items: int,
                        rating_mod: int, sessions: int | None) -> DataFrame:
    """user = i % users, item = i % items, rating = 3 + i % rating_mod,
    session = 'session_' || (i or i % sessions)."""
    i = F.col("id")
    sess = i if sessions is None else i % sessions
    return spark.range(rows).select(
        (i % users).alias("user_id"), (i % items).alias("item_id"),
        (F.lit(3) + i % rating_mod).cast("double").alias("rating"),
        F.element_at(F.array(*[F.lit(t) for t in TYPES]), (i % len(TYPES) + 1).cast("int"))
        .alias("interaction_type"),
        (dbl(START_EPOCH) + i.cast("double") * dbl(3600.0)).alias("timestamp"),
        F.concat(F.lit("session_"), sess.cast("string")).alias("session_id"))


def random_interactions(spark: SparkSession, n_users: int = 100, n_items: int = 50,
                        density: float = 0.1, seed: int = 42) -> DataFrame:
    """Sparse random ratings: each (user, item) cell is present with
    probability ``density``; rating N(3.5, 1) clipped to [1, 5].  Cells come
    from ``spark.range`` over the grid with seeded hash uniforms, so the
    result does not depend on partitioning."""
    cell = F.col("id")

    def unif(salt):
        h = F.pmod(F.xxhash64(cell, F.lit(seed), F.lit(salt)), F.lit(2147483647))
        return (h.cast("double") + dbl(0.5)) / dbl(2147483647.0)
    normal = F.sqrt(dbl(-2.0) * F.log(unif(1))) * F.cos(dbl(6.283185307179586) * unif(2))
    g = spark.range(n_users * n_items).filter(unif(0) < dbl(density))
    return g.select((cell / n_items).cast("long").alias("user_id"),
                    (cell % n_items).alias("item_id"),
                    clip(dbl(3.5) + normal, 1.0, 5.0).alias("rating"))
