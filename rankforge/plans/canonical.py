"""Canonical inputs shared by the metric, model and serving queries.

  dedup    D2 over all interactions
  train    dedup rows before the cutoff; test = the rest
  truth    test rows with rating >= 4
  pool       all train items ranked by interactions
  seen     distinct train (user, item)
  recs     popularity top-N per truth user, seen items excluded
  scored   test rows with a bias-model prediction (L14)
  popularity  train count / max count (G12)
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.functions.columns import clip, dbl
from rankforge.operators import features, profiles, ranking
from rankforge.session import written
from rankforge.sources.tables import Tables, interactions

# Fixed values of the canonical evaluation.
CUTOFF_EPOCH = 946684800.0      # 2000-01-01 00:00:00 UTC
RELEVANT_RATING = 4.0
TOP_N = 20
RATING_LO, RATING_HI = 1.0, 5.0


@dataclass
class Canonical:
    """Lazy canonical inputs.  With ``materialize=True`` the deduplicated
    interactions (user, item, rating and time, which is all that the derived
    inputs read) are written once (Parquet below the shared checkpoint
    directory) and every derived input scans that table, with its columns
    pruned and the cutoff pushed down: jobs with many metric branches then pay
    the big join + dedup shuffle once, and lineage is cut, so a lost executor
    re-reads the written table.
    ``materialize_recs`` does the same for the recommendation lists, for
    jobs that read them in several branches (the evaluation report)."""
    spark: SparkSession
    root: str
    materialize: bool = True
    materialize_recs: bool = False

    @cached_property
    def t(self) -> Tables:
        return Tables(self.spark, self.root)

    @cached_property
    def raw(self) -> DataFrame:
        return interactions(self.t, with_keys=True)

    @cached_property
    def dedup(self) -> DataFrame:
        if not self.materialize:
            return features.dedup_last(self.raw)
        # The rows' order ends with the payload, rating first: the others choose no rating.
        return written(features.dedup_last(self.raw, payload_cols=("rating",)).select(
            "user_id", "item_id", "rating", "timestamp"), "dedup")

    @cached_property
    def train(self) -> DataFrame:
        return self.dedup.filter(F.col("timestamp") < dbl(CUTOFF_EPOCH))

    @cached_property
    def test(self) -> DataFrame:
        return self.dedup.filter(F.col("timestamp") >= dbl(CUTOFF_EPOCH))

    @cached_property
    def truth(self) -> DataFrame:
        return self.test.filter(F.col("rating") >= dbl(RELEVANT_RATING)).select("user_id",
                                                                             "item_id")

    @cached_property
    def seen(self) -> DataFrame:
        return self.train.select("user_id", "item_id")

    @cached_property
    def pool(self) -> DataFrame:
        return ranking.popularity_pool(self.train)

    @cached_property
    def recs(self) -> DataFrame:
        r = ranking.popularity_recs(self.truth.select("user_id"), self.seen, self.pool, TOP_N)
        # Only worth it when several branches read the lists.
        return written(r, "lists") if self.materialize_recs else r

    @cached_property
    def popularity(self) -> DataFrame:
        return profiles.item_popularity(self.train)

    @cached_property
    def scored(self) -> DataFrame:
        return bias_predict(self.train, self.test)

    def total_items(self):
        return self.t.part.agg(F.count(F.lit(1))).scalar()

    def total_users(self):
        return self.t.customer.agg(F.count(F.lit(1))).scalar()


def bias_predict(train: DataFrame, test: DataFrame) -> DataFrame:
    """pred = clip(mu + (user mean - mu) + (item mean - mu), 1, 5).

    A missing user or item mean adds 0.  ``mu`` is a scalar subquery.
    """
    mu = train.agg(F.avg("rating")).scalar()
    ub = train.groupBy("user_id").agg(F.avg("rating").alias("_um"))
    ib = train.groupBy("item_id").agg(F.avg("rating").alias("_im"))
    j = test.select("user_id", "item_id", "rating").join(ub, "user_id", "left") \
        .join(ib, "item_id", "left")
    pred = mu + F.coalesce(F.col("_um") - mu, dbl(0)) + F.coalesce(F.col("_im") - mu, dbl(0))
    return j.select("user_id", "item_id", "rating",
                    clip(pred, RATING_LO, RATING_HI).alias("pred"))
