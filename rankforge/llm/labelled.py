"""Bounded samples of labelled texts, and classification thresholds."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold_of(id_col: str, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string")) % folds


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, limit: int,
                    id_col: str = "doc_id", text_col: str = "text") -> pd.DataFrame:
    """At most ``limit`` labelled rows (text, label), those with the smallest
    hash of the id among the ids that ``train`` selects.

    Ids are chosen from ``labels`` alone, so only chosen documents' texts
    move.  Labels that are null or disagree between rows of an id are left
    out, as are labels without a document; of rows that share an id one stays.
    """
    chosen = (labels.filter(train & F.col(label).isNotNull()).groupBy(id_col)
              .agg(F.min(label).alias("label"), F.max(label).alias("high"))
              .filter("label = high").select(F.col(id_col).alias("id"), "label")
              .orderBy(F.xxhash64("id"), "id").limit(limit))
    # At most ``limit`` rows of two numbers.
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")) \
        .join(F.broadcast(chosen), "id")
    sample = found.groupBy("id").agg(F.min(F.struct("text", "label")).alias("s")) \
        .select("id", "s.*").toPandas()
    sample = sample.sort_values("id", kind="stable", ignore_index=True)
    sample["text"] = sample["text"].fillna("")
    return sample


def shuffled(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).permutation(n)
