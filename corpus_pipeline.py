"""Training-data pipeline over ``documents``: toxic documents go, one of each
group of near-duplicates stays, contaminated documents go, secrets are
redacted, and what is left is packed into sequences.

Every stage reads what its predecessor wrote as Parquet below the shared
checkpoint folder; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.llm import decontaminate, packing, secrets, simhash, toxicity
from rankforge.llm.common import fresh, settle, table
from rankforge.llm.queries import TOKENIZER
from rankforge.session import configure


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; a null text counts as empty."""
    configure(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    score, = fresh(docs, "score")
    return toxicity.score(docs, model, "text", score).filter(
        F.col(score) < toxicity.THRESHOLD).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id.

    Texts without words are one group; of rows that share an id one stays; rows
    without an id stay; an empty table gives no rows.  Other columns, whatever their
    names, stay as they are, here and in the stages below.
    """
    configure(spark)
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item.  Null and empty texts hold none; rows that
    share an id (or have none) go or stay together; an empty table gives no rows."""
    configure(spark)
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark.  Null texts stay null; repeated rows
    stay; an empty table gives no rows."""
    configure(spark)
    return secrets.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2048 tokens.  Null
    and empty texts are the end id alone; repeated rows are documents of their own; an
    empty table gives no rows."""
    configure(spark)
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated), ("secrets", redact_secrets),
    ("packing", pack_sequences)]

#: Hashes, classifier and column generation have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
