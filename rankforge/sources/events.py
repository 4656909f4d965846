"""Event-table views: request log stand-in, message envelopes, JSON decode
(S7, S8, S9, F3, V6).

The ``events`` table is the stand-in for the request/message logs:
status = 500 for type 'error' else 200, latency = value (ms), and request
attributes derived from ``props.k``.  The labels carry no meaning beyond
giving the log operators real rows to work on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.functions.columns import ts_text

# Algorithms, topics.
ALGORITHMS = ("svd", "nmf", "hybrid")
TOPIC_INTERACTIONS = "user_interactions"
TOPIC_SERVED = "recommendations_served"
TOPIC_MODEL = "model_updates"

PROPS_SCHEMA = T.StructType([T.StructField("k", T.IntegerType(), True)])


def props_k():
    return F.get_json_object("props", "$.k").try_cast("int")


def requests(events: DataFrame) -> DataFrame:
    """Request-log view of ``events``."""
    k = props_k()
    algo = F.element_at(F.array(*[F.lit(a) for a in ALGORITHMS]), (k % 3) + 1)
    return events.select(
        "event_id", "ts", "user_id", "event_type",
        F.when(F.col("event_type") == "error", F.lit(500)).otherwise(F.lit(200)).alias("status"),
        F.col("value").alias("latency_ms"),
        algo.alias("algorithm"),
        (k % 2).alias("cache_hit"),
        ((k % 50) + 1).alias("n_recs"),
        ((k % 2) == 1).alias("exclude_seen"),
        F.when(F.col("event_type") == "view", F.lit("/recommendations"))
        .when(F.col("event_type") == "click", F.lit("/interactions"))
        .otherwise(F.lit("/health")).alias("endpoint"),
        F.when(F.col("event_type").isin("view", "click"), F.lit("POST"))
        .otherwise(F.lit("GET")).alias("method"))


def topic_of(event_type) -> F.Column:
    return (F.when(event_type == "view", F.lit(TOPIC_SERVED))
            .when(event_type == "error", F.lit(TOPIC_MODEL))
            .otherwise(F.lit(TOPIC_INTERACTIONS)))


def envelope(events: DataFrame) -> DataFrame:
    """(topic, key, value) message rows; key = user id as text, value =
    JSON of the event.  Written as-is by a Kafka sink or a file sink."""
    body = F.struct("event_id", "user_id", "event_type", "value",
                    ts_text("ts").alias("timestamp"))
    return events.select(topic_of(F.col("event_type")).alias("topic"),
                         F.col("user_id").cast("string").alias("key"),
                         F.to_json(body).alias("value"))


def decode_props(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S7 + F3: decode ``props``; rows that do not decode go to a
    dead-letter output instead of silently becoming NULL rows."""
    parsed = events.withColumn("_p", F.from_json("props", PROPS_SCHEMA))
    ok = F.col("_p.k").isNotNull()
    good = parsed.filter(ok).withColumn("k", F.col("_p.k")).drop("_p")
    bad = parsed.filter(~ok | F.col("_p").isNull()).drop("_p")
    return good, bad
