"""Structured Streaming jobs.

Source: a message directory of JSON lines ``(topic, key, value)`` -- the
same columns a Kafka source yields (the Kafka connector is not on this
classpath; with it, swap ``message_stream`` for ``readStream.format("kafka")``
and keep everything downstream).  Sinks are parquet directories below the
shared checkpoint root; every query has its own checkpoint, so a restarted
job resumes from its last committed offsets.

Micro-batch work (``foreachBatch``) is idempotent by ``batch_id``: partial
tables are written with dynamic partition overwrite, so a replayed batch
replaces its own output instead of appending twice.  Errors propagate (the
batch fails and is retried) rather than being logged and dropped.
"""

from __future__ import annotations

import os
from collections.abc import Callable

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rankforge.functions.columns import from_epoch, is_weekend
from rankforge.operators import features, moments, monitoring, profiles
from rankforge.sources.tables import STREAM_INTERACTION_SCHEMA

MESSAGE_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()), T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType())])

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()),
    T.StructField("timestamp", T.StringType())])

DEFAULT_TRIGGER = {"processingTime": "10 seconds"}
PCA_SHARE = 0.33
#: Of the message files: JSON lines take about a sixth.
CODEC = "gzip"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# --- producer side (S8 sink) -------------------------------------------------
def interaction_messages(inter: DataFrame) -> DataFrame:
    """Interaction rows as ``user_interactions`` messages with a context map."""
    ctx = F.create_map(F.lit("source"), F.lit("batch_replay"),
                       F.lit("type"), F.col("interaction_type"))
    body = F.struct("user_id", "item_id", "rating", "interaction_type", "timestamp",
                    "session_id", ctx.alias("context"))
    return inter.select(F.lit("user_interactions").alias("topic"),
                        F.col("user_id").cast("string").alias("key"),
                        F.to_json(body).alias("value"), F.col("timestamp").alias("_t"))


def event_messages(events: DataFrame, copies: int = 1) -> DataFrame:
    """Event rows as messages; ``copies`` > 1 replays each message like a
    producer retry (input of the duplicate-suppression job)."""
    from rankforge.sources.events import topic_of
    body = F.struct("event_id", "user_id", "event_type", "value",
                    F.date_format(F.col("ts").cast("timestamp"),
                                  "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"))
    m = events.select(topic_of(F.col("event_type")).alias("topic"),
                      F.col("user_id").cast("string").alias("key"),
                      F.to_json(body).alias("value"),
                      F.unix_micros(F.col("ts").cast("timestamp")).alias("_t"))
    if copies > 1:
        m = m.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("_copy")
    return m


def _slices(messages: DataFrame, n_slices: int) -> list[DataFrame]:
    """Time slices in order.  Bounds are approximate quantiles of ``_t``
    (``n_slices`` numbers on the driver)."""
    bounds = messages.approxQuantile("_t", [i / n_slices for i in range(1, n_slices)], 0.001)
    edges = [None] + sorted(set(bounds)) + [None]
    out = []
    for lo, hi in zip(edges[:-1], edges[1:]):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (F.col("_t") > F.lit(lo))
        if hi is not None:
            cond = cond & (F.col("_t") <= F.lit(hi))
        out.append(messages.filter(cond).sortWithinPartitions("_t").drop("_t"))
    return out


def write_messages(messages: DataFrame, path: str, n_slices: int) -> str:
    """Write messages as ``n_slices`` time slices, one append per slice in time
    order; each slice is written by all executors in parallel."""
    for part in _slices(messages, n_slices):
        part.write.mode("append").json(path, compression=CODEC)
    return path


def replay(messages: DataFrame, path: str, n_slices: int, job: Callable):
    """Append one time slice, run ``job(path)`` to the end of its input, append
    the next.  A slice is one micro-batch however many files it has, so the
    watermark moves only after all of its rows.  Returns the job's last result."""
    out = None
    for part in _slices(messages, n_slices):
        part.write.mode("append").json(path, compression=CODEC)
        out = job(path)
    return out


# --- source side (S6, S7) ----------------------------------------------------
def message_stream(spark: SparkSession, path: str,
                   files_per_trigger: int | None = None) -> DataFrame:
    """``files_per_trigger`` must not split files of one time span between
    micro-batches if a watermark follows: rows behind it are dropped as late."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


_CORRUPT = "_corrupt_record"
_DECODE_SCHEMA = T.StructType(STREAM_INTERACTION_SCHEMA.fields
                              + [T.StructField(_CORRUPT, T.StringType(), True)])


def decode_interactions(messages: DataFrame) -> DataFrame:
    """JSON value to typed columns.  A malformed value does not become a
    NULL struct (PERMISSIVE parsing yields NULL fields), so the raw text is
    captured in a corrupt-record column and flagged ``_bad``; the message
    key is kept for the dead-letter output."""
    parsed = messages.filter(F.col("topic") == "user_interactions").select(
        "key", F.from_json(F.col("value"), _DECODE_SCHEMA,
                           {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
        .alias("data"))
    return parsed.select("key", *[F.col(f"data.{f.name}")
                                  for f in STREAM_INTERACTION_SCHEMA.fields],
                         (F.col("data").isNull() | F.col(f"data.{_CORRUPT}").isNotNull())
                         .alias("_bad"))


def decode_events(messages: DataFrame) -> DataFrame:
    parsed = messages.select("topic", F.from_json("value", EVENT_SCHEMA).alias("e"))
    return parsed.select("topic", "e.event_id", "e.user_id", "e.event_type", "e.value",
                         F.to_timestamp("e.timestamp").alias("ts"))


def state_partitions(spark: SparkSession) -> int:
    """Stateful operators keep one state store per shuffle partition, fixed
    in the checkpoint when the query first starts.  Size it to the cluster
    (2 x default parallelism), not to the batch ``spark.sql.shuffle.partitions``."""
    return max(2, 2 * spark.sparkContext.defaultParallelism)


def _start(df: DataFrame, name: str, ckpt: str, trigger: dict | None,
           sink: str | None = None, fmt: str = "parquet", mode: str = "append",
           batch_fn: Callable | None = None):
    spark = df.sparkSession
    w = df.writeStream.queryName(name).option("checkpointLocation", ckpt).outputMode(mode)
    w = w.trigger(**(trigger or DEFAULT_TRIGGER))
    previous = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions(spark)))
    try:
        if batch_fn is not None:
            return w.foreachBatch(batch_fn).start()
        return w.format(fmt).option("path", sink).start()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", previous)


def run_to_completion(query) -> None:
    """Block until an ``availableNow`` query has drained its input; failures
    surface as exceptions."""
    query.awaitTermination()
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(str(exc))


# --- jobs -------------------------------------------------------------------
def ingest(spark: SparkSession, source: str, root: str, trigger=None) -> dict[str, str]:
    """S6 + F1 + V3: decode, validate, append valid rows to the interactions
    table and rejects to a dead-letter table."""
    msgs = message_stream(spark, source)
    dec = features.validate(decode_interactions(msgs).drop("context"))
    dec = dec.withColumn("reject_reason",
                         F.when(F.col("_bad"), F.lit("undecodable"))
                         .otherwise(F.col("reject_reason"))).drop("_bad")
    valid_path = os.path.join(root, "interactions")
    dead_path = os.path.join(root, "dead_letter")

    def route(batch: DataFrame, batch_id: int):
        batch = batch.persist()
        try:
            good = batch.filter(F.col("reject_reason").isNull()).drop("reject_reason",
                                                                       "is_valid", "key")
            bad = batch.filter(F.col("reject_reason").isNotNull())
            # Overwrite of the batch's own partition: replay-safe.
            good.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite") \
                .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id") \
                .parquet(valid_path)
            bad.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite") \
                .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id") \
                .parquet(dead_path)
        finally:
            batch.unpersist()

    q = _start(dec, "ingest", os.path.join(root, "_ckpt_ingest"), trigger, batch_fn=route)
    run_to_completion(q)
    return {"interactions": valid_path, "dead_letter": dead_path}


def feature_columns() -> list[str]:
    return ["user_acctbal", "item_price", "item_size", "rating", "hour_of_day",
            "day_of_week", "is_weekend", "user_nation"]


def feature_pipeline(cols: list[str]) -> Pipeline:
    """L1-L4: assemble (skip NULL rows), standardise, PCA to max(1, n*0.33)."""
    k = max(1, int(len(cols) * PCA_SHARE))
    return Pipeline(stages=[
        VectorAssembler(inputCols=cols, outputCol="raw_features", handleInvalid="skip"),
        StandardScaler(inputCol="raw_features", outputCol="scaled_features",
                       withMean=True, withStd=True),
        PCA(k=k, inputCol="scaled_features", outputCol="pca_features")])


def derive(df: DataFrame) -> DataFrame:
    t = from_epoch(F.col("timestamp"))
    return (df.withColumn("hour_of_day", F.hour(t)).withColumn("day_of_week", F.dayofweek(t))
            .withColumn("is_weekend", is_weekend(t)))


def feature_job(spark: SparkSession, source: str, root: str, users: DataFrame,
                items: DataFrame, trigger=None) -> dict[str, str]:
    """Per micro-batch enrich (stream-static joins), fit
    the feature pipeline once (saved, reloaded after restart), transform,
    write mergeable user/item partials and moments, and per-batch feature statistics."""
    msgs = message_stream(spark, source)
    inter = derive(decode_interactions(msgs).filter(~F.col("_bad"))
                   .drop("_bad", "context", "key"))
    model_path = os.path.join(root, "feature_model")
    out = {k: os.path.join(root, k) for k in ("user_partials", "item_partials", "batch_stats",
                                              "batch_moments", "pca_rows")}
    cols = feature_columns()

    def write_part(df: DataFrame, path: str, batch_id: int):
        df.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)

    def process(batch: DataFrame, batch_id: int):
        batch = batch.persist()
        try:
            if batch.isEmpty():                       # F5
                return
            # Only what the features, statistics and moments read goes through the joins.
            wide = features.enrich(batch.drop("session_id", "interaction_type"), users, items)
            enriched = wide.select("user_id", "item_id", "timestamp", *cols).persist()
            if _exists(spark, model_path + "/stages"):     # X4: fit once, reuse
                model = PipelineModel.load(model_path)
            else:
                model = feature_pipeline(cols).fit(enriched)
                model.write().overwrite().save(model_path)
            tr = model.transform(enriched)
            write_part(tr.select("user_id", "item_id", "timestamp",
                                 F.col("pca_features").cast("string").alias("pca")),
                       out["pca_rows"], batch_id)
            write_part(profiles.profile_partials(batch, batch_id).drop("batch_id"),
                       out["user_partials"], batch_id)
            write_part(profiles.item_partials(batch, batch_id).drop("batch_id"),
                       out["item_partials"], batch_id)
            write_part(profiles.feature_stats(enriched, cols), out["batch_stats"], batch_id)
            write_part(moments.partial_moments(enriched, cols), out["batch_moments"], batch_id)
            enriched.unpersist()
        finally:
            batch.unpersist()

    q = _start(inter, "features", os.path.join(root, "_ckpt_features"), trigger,
               batch_fn=process)
    run_to_completion(q)
    out["model"] = model_path
    return out


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def session_job(spark: SparkSession, source: str, root: str, gap: str = "30 minutes",
                watermark: str = "30 minutes", trigger=None) -> str:
    """Per-user inactivity sessions with a watermark, append mode:
    a session is emitted once the watermark passes its end."""
    ev = decode_events(message_stream(spark, source))
    s = (ev.withWatermark("ts", watermark)
         .groupBy("user_id", F.session_window("ts", gap).alias("sw"))
         .agg(F.count(F.lit(1)).alias("n_events"), F.min("ts").alias("first_ts"),
              F.max("ts").alias("last_ts")))
    s = s.select("user_id", F.col("sw.start").alias("session_start"),
                 F.col("sw.end").alias("session_end"), "n_events", "first_ts", "last_ts")
    sink = os.path.join(root, "sessions")
    q = _start(s, "sessions", os.path.join(root, "_ckpt_sessions"), trigger, sink=sink)
    run_to_completion(q)
    return sink


def rates_job(spark: SparkSession, source: str, root: str, trigger=None) -> str:
    """5-minute windows sliding by 1 minute: requests and 5xx ratio."""
    ev = decode_events(message_stream(spark, source))
    r = (ev.withWatermark("ts", "10 minutes")
         .groupBy(F.window("ts", "5 minutes", "1 minute").alias("w"))
         .agg(F.count(F.lit(1)).alias("n"),
              F.sum(F.when(F.col("event_type") == "error", 1).otherwise(0)).alias("errors")))
    r = r.select(F.col("w.start").alias("window_start"), "n", "errors",
                 (F.col("n") / F.lit(300.0)).alias("request_rate"))
    sink = os.path.join(root, "rates")
    q = _start(r, "rates", os.path.join(root, "_ckpt_rates"), trigger, sink=sink)
    run_to_completion(q)
    return sink


def latency_job(spark: SparkSession, source: str, root: str, trigger=None) -> str:
    """One mergeable latency sketch a minute, appended once the
    watermark passes the minute; ``monitoring.fold_latency`` reads any window."""
    ev = decode_events(message_stream(spark, source)).withWatermark("ts", "10 minutes")
    m = monitoring.latency_sketches(ev, ts=F.col("ts"), value_col="value")
    sink = os.path.join(root, "latency_minutes")
    q = _start(m, "latency", os.path.join(root, "_ckpt_latency"), trigger, sink=sink)
    run_to_completion(q)
    return sink


def ctr_job(spark: SparkSession, source: str, root: str, within: str = "30 minutes",
            watermark: str = "10 minutes", trigger=None) -> str:
    """V6: served lists joined with the same user's clicks from ``within`` after
    them: (served_id, user_id, served_ts, click_id), a row for each click and,
    once no click can come any more, a row without one.

    Both sides have watermarks and the join an interval, so state is dropped as
    time passes: a list is kept for ``within`` and the delay, a click for the delay.
    """
    ev = decode_events(message_stream(spark, source))
    served = ev.filter(F.col("event_type") == "view").select(
        F.col("event_id").alias("served_id"), "user_id", F.col("ts").alias("served_ts")) \
        .withWatermark("served_ts", watermark)
    clicks = ev.filter(F.col("event_type") == "click").select(
        F.col("event_id").alias("click_id"), F.col("user_id").alias("click_user"),
        F.col("ts").alias("click_ts")).withWatermark("click_ts", watermark)
    joined = served.join(clicks, (F.col("user_id") == F.col("click_user"))
                         & (F.col("click_ts") >= F.col("served_ts"))
                         & (F.col("click_ts") <= F.col("served_ts") + F.expr(f"INTERVAL {within}")),
                         "leftOuter").select("served_id", "user_id", "served_ts", "click_id")
    sink = os.path.join(root, "served_clicks")
    q = _start(joined, "ctr", os.path.join(root, "_ckpt_ctr"), trigger, sink=sink)
    run_to_completion(q)
    return sink


PROFILE_STATE = ("n long, value_sum double, first_us long, last_us long, session_start_us long")
PROFILE_OUT = ("event_id long, user_id long, ts_us long, n long, value_sum double, "
               "since_last double, session_seconds double")


class RunningProfile(StatefulProcessor):
    """State of one user: events and their sum so far, first and last time, start
    of the session.  Each event leaves with the profile up to and including it,
    the seconds since the last one (null for the first) and since the session began."""

    def __init__(self, gap_us: int, ttl_ms: int | None) -> None:
        self.gap_us, self.ttl_ms = gap_us, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("profile", PROFILE_STATE, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        known = self.state.get()
        n, total, first, last, begun = known if known is not None else (0, 0.0, None, None, None)
        batch = pd.concat(list(rows)).sort_values(["ts_us", "event_id"], kind="stable")
        out = []
        for event, ts, value in zip(batch["event_id"].tolist(), batch["ts_us"].tolist(),
                                    batch["value"].fillna(0.0).tolist()):
            since = None if last is None else (ts - last) / 1e6
            if last is None or ts - last >= self.gap_us:
                begun = ts
            first, last, n, total = (ts if first is None else first), ts, n + 1, total + value
            out.append((event, key[0], ts, n, total, since, (ts - begun) / 1e6))
        self.state.update((n, total, first, last, begun))
        yield pd.DataFrame(out, columns=["event_id", "user_id", "ts_us", "n", "value_sum",
                                         "since_last", "session_seconds"])

    def close(self) -> None:
        pass


def profile_state_job(spark: SparkSession, source: str, root: str, gap_seconds: int = 1800,
                      ttl_ms: int | None = None, trigger=None) -> str:
    """The running profile of every user, kept in the state store
    (RocksDB, so state may exceed memory) and read at each event.

    ``ttl_ms`` drops a user's state so long after its last update; such a job
    goes by the clock and runs until it is stopped (no ``availableNow``).  A
    restarted job goes on from its checkpoint.  Events of a micro-batch are taken in time
    order; one that is older than the user's last has a negative ``since_last``.
    """
    ev = decode_events(message_stream(spark, source)).filter(
        F.col("user_id").isNotNull() & F.col("ts").isNotNull()).select(
        "event_id", "user_id", F.unix_micros("ts").alias("ts_us"), "value")
    previous = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    try:
        out = ev.groupBy("user_id").transformWithStateInPandas(
            RunningProfile(gap_seconds * 1_000_000, ttl_ms), PROFILE_OUT, "Append",
            "None" if ttl_ms is None else "ProcessingTime")
        sink = os.path.join(root, "running_profiles")
        q = _start(out, "profile-state", os.path.join(root, "_ckpt_profile_state"), trigger,
                   sink=sink)
        run_to_completion(q)
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", previous)
    return sink


def dedup_job(spark: SparkSession, source: str, root: str, watermark: str = "1 hour",
              trigger=None) -> str:
    """Suppress producer retries: drop repeated event ids within the
    watermark (state is evicted once the watermark passes)."""
    ev = decode_events(message_stream(spark, source))
    d = ev.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["event_id"])
    sink = os.path.join(root, "dedup")
    q = _start(d, "dedup", os.path.join(root, "_ckpt_dedup"), trigger, sink=sink)
    run_to_completion(q)
    return sink


def route_job(spark: SparkSession, source: str, root: str, trigger=None) -> dict[str, str]:
    """One subscription over all topics, dispatch by topic per batch."""
    ev = decode_events(message_stream(spark, source))
    topics = ("user_interactions", "recommendations_served", "model_updates")
    paths = {t: os.path.join(root, t) for t in topics}

    def dispatch(batch: DataFrame, batch_id: int):
        batch = batch.persist()
        try:
            for t, p in paths.items():
                batch.filter(F.col("topic") == t).withColumn("batch_id", F.lit(batch_id)) \
                    .write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
                    .partitionBy("batch_id").parquet(p)
        finally:
            batch.unpersist()

    q = _start(ev, "route", os.path.join(root, "_ckpt_route"), trigger, batch_fn=dispatch)
    run_to_completion(q)
    return paths
