"""Streaming: restart from checkpoint adds no duplicates; stream = batch."""

import os

from pyspark.sql import functions as F

from rankforge.operators import profiles
from rankforge.session import scratch_path
from rankforge.sources.tables import Tables, interactions
from rankforge.streaming import jobs as J

NOW = {"availableNow": True}


def test_ingest_restart_is_idempotent(spark, sf_small):
    t = Tables(spark, sf_small)
    base = scratch_path(spark, "t-ingest")
    src = J.write_messages(J.interaction_messages(interactions(t)), base + "/src", 3)
    J.ingest(spark, src, base, NOW)
    J.ingest(spark, src, base, NOW)          # restart: nothing new to read
    got = spark.read.parquet(os.path.join(base, "interactions")).count()
    assert got == interactions(t).count()


def test_stream_profiles_equal_batch(spark, sf_small):
    from rankforge.sources.tables import items, users
    t = Tables(spark, sf_small)
    base = scratch_path(spark, "t-feat")
    src = J.write_messages(J.interaction_messages(interactions(t)), base + "/src", 3)
    out = J.feature_job(spark, src, base, users(t), items(t), NOW)
    merged = profiles.merge_profiles(spark.read.parquet(out["user_partials"]))
    direct = profiles.user_profiles(interactions(t))
    cols = ["user_id", "interaction_count", "last_interaction"]
    a = merged.select(*cols, F.round("avg_rating", 9).alias("a"),
                      F.array_join("interacted_items", ",").alias("i"))
    b = direct.select(*cols, F.round("avg_rating", 9).alias("a"),
                      F.array_join("interacted_items", ",").alias("i"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_dedup_suppresses_retries(spark, sf_small):
    t = Tables(spark, sf_small)
    base = scratch_path(spark, "t-dedup")
    src = J.write_messages(J.event_messages(t.events, copies=3), base + "/src", 3)
    out = spark.read.parquet(J.dedup_job(spark, src, base, trigger=NOW))
    assert out.count() == t.events.count()
    assert out.select("event_id").distinct().count() == out.count()


def test_replay_loses_no_row_of_several_files(spark, sf_small, tmp_path):
    t = Tables(spark, sf_small)
    base = str(tmp_path)
    msgs = J.event_messages(t.events, copies=2).repartition(4)
    out = J.replay(msgs, base + "/src", 3, lambda src: J.dedup_job(
        spark, src, base, trigger={"availableNow": True}))
    assert spark.read.parquet(out).count() == t.events.count()
