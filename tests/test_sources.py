from pyspark.sql import functions as F

from rankforge.operators import abtest as AB
from rankforge.sources import generate, sinks


def test_modulo_seed_patterns(spark):
    small = generate.modulo_interactions(spark, **generate.SMALL)
    assert small.count() == 1000
    assert small.select("user_id").distinct().count() == 20
    assert small.select("item_id").distinct().count() == 50
    assert {r[0] for r in small.select("rating").distinct().collect()} == {3.0, 4.0}
    large = generate.modulo_interactions(spark, **generate.LARGE)
    assert large.select("session_id").distinct().count() == 100


def test_random_interactions_statistics(spark):
    df = generate.random_interactions(spark, 100, 50, 0.1, seed=42)
    n = df.count()
    assert 400 < n < 600
    st = df.agg(F.min("rating"), F.max("rating"), F.avg("rating")).first()
    assert st[0] >= 1.0 and st[1] <= 5.0 and 3.2 < st[2] < 3.8
    again = generate.random_interactions(spark.range(1).sparkSession, 100, 50, 0.1, seed=42)
    assert again.exceptAll(df).count() == 0


def test_versioned_overwrite_and_batches(spark, tmp_path):
    root = str(tmp_path / "t")
    sinks.write_version(spark.range(3).toDF("x"), root, "v1")
    sinks.write_version(spark.range(5).toDF("x"), root, "v2")
    assert sinks.read_current(spark, root).count() == 5
    p = str(tmp_path / "b")
    sinks.append_batch(spark.range(2).toDF("x"), p, 0)
    sinks.append_batch(spark.range(2).toDF("x").withColumn("y", F.lit(1)), p, 1)
    sinks.append_batch(spark.range(2).toDF("x").withColumn("y", F.lit(1)), p, 1)  # replay
    got = sinks.read_batches(spark, p)
    assert got.count() == 4 and "y" in got.columns


def test_stop_experiment(spark):
    exps = spark.createDataFrame([("a", None), ("b", None)],
                                 "experiment_id string, stopped_at timestamp")
    stopped = AB.stop(exps, "a", F.current_timestamp())
    got = {r["experiment_id"]: r["status"] for r in AB.listing(stopped).collect()}
    assert got == {"a": "completed", "b": "active"}
