"""What a job leaves on the disks while it runs."""

import os

from rankforge.operators import models
from rankforge.plans.canonical import Canonical
from rankforge.session import written


def shuffle_files(spark):
    """Shuffle data files of the session, by all local folders that its block manager uses."""
    root = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return sum(f.startswith("shuffle_") and f.endswith(".data")
               for d in root for _, _, files in os.walk(d.getPath()) for f in files)


def test_a_written_step_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    out = written(spark.range(1000).repartition(3).groupBy("id").count(), "disk")
    assert out.count() == 1000 and shuffle_files(spark) <= before + 1
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    assert spark.conf.get(key) == "false"


def test_als_leaves_few_shuffle_files(spark):
    """The files of a step go with the next step: their number does not grow with the steps."""
    rows = [(u, i, float(1 + (u * i) % 5)) for u in range(30) for i in range(20) if (u + i) % 3]
    train = written(spark.createDataFrame(rows, "user_id long, item_id long, rating double"), "disk")

    def left(steps):
        before = shuffle_files(spark)
        model = models.als_fit(train, rank=2, max_iter=steps)
        return shuffle_files(spark) - before, model
    few, _ = left(2)
    many, model = left(8)
    assert many <= few + 20 and model.userFactors.count() == 30


def test_derived_inputs_read_four_columns(spark, sf_small):
    c = Canonical(spark, sf_small)
    assert c.dedup.columns == ["user_id", "item_id", "rating", "timestamp"]
    whole = Canonical(spark, sf_small, materialize=False).dedup.select(*c.dedup.columns)
    assert sorted(map(tuple, c.dedup.collect())) == sorted(map(tuple, whole.collect()))
