import pytest
from pyspark.sql import functions as F

from rankforge.functions import stats as S
from rankforge.functions.columns import unit_hash
from rankforge.operators import abtest as AB
from rankforge.operators import monitoring as MO


def test_sample_size_and_t_p():
    assert S.sample_size(0.02, 0.95, 0.05) == 64974
    assert S.sample_size(0.2, 0.8, 0.05) == 393
    assert S.t_two_sided_p(2.0, 10) == pytest.approx(0.0734, abs=1e-4)
    assert S.t_two_sided_p(0.0, 30) == pytest.approx(1.0)


def test_assignment_stable_and_near_split(spark):
    users = spark.range(20000).select(F.col("id").alias("user_id"),
                                      F.lit("exp_a").alias("experiment_id"))
    exps = spark.createDataFrame([("exp_a", 0.3)], "experiment_id string, traffic_split double")
    a1 = AB.assign(users, exps)
    share = a1.agg(F.avg((F.col("variant") == "treatment").cast("double"))).first()[0]
    assert abs(share - 0.3) < 0.02
    a2 = AB.assign(users.repartition(7), exps)
    diff = a1.select("user_id", "variant").exceptAll(a2.select("user_id", "variant")).count()
    assert diff == 0


def test_variant_stats_zero_control_mean_and_std(spark):
    obs = spark.createDataFrame([("e", "control", 0.0)] * 3 + [("e", "treatment", 0.0)] * 3,
                                "experiment_id string, variant string, value double")
    s = AB.variant_stats(obs).first()
    assert s["lift_percentage"] == 0.0 and s["effect_size"] == 0.0 and s["t_stat"] is None


def test_with_defaults_keeps_zero(spark):
    df = spark.createDataFrame([("e", 0.0, None)],
                               "experiment_id string, traffic_split double, "
                               "significance_level double")
    for c in ("statistical_power", "min_effect_size"):
        df = df.withColumn(c, F.lit(None).cast("double"))
    for c in ("min_sample_size", "max_duration_days"):
        df = df.withColumn(c, F.lit(None).cast("int"))
    r = AB.with_defaults(df).first()
    assert r["traffic_split"] == 0.0 and r["significance_level"] == 0.05


def test_trend_improving(spark):
    rows = [(i, i * 3600.0, "ndcg_10", 0.70 + 0.01 * i) for i in range(10)]
    h = spark.createDataFrame(rows, "event_id long, t double, metric string, value double") \
        .withColumn("ts", F.timestamp_seconds("t"))
    r = MO.trend(h, 10).first()
    assert r["trend"] == "improving" and r["slope"] == pytest.approx(0.01)
    one = MO.trend(h.limit(1), 10).first()
    assert one["trend"] == "insufficient_data"


def test_target_report_rmse_lower_is_better(spark):
    cur = spark.createDataFrame([(k, v) for k, v in MO.TARGETS.items()],
                                "metric string, current double")
    rep = {r["metric"]: r for r in MO.target_report(cur, MO.targets_table(spark)).collect()}
    assert all(r["meets_target"] for r in rep.values())
    assert all(r["achievement_rate"] >= 1 for r in rep.values())
    cur2 = cur.withColumn("current", F.when(F.col("metric") == "rmse", 0.9)
                          .otherwise(F.col("current")))
    rep2 = {r["metric"]: r for r in MO.target_report(cur2, MO.targets_table(spark)).collect()}
    assert not rep2["rmse"]["meets_target"]
    rep3 = {r["metric"]: r for r in
            MO.target_report(cur2, MO.targets_table(spark), parity=True).collect()}
    assert rep3["rmse"]["meets_target"]


def test_unit_hash_matches_python_md5(spark):
    import hashlib
    v = spark.range(1).select(unit_hash(F.lit("exp"), F.lit(7)).alias("u")).first()["u"]
    h = int(hashlib.md5(b"exp_7").hexdigest()[:8], 16) / 2 ** 32
    assert v == pytest.approx(h)


def test_decision_without_data_or_spread(spark):
    from pyspark.sql import functions as F
    from rankforge.operators import abtest
    rows = [("one_side", "control", float(i)) for i in range(9)]
    rows += [("flat", v, 3.0) for v in ("control", "treatment") for _ in range(9)]
    rows += [("step", "control", 1.0)] * 9 + [("step", "treatment", 2.0)] * 9
    obs = spark.createDataFrame(rows, "experiment_id string, variant string, value double")
    exps = spark.createDataFrame([(e, 0.05, 0.2) for e in ("one_side", "flat", "step")],
                                 "experiment_id string, significance_level double, min_effect_size double")
    sig = abtest.significance(abtest.variant_stats(obs), exps)
    out = {r["experiment_id"]: r for r in abtest.decision(sig, exps).collect()}
    assert out["one_side"]["recommendation"] == "Insufficient data for analysis"
    assert out["flat"]["recommendation"].startswith("No significant difference")
    assert out["flat"]["is_significant"] is False and out["one_side"]["is_significant"] is False
    assert out["step"]["p_value"] == 0.0 and out["step"]["is_significant"] is True
    assert out["one_side"]["effect_size"] is None
    none = abtest.status(spark.createDataFrame([], "experiment_id string, control_size long, treatment_size long"),
                         exps.withColumn("statistical_power", F.lit(0.8))
                         .withColumn("started_at", F.current_timestamp())
                         .withColumn("stopped_at", F.lit(None).cast("timestamp")), F.current_timestamp())
    assert {r["interim_ready"] for r in none.collect()} == {False}


def test_mann_whitney_with_an_outlier(spark):
    rows = [("e", "treatment" if i % 3 else "control", float(i % 50)) for i in range(600)]
    rows += [("e", "control", 1e12), ("e", "control", None)]
    obs = spark.createDataFrame(rows, "experiment_id string, variant string, value double")
    known = [r for r in rows if r[2] is not None]
    t = [v for _, g, v in known if g == "treatment"]
    c = [v for _, g, v in known if g == "control"]
    u = sum((a > b) + 0.5 * (a == b) for a in t for b in c)
    got = AB.mann_whitney(obs).first()
    assert got["u_stat"] == pytest.approx(u)
    assert (got["treatment_size"], got["control_size"]) == (len(t), len(c))


def test_exact_percentiles_by_key(spark):
    rows = [("a", float(i * i)) for i in range(101)] + [("b", 7.0)] * 500 + [("b", 1e9), ("b", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: r for r in MO.exact_percentiles(df, "v", (0.5, 0.95, 0.99), ["k"]).collect()}
    want = df.groupBy("k").agg(*[F.percentile("v", p).alias(f"p{int(p * 100)}")
                                 for p in (0.5, 0.95, 0.99)]).collect()
    for r in want:
        for c in ("p50", "p95", "p99"):
            assert got[r["k"]][c] == pytest.approx(r[c])


def test_final_analysis_of_stopped_experiments(spark):
    exps = AB.with_defaults(spark.sql("""
        SELECT * FROM VALUES ('a', TIMESTAMP'2024-01-01', TIMESTAMP'2024-03-01'),
                             ('b', TIMESTAMP'2024-01-01', TIMESTAMP'2024-01-02'),
                             ('c', TIMESTAMP'2024-01-01', NULL) t(experiment_id, started_at, stopped_at)
        """).selectExpr("*", *[f"cast(null as {t}) {c}" for c, t in (
            ("traffic_split", "double"), ("significance_level", "double"),
            ("statistical_power", "double"), ("min_effect_size", "double"),
            ("min_sample_size", "int"), ("max_duration_days", "int"))]))
    obs = spark.sql("""
        SELECT 'a' experiment_id, CASE WHEN id % 2 = 0 THEN 'control' ELSE 'treatment' END variant,
               CAST(id % 2 * 5 + id % 3 AS DOUBLE) value,
               TIMESTAMP'2024-01-01' + make_interval(0, 0, 0, CAST(id AS INT)) ts FROM range(100)""")
    got = {r["experiment_id"]: r for r in AB.final_analysis(exps, obs).collect()}
    assert set(got) == {"a", "b"}
    assert got["a"]["control_size"] + got["a"]["treatment_size"] == 61   # up to the stop
    assert got["a"]["days_run"] == 60 and got["a"]["overdue"] and got["a"]["is_significant"]
    assert got["b"]["control_size"] == 0 and not got["b"]["overdue"]
    assert got["b"]["recommendation"] == "Insufficient data for analysis"
