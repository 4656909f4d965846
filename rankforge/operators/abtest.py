"""A/B testing as grouped Spark queries.

Assignment is a stateless hash of (experiment, user), so it is sticky across
restarts and identical on every executor.  All statistics come from one
``groupBy(experiment)`` with conditional aggregates (combined map-side);
only the final one-row-per-experiment table meets the pandas UDFs for
p-values and power.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.functions.columns import dbl, safe_div, unit_hash
from rankforge.functions import stats as S

# Configuration defaults of the experiment framework.
DEFAULTS = {
    "traffic_split": 0.5,
    "significance_level": 0.05,
    "statistical_power": 0.95,
    "min_effect_size": 0.02,
    "min_sample_size": 1000,
    "max_duration_days": 30,
}
Z_95 = 1.959963984540054     # two-sided 95 % normal quantile used for the CI
INTERIM_MIN_PER_SIDE = 10

CONTROL, TREATMENT = "control", "treatment"


def with_defaults(experiments: DataFrame) -> DataFrame:
    """Fill unset settings from the defaults.  NULL only: an explicit 0
    is kept (``coalesce``, not ``x or default``)."""
    out = experiments
    for k, v in DEFAULTS.items():
        lit = F.lit(v).cast("double") if isinstance(v, float) else F.lit(v).cast("int")
        out = out.withColumn(k, F.coalesce(F.col(k), lit))
    return out


def assign(units: DataFrame, experiments: DataFrame) -> DataFrame:
    """B2: variant per (experiment, user): treatment if hash-uniform < split."""
    u = unit_hash(F.col("experiment_id"), F.col("user_id"))
    return units.join(experiments.select("experiment_id", "traffic_split"), "experiment_id") \
        .withColumn("u", u) \
        .withColumn("variant", F.when(F.col("u") < F.col("traffic_split"), F.lit(TREATMENT))
                    .otherwise(F.lit(CONTROL)))


def variant_stats(observations: DataFrame) -> DataFrame:
    """B4, B5, B6 (t), B8: per-experiment two-sample statistics.

    ``observations``: (experiment_id, variant, value).
    """
    is_c = F.col("variant") == CONTROL
    is_t = F.col("variant") == TREATMENT
    a = observations.groupBy("experiment_id").agg(
        F.count(F.when(is_c, F.col("value"))).alias("control_size"),
        F.count(F.when(is_t, F.col("value"))).alias("treatment_size"),
        F.avg(F.when(is_c, F.col("value"))).alias("control_mean"),
        F.avg(F.when(is_t, F.col("value"))).alias("treatment_mean"),
        F.var_samp(F.when(is_c, F.col("value"))).alias("control_var"),
        F.var_samp(F.when(is_t, F.col("value"))).alias("treatment_var"))
    nc, nt = F.col("control_size"), F.col("treatment_size")
    pooled_var = ((nc - 1) * F.col("control_var") + (nt - 1) * F.col("treatment_var")) \
        / (nc + nt - 2)
    a = a.withColumn("pooled_std", F.sqrt(pooled_var))
    diff = F.col("treatment_mean") - F.col("control_mean")
    a = (a.withColumn("diff", diff)
         .withColumn("effect_size", safe_div(diff, F.col("pooled_std")))
         .withColumn("std_error", F.col("pooled_std") * F.sqrt(dbl(1.0) / nc + dbl(1.0) / nt)))
    return (a.withColumn("t_stat", F.when(F.col("std_error") > 0,
                                          F.col("diff") / F.col("std_error")))
            .withColumn("ci_low", F.col("diff") - dbl(Z_95) * F.col("std_error"))
            .withColumn("ci_high", F.col("diff") + dbl(Z_95) * F.col("std_error"))
            .withColumn("lift_percentage",
                        F.when(F.col("control_mean") != 0,
                               diff / F.col("control_mean") * dbl(100.0))
                        .otherwise(dbl(0.0))))


def mann_whitney(observations: DataFrame) -> DataFrame:
    """W9 + B7 (statistic): U of treatment vs control with average ranks for ties.

    Values are first counted per (experiment, value) -- combined map-side --
    so the rank window runs over distinct values, not over raw rows.
    """
    from rankforge.operators.features import running_sum_in_buckets, with_value_bucket
    is_t = F.col("variant") == TREATMENT
    c = observations.filter(F.col("value").isNotNull()).groupBy("experiment_id", "value").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.sum(F.when(is_t, 1).otherwise(0)).alias("cnt_t"))
    # Rows before each distinct value: running sum in value buckets, so one
    # experiment with a huge share of the rows is not ranked in a single task.
    c = with_value_bucket(c, ["experiment_id"], "value", "_vb")
    c = running_sum_in_buckets(c, ["experiment_id"], ["value"], ["cnt"], "_vb", ["before"],
                               inclusive=False)
    c = c.withColumn("avg_rank", F.col("before") + (F.col("cnt") + dbl(1.0)) / dbl(2.0))
    g = c.groupBy("experiment_id").agg(
        F.sum(F.col("avg_rank") * F.col("cnt_t")).alias("rank_sum_t"),
        F.sum("cnt_t").alias("n_t"), F.sum("cnt").alias("n"),
        F.sum(F.pow(F.col("cnt"), 3) - F.col("cnt")).alias("tie_term"))
    return g.select("experiment_id",
                    (F.col("rank_sum_t") - F.col("n_t") * (F.col("n_t") + 1) / dbl(2.0))
                    .alias("u_stat"),
                    F.col("n_t").cast("long").alias("treatment_size"),
                    (F.col("n") - F.col("n_t")).cast("long").alias("control_size"),
                    F.col("tie_term").cast("double").alias("tie_term"))


def significance(stats: DataFrame, experiments: DataFrame) -> DataFrame:
    """B6 (p), B9, B10 on the one-row-per-experiment table (pandas UDFs)."""
    j = stats.join(experiments.select("experiment_id", "significance_level"), "experiment_id")
    dfree = (F.col("control_size") + F.col("treatment_size") - 2).cast("double")
    # Without spread any difference is certain; without a difference p is undefined.
    j = j.withColumn("p_value", F.when((F.col("std_error") == 0) & (F.col("diff") != 0), dbl(0.0))
                     .otherwise(S.t_pvalue_udf(F.col("t_stat"), dfree)))
    z_alpha = S.norm_ppf_udf(dbl(1.0) - F.col("significance_level") / dbl(2.0))
    j = j.withColumn("statistical_power",
                     dbl(1.0) - S.norm_cdf_udf(z_alpha - F.abs(F.col("t_stat"))))
    return j.withColumn("is_significant", F.coalesce(
        F.col("p_value") < F.col("significance_level"), F.lit(False)))


def decision(sig: DataFrame, experiments: DataFrame, parity: bool = False) -> DataFrame:
    """Recommendation text.  The effect-size rule uses |d| by default;
    ``parity=True`` keeps the reference's signed comparison (T14)."""
    j = sig.join(experiments.select("experiment_id", "min_effect_size"), "experiment_id")
    eff = F.col("effect_size") if parity else F.abs(F.col("effect_size"))
    lift = F.col("lift_percentage")
    text = (F.when((F.col("control_size") == 0) | (F.col("treatment_size") == 0),
                   F.lit("Insufficient data for analysis"))
            .when(~F.col("is_significant"),
                   F.lit("No significant difference detected. Consider longer experiment "
                         "duration or larger sample size."))
            .when(eff < F.col("min_effect_size"),
                  F.lit("Statistically significant but effect size below practical threshold. "
                        "Consider if implementation cost is justified."))
            .when(lift > 0, F.format_string(
                "Treatment shows significant improvement (%.1f%% lift). Recommend implementing "
                "treatment algorithm.", lift))
            .otherwise(F.format_string(
                "Treatment shows significant decrease (%.1f%% drop). Recommend keeping control "
                "algorithm.", F.abs(lift))))
    return j.withColumn("recommendation", text)


def required_sample_size(effect, power, alpha, two_sided: bool = True):
    """B1 as a column: ceil(2 * ((z_alpha + z_beta) / d)^2)."""
    za = S.norm_ppf_udf(dbl(1.0) - alpha / dbl(2.0)) if two_sided else \
        S.norm_ppf_udf(dbl(1.0) - alpha)
    zb = S.norm_ppf_udf(power)
    return F.ceil(dbl(2.0) * F.pow((za + zb) / effect, 2)).cast("long")


def status(sizes: DataFrame, experiments: DataFrame, as_of) -> DataFrame:
    """Progress, running/ready, days running, interim flag, lifecycle."""
    j = experiments.join(sizes, "experiment_id", "left")
    req = required_sample_size(F.col("min_effect_size"), F.col("statistical_power"),
                               F.col("significance_level"))
    total = F.coalesce(F.col("control_size"), F.lit(0)) + \
        F.coalesce(F.col("treatment_size"), F.lit(0))
    j = j.withColumn("required_sample_size", req) \
        .withColumn("progress", F.least(total / F.col("required_sample_size"), dbl(1.0)))
    return j.select(
        "experiment_id", total.cast("long").alias("total_size"), "required_sample_size",
        "progress",
        F.when(F.col("progress") < 1.0, "running").otherwise("ready_for_analysis")
        .alias("status"),
        F.floor((F.unix_micros(as_of.cast("timestamp"))
                 - F.unix_micros(F.col("started_at").cast("timestamp"))) / F.lit(86400000000))
        .cast("long").alias("days_running"),
        ((F.coalesce("control_size", F.lit(0)) > INTERIM_MIN_PER_SIDE)
         & (F.coalesce("treatment_size", F.lit(0)) > INTERIM_MIN_PER_SIDE))
        .alias("interim_ready"),
        F.when(F.col("stopped_at").isNotNull(), "completed").otherwise("active")
        .alias("lifecycle"))


def listing(experiments: DataFrame) -> DataFrame:
    """Active and completed lists; an id in both is reported completed."""
    active = experiments.select("experiment_id", F.lit("active").alias("status"),
                                F.lit(2).alias("_prio"))
    done = experiments.filter(F.col("stopped_at").isNotNull()).select(
        "experiment_id", F.lit("completed").alias("status"), F.lit(1).alias("_prio"))
    u = active.unionByName(done)
    return (u.groupBy("experiment_id")
            .agg(F.min_by("status", "_prio").alias("status")))


def stop(experiments: DataFrame, experiment_id: str, at) -> DataFrame:
    """Mark an experiment stopped at ``at`` (a timestamp Column); its
    final analysis is ``variant_stats``/``significance`` over its rows and
    ``listing`` reports it as completed."""
    hit = F.col("experiment_id") == F.lit(experiment_id)
    return experiments.withColumn(
        "stopped_at", F.when(hit & F.col("stopped_at").isNull(), at)
        .otherwise(F.col("stopped_at")))


def final_analysis(experiments: DataFrame, observations: DataFrame) -> DataFrame:
    """Stopped experiments with the analysis of their rows up to the stop.

    ``observations`` has a ``ts``.  Days run are whole days from start to stop;
    ``overdue`` says whether they exceed ``max_duration_days``.  A stopped
    experiment without rows has sizes 0 and insufficient data.
    """
    done = experiments.filter(F.col("stopped_at").isNotNull())
    rows = observations.join(done.select("experiment_id", "stopped_at"), "experiment_id") \
        .filter(F.col("ts") <= F.col("stopped_at"))
    stats = done.select("experiment_id").join(variant_stats(rows), "experiment_id", "left") \
        .na.fill(0, ["control_size", "treatment_size"])
    found = decision(significance(stats, experiments), experiments)
    days = F.floor((F.unix_micros(F.col("stopped_at").cast("timestamp"))
                    - F.unix_micros(F.col("started_at").cast("timestamp")))
                   / F.lit(86400000000)).cast("long")
    return found.drop("min_effect_size", "significance_level").join(done.select(
        "experiment_id", "stopped_at", days.alias("days_run"),
        (days > F.col("max_duration_days")).alias("overdue")), "experiment_id")
