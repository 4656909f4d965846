"""Registered queries: A/B testing.

Experiments are derived from the ``events`` table: one experiment per event
type, the event ``value`` is the metric and ``user_id`` the unit.  A few
settings are left unset on purpose so the defaults (B13) apply.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.functions import stats as S
from rankforge.functions.columns import dbl
from rankforge.operators import abtest as AB
from rankforge.plans.registry import register
from rankforge.session import written
from rankforge.sources.tables import Tables


def experiments_table(events: DataFrame) -> DataFrame:
    g = events.groupBy("event_type").agg(F.min("ts").alias("started_at"),
                                         F.max("ts").alias("last_ts"))
    et = F.col("event_type")
    return g.select(
        F.concat(F.lit("exp_"), et).alias("experiment_id"), "event_type",
        F.when(et == "click", dbl(0.3)).alias("traffic_split"),
        F.lit(None).cast("double").alias("significance_level"),
        F.lit(None).cast("double").alias("statistical_power"),
        F.when(et == "signup", dbl(0.2)).alias("min_effect_size"),
        F.lit(None).cast("int").alias("min_sample_size"),
        F.lit(None).cast("int").alias("max_duration_days"),
        "started_at",
        F.when(et == "signup", F.col("last_ts")).alias("stopped_at"))


def _setup(spark, root, materialize: bool = False):
    """Events, experiment table, assigned observations.  Queries that read
    the observations in several branches (statistics, ranks, bounds) set
    ``materialize``: the observation table is then written once
    (Parquet) and every branch scans it instead of re-joining events."""
    e = Tables(spark, root).events
    exps = AB.with_defaults(experiments_table(e))
    units = e.join(exps.select("experiment_id", "event_type"), "event_type") \
        .select("event_id", "experiment_id", "user_id", "value")
    obs = AB.assign(units, exps)
    if materialize:
        obs = written(obs.select("event_id", "experiment_id", "user_id", "value", "variant"),
                      "observations")
    return e, exps, obs


EXP_SQL = """
WITH exps AS (
  SELECT 'exp_' || event_type AS experiment_id, event_type,
         coalesce(CASE WHEN event_type = 'click' THEN 0.3 END, 0.5)::DOUBLE AS traffic_split,
         0.05::DOUBLE AS significance_level, 0.95::DOUBLE AS statistical_power,
         coalesce(CASE WHEN event_type = 'signup' THEN 0.2 END, 0.02)::DOUBLE AS min_effect_size,
         1000 AS min_sample_size, 30 AS max_duration_days,
         min(ts) AS started_at, CASE WHEN event_type = 'signup' THEN max(ts) END AS stopped_at
  FROM events GROUP BY event_type),
obs AS (
  SELECT e.event_id, x.experiment_id, e.user_id, e.value,
         CASE WHEN CAST(concat('0x', substr(md5(x.experiment_id || '_' || CAST(e.user_id AS VARCHAR)),
                                            1, 8)) AS BIGINT) / 4294967296.0 < x.traffic_split
              THEN 'treatment' ELSE 'control' END AS variant
  FROM events e JOIN exps x ON e.event_type = x.event_type),
st AS (
  SELECT experiment_id,
    count(*) FILTER (WHERE variant = 'control') AS control_size,
    count(*) FILTER (WHERE variant = 'treatment') AS treatment_size,
    avg(value) FILTER (WHERE variant = 'control') AS control_mean,
    avg(value) FILTER (WHERE variant = 'treatment') AS treatment_mean,
    var_samp(value) FILTER (WHERE variant = 'control') AS cv,
    var_samp(value) FILTER (WHERE variant = 'treatment') AS tv
  FROM obs GROUP BY experiment_id),
st2 AS (
  SELECT *, sqrt(((control_size - 1) * cv + (treatment_size - 1) * tv)
                 / (control_size + treatment_size - 2)) AS pooled_std,
         treatment_mean - control_mean AS diff FROM st),
st3 AS (
  SELECT *, CASE WHEN pooled_std <> 0 THEN diff / pooled_std ELSE 0.0 END AS effect_size,
         pooled_std * sqrt(1.0 / control_size + 1.0 / treatment_size) AS std_error FROM st2)
"""


@register("ab_config", ops="B13", doubles=("traffic_split", "significance_level",
                                           "statistical_power", "min_effect_size"),
          sql=EXP_SQL + """
SELECT experiment_id, traffic_split, significance_level, statistical_power, min_effect_size,
       min_sample_size, max_duration_days,
       strftime(started_at, '%Y-%m-%d %H:%M:%S') AS started_at FROM exps""")
def ab_config(spark, root):
    _, exps, _ = _setup(spark, root)
    return exps.select("experiment_id", "traffic_split", "significance_level",
                       "statistical_power", "min_effect_size", "min_sample_size",
                       "max_duration_days",
                       F.date_format(F.col("started_at").cast("timestamp"),
                                     "yyyy-MM-dd HH:mm:ss").alias("started_at"))


@register("ab_assign", ops="B2", sql=EXP_SQL + """
SELECT DISTINCT experiment_id, user_id, variant FROM obs""")
def ab_assign(spark, root):
    _, _, obs = _setup(spark, root)
    return obs.select("experiment_id", "user_id", "variant").distinct()


@register("ab_metrics", ops="B3", doubles=("value",), sql=EXP_SQL + """
SELECT event_id, experiment_id, user_id, variant, value FROM obs""")
def ab_metrics(spark, root):
    _, _, obs = _setup(spark, root)
    return obs.select("event_id", "experiment_id", "user_id", "variant", "value")


STAT_COLS = ("control_mean", "treatment_mean", "pooled_std", "diff", "effect_size", "std_error",
             "t_stat", "ci_low", "ci_high", "lift_percentage")


@register("ab_stats", ops="B4,B5,B6,B8,G5", doubles=STAT_COLS, sql=EXP_SQL + """
SELECT experiment_id, control_size, treatment_size, control_mean, treatment_mean, pooled_std,
       diff, effect_size, std_error,
       CASE WHEN std_error > 0 THEN diff / std_error END AS t_stat,
       diff - 1.959963984540054 * std_error AS ci_low,
       diff + 1.959963984540054 * std_error AS ci_high,
       CASE WHEN control_mean <> 0 THEN diff / control_mean * 100.0 ELSE 0.0 END
         AS lift_percentage
FROM st3""")
def ab_stats(spark, root):
    _, _, obs = _setup(spark, root)
    s = AB.variant_stats(obs)
    return s.select("experiment_id", "control_size", "treatment_size", *STAT_COLS)


@register("mann_whitney_u", ops="B7,W9", doubles=("u_stat", "tie_term"), sql=EXP_SQL + """,
rk AS (SELECT *, rank() OVER (PARTITION BY experiment_id ORDER BY value)
                 + (count(*) OVER (PARTITION BY experiment_id, value) - 1) / 2.0 AS r,
              count(*) OVER (PARTITION BY experiment_id, value) AS tcnt
       FROM obs)
SELECT experiment_id,
  sum(r) FILTER (WHERE variant = 'treatment')
    - count(*) FILTER (WHERE variant = 'treatment')
      * (count(*) FILTER (WHERE variant = 'treatment') + 1) / 2.0 AS u_stat,
  count(*) FILTER (WHERE variant = 'treatment') AS treatment_size,
  count(*) FILTER (WHERE variant = 'control') AS control_size,
  sum((tcnt * tcnt * tcnt - tcnt) / tcnt) AS tie_term
FROM rk GROUP BY experiment_id""")
def mann_whitney_u(spark, root):
    _, _, obs = _setup(spark, root, materialize=True)
    return AB.mann_whitney(obs)


# Simpson's rule over the densities of Student's t and of the normal distribution.
PVALUE_SQL = EXP_SQL + """,
rk AS (SELECT *, rank() OVER (PARTITION BY experiment_id ORDER BY value)
                 + (count(*) OVER (PARTITION BY experiment_id, value) - 1) / 2.0 AS r,
              count(*) OVER (PARTITION BY experiment_id, value) AS tcnt
       FROM obs),
mw AS (SELECT experiment_id,
         count(*) FILTER (WHERE variant = 'treatment')::DOUBLE AS n1,
         count(*) FILTER (WHERE variant = 'control')::DOUBLE AS n2,
         sum(r) FILTER (WHERE variant = 'treatment') AS rs,
         sum((tcnt * tcnt * tcnt - tcnt) / tcnt) AS ties FROM rk GROUP BY experiment_id),
mz AS (SELECT experiment_id, (abs(rs - n1 * (n1 + 1) / 2.0 - n1 * n2 / 2.0) - 0.5)
         / sqrt(n1 * n2 / 12.0 * ((n1 + n2 + 1) - ties / ((n1 + n2) * (n1 + n2 - 1)))) AS z FROM mw),
tt AS (SELECT *, diff / std_error AS t_stat, (control_size + treatment_size - 2)::DOUBLE AS nu
       FROM st3),
simpson AS (SELECT k, CASE WHEN k IN (0, 2000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END AS w
            FROM range(0, 2001) g(k)),
tp AS (SELECT experiment_id, 1 - 2 * abs(t_stat) / 6000.0
         * exp(lgamma((nu + 1) / 2) - lgamma(nu / 2)) / sqrt(nu * pi())
         * sum(w * exp(-(nu + 1) / 2 * ln(1 + pow(t_stat * k / 2000.0, 2) / nu))) AS p_value
       FROM tt, simpson GROUP BY experiment_id, t_stat, nu),
pw AS (SELECT experiment_id, 0.5 - (1.959963984540054 - abs(t_stat)) / 6000.0 / sqrt(2 * pi())
         * sum(w * exp(-pow((1.959963984540054 - abs(t_stat)) * k / 2000.0, 2) / 2)) AS power
       FROM tt, simpson GROUP BY experiment_id, t_stat),
mp AS (SELECT experiment_id, least(1.0, 1 - 2 * z / 6000.0 / sqrt(2 * pi())
         * sum(w * exp(-pow(z * k / 2000.0, 2) / 2))) AS mw_p FROM mz, simpson
       GROUP BY experiment_id, z),
pv AS (SELECT t.*, p_value, power AS statistical_power, p_value < 0.05 AS is_significant,
         mw_p AS mw_p_value FROM tt t JOIN tp USING (experiment_id) JOIN pw USING (experiment_id)
       JOIN mp USING (experiment_id))
"""


@register("ab_pvalue", ops="B6,B9,B10,B7",
          doubles=("t_stat", "p_value", "statistical_power", "mw_p_value"), sql=PVALUE_SQL + """
SELECT experiment_id, t_stat, p_value, statistical_power, is_significant, mw_p_value FROM pv""")
def ab_pvalue(spark, root):
    """p-value (Student t), post-hoc power, significance flag and the
    Mann-Whitney p-value; one row per experiment."""
    _, exps, obs = _setup(spark, root, materialize=True)
    sig = AB.significance(AB.variant_stats(obs), exps)
    mw = AB.mann_whitney(obs).select(
        "experiment_id", S.mann_whitney_p_udf(F.col("u_stat"), F.col("treatment_size"),
                                              F.col("control_size"), F.col("tie_term"))
        .alias("mw_p_value"))
    return sig.join(mw, "experiment_id").select(
        "experiment_id", "t_stat", "p_value", "statistical_power", "is_significant",
        "mw_p_value")


@register("ab_decision", ops="B11", doubles=("effect_size", "lift_percentage"), sql=PVALUE_SQL + """,
de AS (SELECT p.experiment_id, is_significant, effect_size, x.min_effect_size,
         CASE WHEN control_mean <> 0 THEN diff / control_mean * 100.0 ELSE 0.0 END AS lift_percentage
       FROM pv p JOIN exps x ON p.experiment_id = x.experiment_id)
SELECT experiment_id, is_significant, effect_size, lift_percentage, CASE
  WHEN NOT is_significant THEN 'No significant difference detected. Consider longer experiment '
    || 'duration or larger sample size.'
  WHEN abs(effect_size) < min_effect_size THEN 'Statistically significant but effect size below '
    || 'practical threshold. Consider if implementation cost is justified.'
  WHEN lift_percentage > 0 THEN printf('Treatment shows significant improvement (%.1f%% lift). '
    || 'Recommend implementing treatment algorithm.', lift_percentage)
  ELSE printf('Treatment shows significant decrease (%.1f%% drop). Recommend keeping control '
    || 'algorithm.', abs(lift_percentage)) END AS recommendation
FROM de""")
def ab_decision(spark, root):
    """Recommendation text per experiment."""
    _, exps, obs = _setup(spark, root)
    sig = AB.significance(AB.variant_stats(obs), exps)
    return AB.decision(sig, exps).select("experiment_id", "is_significant", "effect_size",
                                         "lift_percentage", "recommendation")


@register("ab_status", ops="B12,B1", doubles=("progress",), sql=EXP_SQL + """
SELECT x.experiment_id, s.control_size + s.treatment_size AS total_size,
  CAST(ceil(2.0 * pow((1.9599639845400536 + 1.6448536269514715) / x.min_effect_size, 2))
       AS BIGINT) AS required_sample_size,
  least((s.control_size + s.treatment_size)
        / ceil(2.0 * pow((1.9599639845400536 + 1.6448536269514715) / x.min_effect_size, 2)),
        1.0) AS progress,
  CASE WHEN (s.control_size + s.treatment_size)
        / ceil(2.0 * pow((1.9599639845400536 + 1.6448536269514715) / x.min_effect_size, 2)) < 1
       THEN 'running' ELSE 'ready_for_analysis' END AS status,
  CAST(floor((epoch_us((SELECT max(ts) FROM events)) - epoch_us(x.started_at)) / 86400000000)
       AS BIGINT) AS days_running,
  s.control_size > 10 AND s.treatment_size > 10 AS interim_ready,
  CASE WHEN x.stopped_at IS NOT NULL THEN 'completed' ELSE 'active' END AS lifecycle
FROM exps x LEFT JOIN st s ON x.experiment_id = s.experiment_id""")
def ab_status(spark, root):
    e, exps, obs = _setup(spark, root)
    sizes = AB.variant_stats(obs).select("experiment_id", "control_size", "treatment_size")
    return AB.status(sizes, exps, e.agg(F.max("ts")).scalar())


@register("ab_list", ops="B15,B14", sql=EXP_SQL + """
SELECT experiment_id, status FROM (
  SELECT experiment_id, 'active' AS status, 2 AS prio FROM exps
  UNION ALL
  SELECT experiment_id, 'completed', 1 FROM exps WHERE stopped_at IS NOT NULL)
QUALIFY row_number() OVER (PARTITION BY experiment_id ORDER BY prio) = 1""")
def ab_list(spark, root):
    _, exps, _ = _setup(spark, root)
    return AB.listing(exps)


@register("ab_stop", ops="B14,B12", doubles=("diff", "effect_size", "t_stat"),
          sql=EXP_SQL.replace("FROM events e JOIN exps x ON e.event_type = x.event_type)", """
  FROM events e JOIN exps x ON e.event_type = x.event_type
  WHERE e.ts <= x.started_at + INTERVAL 10 DAY)""") + """
SELECT experiment_id, control_size, treatment_size, diff, effect_size,
       CASE WHEN std_error > 0 THEN diff / std_error END AS t_stat,
       CAST(10 AS BIGINT) AS days_run, false AS overdue
FROM st3""")
def ab_stop(spark, root):
    """Every experiment stopped ten days after its start, with the final
    analysis of its rows up to then (p-value and text: ``ab_decision``)."""
    e, exps, obs = _setup(spark, root)
    exps = exps.withColumn("stopped_at", F.col("started_at") + F.expr("INTERVAL 10 DAYS"))
    obs = obs.join(e.select("event_id", "ts"), "event_id")
    return AB.final_analysis(exps, obs).select(
        "experiment_id", "control_size", "treatment_size", "diff", "effect_size", "t_stat",
        "days_run", "overdue")


@register("ab_sample_size", ops="B1", doubles=("power",), sql=EXP_SQL + """
SELECT x.experiment_id, p.power, s.two_sided,
  CAST(ceil(2.0 * pow(((CASE WHEN s.two_sided THEN 1.9599639845400536 ELSE 1.6448536269514715 END)
                      + (CASE WHEN p.power = 0.95 THEN 1.6448536269514715
                              ELSE 0.8416212335729144 END)) / x.min_effect_size, 2)) AS BIGINT)
    AS required_sample_size
FROM exps x CROSS JOIN (VALUES (0.8::DOUBLE), (0.95::DOUBLE)) p(power)
CROSS JOIN (VALUES (true), (false)) s(two_sided)""")
def ab_sample_size(spark, root):
    """B1 planning grid: required n per experiment for power 0.8 / 0.95,
    one- and two-sided (normal quantiles by pandas UDF)."""
    _, exps, _ = _setup(spark, root)
    grid = exps.select("experiment_id", "min_effect_size", "significance_level",
                       F.explode(F.array(dbl(0.8), dbl(0.95))).alias("power"))
    grid = grid.select("*", F.explode(F.array(F.lit(True), F.lit(False))).alias("two_sided"))
    two = AB.required_sample_size(F.col("min_effect_size"), F.col("power"),
                                  F.col("significance_level"), True)
    one = AB.required_sample_size(F.col("min_effect_size"), F.col("power"),
                                  F.col("significance_level"), False)
    return grid.select("experiment_id", "power",
                       "two_sided",
                       F.when(F.col("two_sided"), two).otherwise(one)
                       .alias("required_sample_size"))
