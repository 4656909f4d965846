"""The wide table: the same rows with fewer and narrower moves."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rankforge.operators import features, profiles
from rankforge.plans import q_models
from rankforge.sources.tables import Tables, interactions, items, users
from rankforge.streaming.jobs import derive


def plain(t):
    """Every step joined to whole rows, one after the other."""
    keyed = interactions(t, with_keys=True)
    inter = keyed.drop("l_orderkey", "l_linenumber", "l_suppkey")
    e = derive(inter).join(users(t), "user_id", "left").join(items(t), "item_id", "left")
    e = features.session_features(e)
    last = features.recency(keyed, tie_cols=["l_orderkey", "l_linenumber", "l_suppkey"]).groupBy(
        "user_id", "item_id", "timestamp").agg(
        F.min("time_since_last_interaction").alias("time_since_last_interaction"))
    popular = profiles.item_popularity(inter).select("item_id", "popularity")
    e = features.profile_lookup(e, profiles.user_profiles(inter),
                                profiles.item_features(inter).join(popular, "item_id"))
    e = e.join(profiles.type_counts(inter, ["purchase"]), "user_id", "left")
    return e.join(last, ["user_id", "item_id", "timestamp"], "left").na.fill(
        0.0, ["time_since_last_interaction"])


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    """Users and items that come twice or never, null keys, orders that come twice."""
    at, rng = str(tmp_path_factory.mktemp("wide")), random.Random(3)

    def table(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{at}/{name}.parquet")
    day = dt.datetime(1999, 1, 1)
    table("region", [(0, "r")], "r_regionkey int, r_name string")
    table("nation", [(k, f"n{k}", 0) for k in range(3)], "n_nationkey int, n_name string, n_regionkey int")
    table("customer", [(k, f"c{k}", (k or 0) % 3, 10.0 * (k or 0), "s") for k in [*range(8), 3, None]],
          "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    table("part", [(k, "p", f"b{k}", "t", k, 1.5 * (k or 0)) for k in [*range(12), 4, 4, None]],
          "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    table("orders", [(k, rng.choice([*range(10), None]), None if k == 5 else
                      day + dt.timedelta(days=rng.randrange(200))) for k in [*range(40), 7]],
          "o_orderkey long, o_custkey long, o_orderdate timestamp")
    table("lineitem", [(rng.choice([*range(41), None]), rng.choice([*range(14), None]), n, n,
                        rng.choice([None, 3.0, 17.0, 45.0]), rng.choice("NAR")) for n in range(200)],
          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
          " l_returnflag string")
    return at


def test_rows_are_those_of_the_plain_joins(spark, root):
    t = Tables(spark, root)
    cols = ["user_id", "item_id", *q_models.WIDE]
    got, want = (sorted((tuple(r) for r in df.select(*cols).collect()), key=str)
                 for df in (q_models.wide_features(t), plain(t)))
    assert len(want) > 150 and got == [pytest.approx(r, nan_ok=True) if None not in r else r for r in want]


def test_whole_rows_move_by_user_and_by_item_alone(spark, root):
    plan = q_models.wide_features(Tables(spark, root))._jdf.queryExecution().executedPlan().toString()
    moves = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert moves or "Broadcast" in plan
    assert not any(c in line for line in moves for c in ("session_id#", "timestamp#"))
