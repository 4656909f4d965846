"""Table sources: the driver's parquet tables and the interaction view over them.

All readers are lazy; Catalyst prunes columns and pushes filters into the
parquet scan, so callers should not pre-select.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.functions.columns import epoch_seconds

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

INTERACTION_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType(), True),
    T.StructField("item_id", T.LongType(), True),
    T.StructField("rating", T.DoubleType(), True),
    T.StructField("interaction_type", T.StringType(), True),
    T.StructField("timestamp", T.DoubleType(), True),
    T.StructField("session_id", T.StringType(), True),
])

STREAM_INTERACTION_SCHEMA = T.StructType(
    INTERACTION_SCHEMA.fields
    + [T.StructField("context", T.MapType(T.StringType(), T.StringType()), True)])

PROFILE_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType(), True),
    T.StructField("avg_rating", T.DoubleType(), True),
    T.StructField("interaction_count", T.LongType(), True),
    T.StructField("last_interaction", T.DoubleType(), True),
])

ITEM_CSV_SCHEMA = T.StructType([
    T.StructField("item_id", T.LongType(), True),
    T.StructField("title", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("price", T.DoubleType(), True),
    T.StructField("brand", T.StringType(), True),
    T.StructField("description", T.StringType(), True),
])

# Return flag -> interaction type of the interaction mapping.
RETURNFLAG_TO_TYPE = {"N": "purchase", "A": "view", "R": "rating"}


class Tables:
    """Lazy access to the parquet tables of one scale-factor directory."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(os.path.join(self.root, f"{name}.parquet"))
        raise AttributeError(name)

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)


def interaction_type_col(flag) -> F.Column:
    expr = None
    for k, v in RETURNFLAG_TO_TYPE.items():
        expr = (F.when(flag == k, F.lit(v)) if expr is None else expr.when(flag == k, F.lit(v)))
    return expr.otherwise(F.lit("other"))


def interactions(t: Tables, with_keys: bool = False) -> DataFrame:
    """interactions = lineitem joined to its order.

    user = o_custkey, item = l_partkey, rating = ceil(l_quantity / 10),
    type from l_returnflag, timestamp = epoch seconds of o_orderdate,
    session = 'session_' || l_orderkey.  ``with_keys`` keeps the lineitem key
    columns used as a total tie-break order.

    At scale this is the one big shuffle join of the product (orders x
    lineitem on the order key); bucketing both tables by order key removes it.
    """
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                           "l_quantity", "l_returnflag")
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    j = li.join(o, "l_orderkey")
    cols = [
        F.col("o_custkey").cast("long").alias("user_id"),
        F.col("l_partkey").cast("long").alias("item_id"),
        F.ceil(F.col("l_quantity") / F.lit(10.0)).cast("double").alias("rating"),
        interaction_type_col(F.col("l_returnflag")).alias("interaction_type"),
        epoch_seconds("o_orderdate").alias("timestamp"),
        F.concat(F.lit("session_"), F.col("l_orderkey").cast("string")).alias("session_id"),
    ]
    if with_keys:
        cols += [F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_suppkey")]
    return j.select(*cols)


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """``df`` as a table of the session catalog, bucketed and sorted by
    ``key``.  Tables of equal bucket counts join on the key without a shuffle.

    Rows are dealt to the buckets' tasks first, so each bucket is one file.
    Rows of one key stay together, as any join on the key needs; null keys, which
    join nothing, lie in one bucket.
    """
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
     .option("path", path).mode("overwrite").format("parquet").saveAsTable(name))
    return df.sparkSession.table(name)


def bucketed_tables(t: Tables, path: str, name: str, buckets: int) -> Tables:
    """The tables with lineitem and orders written in buckets by order key."""
    li = write_bucketed(t.lineitem, f"{name}_lineitem", f"{path}/lineitem", "l_orderkey", buckets)
    o = write_bucketed(t.orders, f"{name}_orders", f"{path}/orders", "o_orderkey", buckets)
    out = Tables(t.spark, t.root)
    out.__dict__.update(lineitem=li, orders=o)
    return out


def users(t: Tables) -> DataFrame:
    """User dimension: customer with nation and region names."""
    n = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    r = t.region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    c = t.customer.select(F.col("c_custkey").alias("user_id"), "c_nationkey", "c_acctbal",
                          "c_mktsegment")
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .join(r, "n_regionkey", "left")
            .select("user_id", F.col("c_acctbal").alias("user_acctbal"),
                    F.col("c_mktsegment").alias("user_segment"),
                    F.col("c_nationkey").alias("user_nation"),
                    F.col("n_name").alias("user_location"), F.col("r_name").alias("user_region")))


def items(t: Tables) -> DataFrame:
    """Item dimension from ``part``."""
    return t.part.select(F.col("p_partkey").alias("item_id"),
                         F.col("p_type").alias("item_category"),
                         F.col("p_brand").alias("item_brand"),
                         F.col("p_size").alias("item_size"),
                         F.col("p_retailprice").alias("item_price"))


def read_interactions_csv(spark: SparkSession, path: str) -> DataFrame:
    """Interaction seed CSV, columns matched by header name."""
    schema = T.StructType([
        T.StructField("user_id", T.LongType()), T.StructField("item_id", T.LongType()),
        T.StructField("rating", T.DoubleType()), T.StructField("timestamp", T.DoubleType()),
        T.StructField("interaction_type", T.StringType()),
        T.StructField("session_id", T.StringType())])
    df = spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(path)
    return df.select(*[f.name for f in INTERACTION_SCHEMA.fields])


def read_items_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(ITEM_CSV_SCHEMA).csv(path)
