"""Bottom-k sketches of shingle hashes, with DataFrame functions only.

A text's sketch is the sorted array of its k smallest distinct 64-bit shingle
hashes.  The sketch of a union is made from the parts' sketches alone, so
parts may be sketched anywhere and merged in any order.  From two sketches
follow resemblance, containment and the number of distinct shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.llm.common import fresh

K = 128
SHINGLE = 5


def _let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` evaluated once per row."""
    return F.transform(F.array(value), then)[0]


def sketch_of(text: Column, k: int = K, shingle: int = SHINGLE) -> Column:
    """Sketch of a text column: words are split at ASCII white space, case is
    kept; a text with fewer words than a shingle is one shingle, null and
    texts without words have an empty sketch."""
    def of(hashes):
        n = F.size(hashes)
        one = F.array(F.aggregate(hashes, F.lit(42).cast("long"),
                                  lambda acc, h: F.xxhash64(acc, h)))
        many = F.transform(F.sequence(F.lit(0), n - shingle), lambda i: F.xxhash64(
            *[F.get(hashes, i + j) for j in range(shingle)]))
        return F.when(n == 0, F.array().cast("array<long>")).otherwise(F.slice(
            F.sort_array(F.array_distinct(F.when(n < shingle, one).otherwise(many))), 1, k))

    words = F.filter(F.split(F.coalesce(text.cast("string"), F.lit("")),
                             "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    return _let(F.transform(words, lambda w: F.xxhash64(w)), of)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of what two sketches stand for."""
    return F.slice(F.sort_array(F.array_distinct(F.concat(a, b))), 1, k)


def merge_groups(df: DataFrame, group_cols: list[str], sketch_col: str, k: int = K,
                 salts: int = 64) -> DataFrame:
    """One sketch for each group.  Hashes are first cut to k for each (group,
    salt), so a group with most of the rows is spread over ``salts`` tasks.
    Groups with empty sketches only keep an empty one; null sketches count as
    empty; a null group is a group."""
    h, salt, rank = fresh(df, "h", "salt", "rank")
    flat = df.select(*group_cols, F.explode_outer(sketch_col).alias(h)).distinct() \
        .withColumn(salt, F.pmod(F.xxhash64(h), F.lit(salts)))
    for keys in ([*group_cols, salt], group_cols):
        by = Window.partitionBy(*keys).orderBy(F.col(h).asc_nulls_last())
        flat = flat.withColumn(rank, F.row_number().over(by)).filter(F.col(rank) <= k).drop(rank)
    return flat.groupBy(*group_cols).agg(F.sort_array(F.collect_list(h)).alias(sketch_col))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity: the share of the union's k smallest hashes
    that both have.  1 for two empty sketches, 0 if only one is empty."""
    def of(union):
        return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(
            F.size(F.array_intersect(F.array_intersect(union, a), b)) / F.size(union))
    return _let(merge(a, b, k), of).cast("double")


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    share = (F.element_at(a, k).cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(k - 1.0) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has."""
    both = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), both / distinct_shingles(a, k)))


def as_text(sketch: Column) -> Column:
    """A sketch as text: the hex digits of its hashes in order, 16 each."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def with_next(docs: DataFrame, values: dict[str, str], id_col: str = "doc_id",
              ties: list[str] | None = None, buckets: int | None = None) -> DataFrame:
    """``docs`` with, for each (column, new name) of ``values``, the value of the
    next row by ascending id; the last row's next row is the first.  Null ids
    come first; rows with one id are ordered by the hash of the ``ties`` columns.

    Rows are dealt to ranges of ids whose bounds are approximate quantiles
    (``buckets``: twice the shuffle partitions), and the first row of each
    range also goes to the range before, so a window inside each range
    suffices.  Only the bounds and one id for each range pass the driver.
    """
    spark = docs.sparkSession
    bucket, key, prev, at, ghost = fresh(docs, "bucket", "key", "prev", "at", "ghost")
    buckets = buckets or max(32, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    shares = [i / buckets for i in range(1, buckets)]
    bounds = sorted(set(docs.agg(F.percentile_approx(id_col, shares)).first()[0] or []))
    low = F.array(*[F.lit(b).cast("long") for b in bounds]).cast("array<long>")
    dealt = docs.withColumn(key, F.struct(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(*(ties or [id_col])).alias("tie"))) \
        .withColumn(bucket, F.when(F.col(id_col).isNull(), 0).otherwise(
            F.size(F.filter(low, lambda b: b <= F.col(id_col)))))
    heads = sorted(dealt.groupBy(bucket).agg(F.min(key).alias(key)).collect())
    first = spark.createDataFrame(
        [(r[bucket], heads[i - 1][bucket], tuple(r[key])) for i, r in enumerate(heads)],
        f"{at} int, {prev} int, {ghost} struct<id:long,tie:long>")
    # At most ``buckets`` rows of four numbers.
    homes = dealt.join(F.broadcast(first), (F.col(bucket) == F.col(at)) & F.col(key).eqNullSafe(F.col(ghost)),
                       "left").drop(ghost)
    own = F.struct(F.col(bucket).alias("b"), F.lit(False).alias("g"))
    copy = F.struct(F.col(prev).alias("b"), F.lit(True).alias("g"))
    placed = homes.withColumn(ghost, F.explode(
        F.when(F.col(prev).isNull(), F.array(own)).otherwise(F.array(own, copy))))
    order = Window.partitionBy(f"{ghost}.b").orderBy(F.col(f"{ghost}.g"), F.col(key))
    out = placed.select("*", *[F.lead(c).over(order).alias(n) for c, n in values.items()])
    return out.filter(~F.col(f"{ghost}.g")).select(*docs.columns, *values.values())
