"""Content-addressed Merkle manifest of a table, with an inclusion proof for every row.

Rows become leaf digests; within a group (a source) leaves ascend by id, and
every ``FAN`` consecutive nodes become the digest of their joined digests until
one node is left.  The groups' digests, by group name, make the root in the same way.

The tree is stored as digest-to-children records, packed into segments of
``DEPTH`` levels that are found by the digest of their top node.  Requests for
all leaves descend from the root: the digits of a rank, base ``FAN``, choose a
child on each level, the unselected children are collected, and the reversed
segments make the path from leaf to root.  Requests below the same node travel
as one row, so a segment is read once however many leaves lie below it and no
key is hot.

Nulls are values of their own (``-``); a null group comes first; rows with the
same id are ordered by their digest, and repeated rows are leaves of their own
whose order cannot be told apart; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from rankforge.llm.common import settle

FAN = 3
#: Levels of a segment: at most ``FAN ** DEPTH`` requests travel in one row.
DEPTH = 4
SPAN = FAN ** DEPTH
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_RECORD = pa.struct([("digest", pa.string()), ("children", pa.list_(pa.string()))])
_SEGMENT = pa.struct([("top", pa.string()), ("records", pa.list_(_RECORD))])
_STEP = pa.struct([("digest", pa.string()), ("path", pa.list_(pa.string()))])


def digest(joined: str) -> str:
    return hashlib.sha256(joined.encode()).hexdigest()


def leaf_digest(*values: Column) -> Column:
    """Digest of a row: ``-`` for a null, else UTF-8 byte count, ``:``, value."""
    def part(c: Column) -> Column:
        s = c.cast("string")
        return F.when(s.isNull(), "-").otherwise(
            F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))
    return F.sha2(F.concat(*[part(c) for c in values]), 256)


def with_rank(df: DataFrame, group: str, order: list[str], rank: str = "rank") -> DataFrame:
    """``df`` with the place (0, 1, ...) of each row within ``group`` by ``order``.

    Rows are dealt by ranges of (group, order) and written; a row's place is the
    rows of its group in earlier ranges and those before it in its own range,
    so no group has to fit one task.  Rows that are equal in ``order`` are told
    apart by their place in the written input.
    """
    df = df.withColumn("row", F.monotonically_increasing_id())
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = settle(settle(df, "manifest-rows").repartitionByRange(ranges, group, *order, "row")
                   .withColumn("part", F.spark_partition_id()), "manifest-ranges")
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = dealt.groupBy(group, "part").agg(F.count(F.lit(1)).alias("n")).select(
        group, "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy(group, "part").orderBy(*order, "row")
    return (dealt.withColumn("nth", F.row_number().over(inside) - 1)
            .join(before, [group, "part"])
            .withColumn(rank, F.col("before") + F.col("nth"))
            .drop("row", "part", "nth", "before"))


@F.arrow_udf(from_arrow_type(_SEGMENT))
def _fold(digests: pa.Array, levels: pa.Array) -> pa.Array:
    """Top digest and records of each segment from its bottom digests."""
    out = []
    for nodes, depth in zip(digests.to_pylist(), levels.to_pylist()):
        records: dict[str, list[str]] = {}
        for _ in range(depth):
            runs = [nodes[i:i + FAN] for i in range(0, len(nodes), FAN)]
            nodes = [digest("".join(r)) for r in runs]
            records.update(zip(nodes, runs))
        out.append({"top": nodes[0],
                    "records": [{"digest": d, "children": c} for d, c in records.items()]})
    return pa.array(out, _SEGMENT)


@F.arrow_udf(from_arrow_type(pa.list_(_STEP)))
def _descend(top: pa.Array, levels: pa.Array, size: pa.Array, records: pa.Array,
             above: pa.Array) -> pa.Array:
    """For every place below a segment's top: the digest there and its path up
    to the root.  A level of a path is the place among the run, then the other digests."""
    out = []
    for root, depth, n, rows, tail in zip(*(x.to_pylist() for x in (top, levels, size, records,
                                                                    above))):
        children = {r["digest"]: r["children"] for r in rows}
        found = []
        for rank in range(n):
            node, segment = root, []
            for level in range(depth - 1, -1, -1):
                run, k = children[node], rank // FAN ** level % FAN
                segment.append(str(k) + "".join(run[:k] + run[k + 1:]))
                node = run[k]
            found.append({"digest": node, "path": segment[::-1] + tail})
        out.append(found)
    return pa.array(out, pa.list_(_STEP))


def segments(nodes: DataFrame) -> list[DataFrame]:
    """Segments of all trees, from the leaves up: (key, block, levels, size,
    top, records, rows), ``rows`` being the ranked rows below a lowest segment.

    ``nodes`` has (key, rank, digest, row): one tree per key.
    """
    sizes = nodes.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    left = nodes.agg(F.max("rank")).first()[0]
    out = []
    while True:
        grouped = nodes.groupBy("key", F.floor(F.col("rank") / SPAN).alias("block")).agg(
            F.sort_array(F.collect_list(F.struct("rank", "digest", "row"))).alias("rows"))
        # Levels until one node is left, at most those of a segment.
        levels = F.size(F.filter(F.array(*[F.lit(FAN ** k).cast("long") for k in range(DEPTH)]),
                                 lambda x: x < F.col("n")))
        made = settle(
            grouped.join(sizes, "key").withColumn("levels", levels)
            .withColumn("made", _fold(F.col("rows.digest"), F.col("levels")))
            .select("key", "block", "n", "levels", F.size("rows").alias("size"), "made.top",
                    "made.records", F.col("rows.row").alias("rows")), "manifest-segments")
        out.append(made)
        if left is None or left < SPAN:
            return out
        left = left // SPAN
        nodes = made.filter(F.col("n") > SPAN).select(
            "key", F.col("block").alias("rank"), F.col("top").alias("digest"),
            F.lit(None).cast("struct<none: int>").alias("row"))
        sizes = sizes.filter(F.col("n") > SPAN).select("key", F.ceil(F.col("n") / SPAN).alias("n"))


def tops(built: list[DataFrame]) -> DataFrame:
    """(key, top): the single node that is left of each tree."""
    last = [s.filter(F.col("n") <= SPAN).select("key", "top") for s in built]
    out = last[0]
    for s in last[1:]:
        out = out.unionByName(s)
    return out


def descend(built: list[DataFrame], requests: DataFrame) -> DataFrame:
    """Paths of all rows: (key, row, digest, path, and what ``requests`` carry).

    ``requests`` has (key, digest, path, carry): the top node of each tree and
    its path further up.  Segment by segment, requests find their records by digest.
    """
    now = None
    for depth in range(len(built) - 1, -1, -1):
        made = built[depth]
        # Trees whose top lies in this segment start here.
        start = made.filter(F.col("n") <= SPAN).select("key", "block").join(requests, "key")
        now = start if now is None else now.unionByName(start)
        packs = made.select(F.col("top").alias("digest"), "levels", "records") \
            .dropDuplicates(["digest"])
        below = made.select("key", "block", "size", "rows")
        found = (now.join(packs, "digest").join(below, ["key", "block"])
                 .withColumn("steps", _descend("digest", "levels", "size", "records", "path"))
                 .select("key", "block", "carry", F.posexplode(
                     F.arrays_zip("steps", "rows")).alias("at", "z")))
        now = found.select("key", (F.col("block") * SPAN + F.col("at")).alias("block"),
                           F.col("z.steps.digest").alias("digest"),
                           F.col("z.steps.path").alias("path"), "carry",
                           F.col("z.rows").alias("row"))
        if depth:
            now = settle(now.drop("row"), "manifest-requests")
    return now.drop("block")


def fold_path(leaf: Column, path: Column) -> Column:
    """The root that a leaf digest and the other digests of its path lead to."""
    def up(acc: Column, level: Column) -> Column:
        cut = level.substr(1, 1).cast("int") * 64
        return F.sha2(F.concat(F.substring(level, F.lit(2), cut), acc,
                               F.substring(level, cut + 2, F.lit(64 * FAN))), 256)
    return F.aggregate(path, leaf, up)


def siblings(path: Column) -> Column:
    """The other digests of a path, joined from the leaf up."""
    return F.array_join(F.transform(path, lambda level: F.substring(level, F.lit(2),
                                                                    F.lit(64 * FAN))), "")


def manifest(docs: DataFrame, tampered_col: str | None = None,
             fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id",
             group_col: str = "source") -> DataFrame:
    """One row for each row of ``docs``: (id, leaf, subroot, root, path, extra).

    ``path`` has a string for each level, from the leaf up: the node's place
    among its run, then the digests of the others.  ``tampered_col`` names a
    column that replaces ``text`` in a second leaf digest, ``tampered_leaf``
    (else equal to ``leaf``).  All other columns are ignored.
    """
    leaf = leaf_digest(*[F.col(f) for f in fields])
    other = leaf if tampered_col is None else F.when(
        F.col("text").eqNullSafe(F.col(tampered_col)), leaf).otherwise(
        leaf_digest(*[F.col(tampered_col if f == "text" else f) for f in fields]))
    # A key that is never null and sorts nulls first, others by their bytes.
    key = F.when(F.col(group_col).isNull(), "").otherwise(
        F.concat(F.lit("="), F.col(group_col).cast("string")))
    rows = docs.select(key.alias("key"), F.col(id_col).cast("long").alias("id"),
                       leaf.alias("digest"), other.alias("other"))
    ranked = with_rank(rows, "key", ["id", "digest", "other"])
    built = segments(ranked.select("key", "rank", "digest",
                                   F.struct("id", "other").alias("row")))
    named = tops(built).select(F.lit("").alias("key"), F.col("key").alias("name"),
                               F.col("top").alias("digest"))
    upper = segments(with_rank(named, "key", ["name"]).select(
        "key", "rank", "digest", F.struct("name").alias("row")))
    root = tops(upper).select("key", F.col("top").alias("digest"),
                              F.array().cast("array<string>").alias("path"),
                              F.struct(F.col("top").alias("root")).alias("carry"))
    groups = settle(descend(upper, root).select(
        F.col("row.name").alias("key"), "digest", "path",
        F.struct(F.col("carry.root").alias("root"), F.col("digest").alias("subroot"))
        .alias("carry")), "manifest-groups")
    found = descend(built, groups)
    return found.select(F.col("row.id").alias(id_col), F.col("digest").alias("leaf"),
                        "carry.subroot", "carry.root", "path",
                        F.col("row.other").alias("tampered_leaf"))
