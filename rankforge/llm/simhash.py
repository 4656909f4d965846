"""SimHash near-duplicates by covering locality-sensitive hashing
(Pagh, "CoveringLSH: Locality-sensitive Hashing without False Negatives", 2016).

Each bit position gets a non-zero vector of radius + 1 bits; table v keeps the
positions whose vector has an odd product with v.  Any ``radius`` positions
span at most ``radius`` dimensions, so a v exists that drops them all: two
fingerprints within the radius share that table's key.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.llm.common import fresh, settle
from rankforge.llm.components import components

BITS = 64
SEED = 42
_BLOCK = 1 << 15


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash: a bit is set if over half of the shingles' XXH64 have it."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()   # ASCII case and space
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if n > 1 else \
        iter([b" ".join(words)])
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), "<u8", n)
    counts = np.zeros(BITS, np.int64)
    for i in range(0, n, _BLOCK):
        bits = np.unpackbits(hashes[i:i + _BLOCK].view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = 3) -> Column:
    """The fingerprint as a signed long; null texts count as empty."""
    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        prints = np.array([fingerprint(x.as_py(), shingle) for x in texts], np.uint64)
        return pa.array(prints.view(np.int64))
    return of(text)


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """The bit masks of the 2 ** (radius + 1) - 1 tables."""
    tables = (2 << radius) - 1
    return [sum(1 << i for i in range(bits) if (v & (1 + i % tables)).bit_count() % 2)
            for v in range(1, tables + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """Links (u, v) that connect all distinct ``fp`` within ``radius`` differing bits.

    Only fingerprints that share a table's key with another one go on.  Each
    then visits itself and its one-bit neighbours among the positions those
    tables drop.  Two fingerprints within two bits meet at such a point; all
    that meet there are within two bits of each other, and at most 65 can.
    So a star at each point holds every link, and no bucket, however large,
    is ever expanded into pairs.  Radius 0 to 2; else ValueError.
    """
    if radius not in (0, 1, 2):
        raise ValueError("radius must be 0, 1 or 2")
    masks = covering_masks(radius)
    keyed = prints.select("fp", F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"),
                 F.lit(_signed(~m & (1 << 64) - 1)).alias("free"))
        for t, m in enumerate(masks)])).alias("k")).select("fp", "k.*")
    shared = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = (keyed.join(shared.select("t", "key"), ["t", "key"])
           .groupBy("fp").agg(F.bit_or("free").alias("free")))
    near = met.select("fp", F.explode(F.concat(F.array(F.lit(-1)), F.filter(
        F.sequence(F.lit(0), F.lit(BITS - 1)),
        lambda b: F.call_function("shiftright", F.col("free"), b).bitwiseAND(F.lit(1)) == 1)))
        .alias("bit"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest(F.col("bit"), F.lit(0)))
    at = near.select("fp", (F.col("bit") < 0).alias("self"), F.when(F.col("bit") < 0, F.col("fp"))
                     .otherwise(F.col("fp").bitwiseXOR(one)).alias("point"))
    # Radius 1 links a fingerprint only with the neighbours that visit it.
    hub = F.min("fp") if radius == 2 else F.min(F.when(F.col("self"), F.col("fp")))
    stars = at.groupBy("point").agg(hub.alias("v"), F.collect_set("fp").alias("us"))
    return (stars.filter((F.size("us") > 1) & F.col("v").isNotNull())
            .select(F.explode("us").alias("u"), "v").filter(F.col("u") != F.col("v"))
            .filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, radius: int = 2) -> DataFrame:
    """Every row's (id, ``fp`` long, ``component_id``): the smallest id that can
    be reached over fingerprints within ``radius`` bits.

    Rows are kept as they are: repeated ids give repeated rows, a null id
    takes part but is never the smallest (``component_id`` is null if no
    member has an id), null and empty texts share fingerprint zero.  Copies
    meet as one fingerprint before any search.
    """
    i = F.col(id_col)
    prints = settle(docs.select(i.alias("id"),
                                fingerprint_column(F.col(text_col), shingle).alias("fp")),
                    "simhash")
    groups = settle(prints.groupBy("fp").agg(F.min("id").alias("least")), "simhash-groups")
    roots = components(links(groups.select("fp"), radius))
    # A root has no row of its own in the components.
    member = roots.select(F.col("node").alias("fp"), "root").union(
        roots.select(F.col("root").alias("fp"), "root").distinct())
    joined = member.join(groups, "fp")
    smallest = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = joined.join(smallest, "root").select("fp", "component_id")
    known = groups.join(linked, "fp", "left").select(
        "fp", F.coalesce("component_id", "least").alias("component_id"))
    return prints.join(known, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = 3, radius: int = 2) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row
    with the smallest id stays; of rows that share that id, the first by text
    hash and the other columns' hash.  Rows without an id have no
    representative to lose to and stay."""
    found = near_duplicates(docs, id_col, text_col, shingle, radius)
    leads = (found.filter(F.col(id_col) == F.col("component_id")).select(id_col).distinct())
    rank, = fresh(docs, "rank")
    order = Window.partitionBy(id_col).orderBy(F.xxhash64(text_col),
                                               F.xxhash64(*docs.columns))
    first = (docs.join(leads, id_col, "left_semi").withColumn(rank, F.row_number().over(order))
             .filter(F.col(rank) == 1).select(*docs.columns))
    return first.unionByName(docs.filter(F.col(id_col).isNull()))
