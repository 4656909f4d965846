"""URL rules by host-suffix and path-prefix expressions.

Each (host, path) is expanded into every suffix of its labels with every path
prefix that some rule is as long as.  Expressions meet rules by the first
eight hex digits of their SHA-256; the full digest confirms, and the longest
rule decides.  Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/ ? #``, A-Z in lower case; else empty."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(rest, F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``? #``; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url",
          default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` (columns of
    these names are replaced).

    ``rules`` has host, path and verdict.  A rule fits its host and all
    subdomains if the path starts with the rule's; the longest rule (host and
    path together, then host) decides, among equal rules ``block``.  Without
    a rule, ``rule`` is null and the verdict is ``default``.  Urls that are
    null or lack ``://`` have empty parts.  Distinct (host, path) pairs are
    judged once, however many pages share them.
    """
    own = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    url = F.col(f"`{url_col}`").cast("string")
    parts = pages.select(*[F.col(f"`{c}`") for c in own], host_of(url).alias("host"),
                         path_of(url).alias("path"))
    rules = rules.select(F.translate(F.coalesce("host", F.lit("")), _UPPER, _LOWER).alias("r_host"),
                         F.coalesce("path", F.lit("")).alias("r_path"),
                         F.col("verdict").alias("r_verdict"))
    lengths = rules.agg(F.collect_set(F.char_length("r_path"))).scalar()
    labels = F.split("host", r"\.", -1)
    places = parts.select("host", "path").distinct()
    # Suffixes with as many labels as some rule's host, and as long paths.
    depths = rules.agg(F.collect_set(F.size(F.split("r_host", r"\.", -1)))).scalar()
    hosts = F.transform(F.filter("depths", lambda d: d <= F.size("labels")), lambda d: F.array_join(
        F.slice("labels", F.size("labels") - d + 1, d), "."))
    tried = (places.withColumn("lengths", lengths).withColumn("ends", F.filter(
        "lengths", lambda n: n <= F.char_length("path")))
             .withColumn("depths", depths).withColumn("labels", labels)
             .select("host", "path", "ends", F.explode(hosts).alias("e_host"))
             .select("host", "path", "e_host", F.explode("ends").alias("end"))
             .withColumn("full", _digest(F.col("e_host"), F.left("path", F.col("end")))))
    keyed = rules.withColumn("r_full", _digest(F.col("r_host"), F.col("r_path")))
    short = lambda c: F.substring(c, 1, PREFIX)
    fits = (tried.withColumn("short", short("full"))
            .join(keyed.withColumn("short", short("r_full")), "short")
            .filter(F.col("full") == F.col("r_full")))
    host_len, path_len = F.char_length("r_host"), F.char_length("r_path")
    best = fits.groupBy("host", "path").agg(F.max(F.struct(
        (host_len + path_len).alias("n"), host_len.alias("h"), F.col("r_verdict").alias("verdict"),
        F.concat("r_host", "r_path").alias("rule"))).alias("best"))
    return parts.join(best, ["host", "path"], "left").select(
        *[F.col(f"`{c}`") for c in own], "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
