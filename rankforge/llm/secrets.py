"""Secret scans over an incremental blob ledger.

Every historical version of a text is a blob, addressed by the SHA-256 of its
bytes.  A ledger in the shared folder holds the findings of each (blob, rule
version) pair that has been scanned; a run scans only pairs it lacks, and
joins findings back to every path and version that has the blob.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankforge.llm.common import fresh, settle
from rankforge.session import scratch_path

#: Goes up with every change of the rules below.
RULE_VERSION = 3
KINDS = ("assign", "access", "hex", "key", "jwt")

# The patterns of the contract, and two formats that the method adds.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_KEY = re.compile(r"-----(BEGIN|END) ([A-Z ]{0,40}PRIVATE KEY)-----")
# What follows a header without an END line: header fields, then base64 with line ends, also escaped ones.
_KEY_BODY = re.compile(r"(?:(?:\s|\\[nrt])*+(?:Proc-Type|DEK-Info|Content-Domain):[ \t]*+[^\s\\]++)*+"
                       r"[A-Za-z0-9+/=\s\\]*+")
# Starts only where a run starts, else a long run would be read once for each of its places.
_JWT = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}")

FINDING = "array<struct<kind:string,start:long,end:long>>"
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _keys(text: str) -> list[tuple[int, int]]:
    """Private keys from the header to the matching END line, or else to the end
    of the body.  A body ends at the next header or END line, so each character
    is read once."""
    out, marks = [], list(_KEY.finditer(text))
    for m, after in zip(marks, [*marks[1:], None]):
        if m[1] == "BEGIN":
            end = _KEY_BODY.match(text, m.end(), after.start() if after else len(text)).end()
            if after and after[1] == "END" and (after[2] == m[2] or end == after.start()):
                end = after.end()
            while text[end - 1].isspace():
                end -= 1
            out.append((m.start(), end))
    return out


def scan_text(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all secrets, by start, then kind as listed."""
    found = []
    if ":" in text or "=" in text:
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    # A run shorter than 24 is no match, so its place doesn't change the next one.
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    if "-----BEGIN " in text:
        found += [("key", *s) for s in _keys(text)]
    if ".eyJ" in text:
        found += [("jwt", *m.span()) for m in _JWT.finditer(text)]
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0])))


def _scan(text: Column) -> Column:
    @F.arrow_udf(FINDING)
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in scan_text(x.as_py() or "")]
                         for x in texts], _ARROW)
    return of(text)


def _blob(text_col: str) -> Column:
    return F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256)


def scan_ledger(versions: DataFrame, ledger: str, text_col: str = "text",
                rule_version: int = RULE_VERSION) -> DataFrame:
    """Bring the ledger up to date with all ``versions`` and return it:
    (blob, rule_version, findings), a row for each pair.

    Each run adds a folder of its own, so a run that broke off leaves at most
    rows of finished tasks, which are right and count as scanned.  Runs side
    by side may both scan a pair; pairs are made distinct on reading.
    """
    spark = versions.sparkSession
    schema = f"blob string, rule_version int, findings {FINDING}"
    # One text for each blob: copies collapse in the map tasks.
    unseen = versions.select(_blob(text_col).alias("blob"), F.coalesce(
        F.col(text_col).cast("string"), F.lit("")).alias("text")) \
        .groupBy("blob").agg(F.first("text").alias("text"))
    try:
        known = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(ledger)
        unseen = unseen.join(known.filter(F.col("rule_version") == rule_version).select("blob"),
                             "blob", "left_anti")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    done = unseen.select("blob", F.lit(rule_version).alias("rule_version"),
                         _scan(F.col("text")).alias("findings"))
    path = scratch_path(spark, "run").rsplit("/", 1)[1]
    done.write.parquet(f"{ledger}/{path}")
    now = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(ledger)
    return (now.filter(F.col("rule_version") == rule_version)
            .groupBy("blob", "rule_version").agg(F.first("findings").alias("findings")))


def scan_versions(versions: DataFrame, ledger: str | None = None, text_col: str = "text",
                  rule_version: int = RULE_VERSION) -> DataFrame:
    """All rows of ``versions`` without the text, with ``blob`` and ``findings``
    (kind, start, end in code points; empty if none) of their blob.

    Without ``ledger`` a new one in the shared folder is used.  Null texts
    count as empty; repeated rows stay; columns of these names are replaced.
    """
    ledger = ledger or scratch_path(versions.sparkSession, "ledger")
    book = scan_ledger(versions, ledger, text_col, rule_version)
    keep = [c for c in versions.columns if c.lower() not in (text_col.lower(), "blob", "findings")]
    paths = versions.select(*[F.col(f"`{c}`") for c in keep], _blob(text_col).alias("blob"))
    spans, = fresh(paths, "spans")
    found = book.filter(F.size("findings") > 0).select("blob", F.col("findings").alias(spans))
    return paths.join(found, "blob", "left").select(
        *[F.col(f"`{c}`") for c in keep], "blob",
        F.coalesce(spans, F.array().cast(FINDING)).alias("findings"))


def redact(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars",
           mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every finding replaced by ``mark`` (overlapping ones by one)
    and ``chars_col`` counted anew where something changed."""
    blob, findings = fresh(docs, "blob", "findings")
    book = scan_ledger(docs, scratch_path(docs.sparkSession, "ledger"), text_col)
    found = settle(book.filter(F.size("findings") > 0).select(
        F.col("blob").alias(blob), F.col("findings").alias(findings)), "found")

    @F.arrow_udf("string")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for text, found in zip(texts.to_pylist(), spans.to_pylist()):
            if found and text is not None:
                parts, at = [], 0
                for f in found:
                    if f["start"] >= at:
                        parts += [text[at:f["start"]], mark]
                    at = max(at, f["end"])
                text = "".join(parts) + text[at:]
            out.append(text)
        return pa.array(out, pa.string())

    out = docs.withColumn(blob, _blob(text_col)).join(found, blob, "left")
    out = out.withColumn(text_col, cut(F.col(text_col).cast("string"), F.col(findings)))
    if chars_col and chars_col in docs.columns:
        out = out.withColumn(chars_col, F.when(F.col(findings).isNull(), F.col(chars_col)).otherwise(
            F.char_length(text_col)).cast(docs.schema[chars_col].dataType))
    return out.select(*docs.columns)
