"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.llm import (align, decontaminate, html, lm, merkle, merkle_sql, packing, pii,
                           quality, secrets, simhash, sketch, toxicity, urls)
from rankforge.llm.common import table
from rankforge.llm.labelled import fold_of

TOKENIZER = "word_bpe_49k.json"
BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"

# The rules of the contract.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"),
             ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
             ("net", "/fr/", "block")]


def _digest(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def _spans(found: DataFrame, spans: str, kinds: tuple[str, ...]) -> DataFrame:
    """The columns of the two span contracts."""
    base = F.filter(F.col(spans), lambda s: s["kind"].isin(*kinds))
    counts = [_count(F.col(spans), k).alias(f"n_{k}") for k in kinds]
    return found.select("doc_id", *counts, F.sha2(_digest(base), 256).alias("base_sha256"),
                        _digest(F.col(spans)).alias("spans"))


def op1_html_extraction(spark: SparkSession, root: str) -> DataFrame:
    """Visible text of all ``pages``.  Null HTML gives null, HTML without visible
    text an empty text; repeated rows stay; an empty table gives no rows."""
    pages = table(spark, root, "pages")
    return html.extract(pages.select("page_id", "url", "html")).withColumn(
        "n_chars", F.char_length("text").cast("long"))


def op2_decontamination(spark: SparkSession, root: str) -> DataFrame:
    """Documents that hold a ``benchmark`` item: (doc_id, item_id, similarity,
    same).  Null and empty texts match nothing; rows that share an id count as one
    document; an empty table (of either side) gives no rows."""
    return decontaminate.contaminated(table(spark, root, "documents"),
                                      table(spark, root, "benchmark"))


def op3_pii(spark: SparkSession, root: str) -> DataFrame:
    """Personal data in all ``documents``.  Null texts count as empty (no spans);
    repeated rows stay; an empty table gives no rows."""
    docs = table(spark, root, "documents")
    found = pii.find(docs.select("doc_id", "text"), pii.train(docs))
    return _spans(found.drop("text"), "spans", pii.BASE_KINDS)


def op4_secret_scan(spark: SparkSession, root: str) -> DataFrame:
    """Secrets in all ``documents``.  Null texts count as empty (no spans); equal
    texts are scanned once, each row gets its findings; an empty table gives no rows."""
    docs = table(spark, root, "documents").select("doc_id", "text")
    return _spans(secrets.scan_versions(docs), "findings", secrets.KINDS[:3])


def op5_simhash(spark: SparkSession, root: str) -> DataFrame:
    """Fingerprints and components of all ``documents``.  Texts without words
    (null ones too) have fingerprint zero and are linked like any other; rows that
    share an id share a component; an empty table gives no rows."""
    found = simhash.near_duplicates(table(spark, root, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        "component_id")


def op6_packing(spark: SparkSession, root: str) -> DataFrame:
    """Places of all pieces of ``documents`` in sequences of 2,048 tokens.  Null and
    empty texts are the end id alone; repeated rows are documents of their own; an
    empty table gives no rows."""
    return packing.pack(table(spark, root, "documents"), public_tokenizers.path(TOKENIZER))


def op7_fingerprints(spark: SparkSession, root: str) -> DataFrame:
    """Bottom-k sketches of all ``documents``, of their edited texts, and likeness to
    these and to the next document (ids ascending, null first; rows of one id by
    text).  Null texts count as empty; an empty table gives no rows."""
    docs = table(spark, root, "documents").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("sketch", sketch.sketch_of(F.col("text")))
    pairs = sketch.with_next(docs, {"text": "next_text", "sketch": "next_sketch"}, ties=["text"])
    n = F.char_length("text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.left("text", n - cut), F.left("next_text", cut))
    pairs = pairs.select("doc_id", n.cast("long").alias("n_chars"), "sketch", "next_sketch",
                         edited.alias("edited"))
    pairs = pairs.select("doc_id", "n_chars", "sketch", "next_sketch",
                         F.sha2("edited", 256).alias("edited_sha256"),
                         sketch.sketch_of(F.col("edited")).alias("edited_sketch"))
    return pairs.select(
        "doc_id", "n_chars", "edited_sha256", sketch.as_text(F.col("sketch")).alias("fingerprint"),
        sketch.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        sketch.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        sketch.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        sketch.distinct_shingles(F.col("sketch")).alias("distinct_shingles"))


def op8_url_filter(spark: SparkSession, root: str) -> DataFrame:
    """Rule and verdict of every url of ``pages``.  Null urls and urls without
    ``://`` have empty parts, no rule and the default verdict; repeated rows stay; an
    empty table gives no rows."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge(table(spark, root, "pages").select("page_id", "url"), rules).drop("url")


def op9_toxicity(spark: SparkSession, root: str) -> DataFrame:
    """Toxicity of all ``documents``.  Null and empty texts get the score of a text
    without words; a null id has a null ``held_out``; repeated rows stay; without labels
    all scores are equal; an empty table gives no rows."""
    docs = table(spark, root, "documents")
    model = toxicity.train(docs, table(spark, root, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (fold_of("doc_id", 4) == 2).alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op10_quality(spark: SparkSession, root: str) -> DataFrame:
    """Quality of all ``documents``.  Null and empty texts are one passage of zeros; a
    null id has a null ``held_out``; repeated rows stay; without labels all scores are
    0.5; an empty table gives no rows."""
    docs = table(spark, root, "documents")
    model = quality.train(docs, table(spark, root, "labels"))
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (fold_of("doc_id", 3) == 1).alias("held_out"), "score",
                         (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op11_tokenizer_alignment(spark: SparkSession, root: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers over all ``documents``.

    Null and empty texts and texts that the tokenizers do not give back byte for
    byte have zeros and an empty digest; repeated rows are documents of their
    own; an empty table gives no rows.
    """
    found = align.align_corpus(table(spark, root, "documents"), public_tokenizers.path(BYTE_LEVEL),
                               public_tokenizers.path(PIECES))
    return found.select("doc_id", "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links",
                        "n_best", "count_sum", "groups_sha256")


def op12_lm_scores(spark: SparkSession, root: str) -> DataFrame:
    """Log10 probabilities of all ``documents`` by an add-one unigram model over
    words and by the self-attention model.

    Null texts count as empty (the end alone); rows with a null id are learned
    from; repeated rows are documents of their own; an empty table gives no rows.
    """
    docs = table(spark, root, "documents")
    out = F.coalesce(fold_of("doc_id", 7) == 2, F.lit(False))
    texts = lm.encoded(docs, public_tokenizers.path(BYTE_LEVEL), ~out)
    model = lm.learn(texts, public_tokenizers.path(BYTE_LEVEL))
    return lm.likelihoods(texts, model).withColumnRenamed("id", "doc_id").select(
        "doc_id", out.alias("held_out"), "n_tokens", "n_known",
        F.lit(model.train_tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op13_merkle_manifest(spark: SparkSession, root: str) -> DataFrame:
    """Leaf, group and dataset digests of all ``documents``, and whether each
    row, with its line breaks deleted where the crc32 of its id is even, still
    leads to the root.  A null id is never tampered with; repeated rows are
    leaves of their own; an empty table gives no rows.
    """
    docs = table(spark, root, "documents").select(*merkle.FIELDS)
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    docs = docs.withColumn("tampered", F.when(F.coalesce(even, F.lit(False)),
                                              F.replace("text", F.lit("\n"), F.lit("")))
                           .otherwise(F.col("text")))
    found = merkle.manifest(docs, "tampered")
    folded = merkle.fold_path(F.col("tampered_leaf"), F.col("path"))
    return found.select("doc_id", "leaf", "subroot", "root",
                        F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"),
                        folded.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_html_extraction, op2_decontamination, op3_pii, op4_secret_scan,
                            op5_simhash, op6_packing, op7_fingerprints, op8_url_filter,
                            op9_toxicity, op10_quality, op11_tokenizer_alignment,
                            op12_lm_scores, op13_merkle_manifest)}

ORACLE_SQL = {"op13_merkle_manifest": merkle_sql.sql(), "op8_url_filter": r"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://')
                       THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw_host FROM cut),
p AS (
  SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path FROM parts),
r(rule_host, rule_path, rule_verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
best AS (
  SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(rule_verdict, length(rule_host || rule_path)) AS verdict
  FROM p JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host))
               AND starts_with(path, rule_path) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM p LEFT JOIN best USING (page_id)
"""}
