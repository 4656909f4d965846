"""Fingerprints and URL rules against plain Python."""

import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from rankforge.llm import sketch, urls
from rankforge.llm.queries import ORACLE_SQL, URL_RULES


def shingles(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_query_against_exact_likeness(run_query, texts):
    rows = {r.doc_id: r for r in run_query("op7_fingerprints")}
    ids = sorted(texts)
    assert sorted(rows) == ids
    off = []
    prints = {}
    for i, d in enumerate(ids):
        text, after = texts[d], texts[ids[(i + 1) % len(ids)]]
        cut = len(text) // 4
        edited = text[:len(text) - cut] + after[:cut]
        r = rows[d]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        off += [abs(r.near_edited - jaccard(shingles(text), shingles(edited))),
                abs(r.near_next - jaccard(shingles(text), shingles(after)))]
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        n = len(shingles(text))
        assert abs(r.distinct_shingles - n) <= (0 if n < sketch.K else 0.5 * n)
    assert max(off) < 0.2 and sum(off) / len(off) < 0.02


@pytest.mark.parametrize("buckets", [2, 7, 64])
def test_next_row(spark, make_docs, buckets):
    rows = [(i * i % 37, f"t{i}") for i in range(37)] + [(None, "null"), (36, "t6"), (36, "t6")]
    docs = make_docs(rows).select("doc_id", "text", F.col("lang").alias("bucket"))
    out = sketch.with_next(docs, {"text": "after"}, ties=["text"], buckets=buckets)
    assert out.columns == ["doc_id", "text", "bucket", "after"]
    got = out.collect()
    ties = {r.text: r.h for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, ties[r[1]]))
    want = sorted((str(i), t, order[(k + 1) % len(order)][1]) for k, (i, t) in enumerate(order))
    assert sorted((str(r.doc_id), r.text, r.after) for r in got) == want


def test_next_of_few_rows(make_docs):
    assert sketch.with_next(make_docs([]), {"text": "after"}).count() == 0
    assert [r.after for r in sketch.with_next(make_docs(["only"]), {"text": "after"}).collect()] == ["only"]


def test_sketches_merge(spark, make_docs):
    whole = " ".join(f"w{i}" for i in range(3000))
    half = " ".join(f"w{i}" for i in range(1500))
    docs = make_docs([whole, half, " ".join(f"w{i}" for i in range(1496, 3000)), None, "", "a b"])
    docs = docs.withColumn("s", sketch.sketch_of(F.col("text"))).select("doc_id", "s")
    s = {r.doc_id: r.s for r in docs.collect()}
    assert s[3] == s[4] == [] and len(s[5]) == 1 and len(s[0]) == sketch.K
    one = docs.filter("doc_id in (1, 2)").withColumn("h", F.lit("x"))
    merged = sketch.merge_groups(one, ["h"], "s").first()
    assert merged["s"] == s[0]
    pair = spark.createDataFrame([(s[0], s[1])], "a array<long>, b array<long>")
    a, b = F.col("a"), F.col("b")
    r = pair.select(sketch.merge(a, b).alias("m"), sketch.resemblance(a, b).alias("r"),
                    sketch.containment(b, a).alias("c"), sketch.containment(a, b).alias("d"),
                    sketch.distinct_shingles(a).alias("n")).first()
    assert r.m == s[0] and abs(r.r - 0.5) < 0.15 and r.c > 0.7 and abs(r.d - 0.5) < 0.2
    assert abs(r.n - 2996) < 900
    none = sketch.merge_groups(docs.filter("doc_id in (3, 4)").select("s", F.lit(None).cast("int").alias("g")),
                               ["g"], "s").collect()
    assert [(x.g, x.s) for x in none] == [(None, [])]


def slow_judge(url):
    host = path = ""
    if url is not None and "://" in url:
        m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S)
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1])
        path = m[2]
    fits = [(len(h + p), h + p, v) for h, p, v in URL_RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, "allow")))


URLS = [None, "", "no scheme", "http://", "https://Example.COM/en/x", "http://www.example.com/en/", "x://com",
        "http://com/", "http://a.b.net/es/1?x#y", "http://net/fr", "http://notcom/", "http://xexample.com/en/",
        "http://WWW.EXAMPLE.COM/en/?a=://b", "a://b://c.com/", "http://m.net/fr/a\nb?c", "http://é.net/fr/É",
        "http://..com//", "http://example.com/EN/", "ftp://user@www.example.com:80/en/"]


def test_judge(spark):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = spark.createDataFrame([(i, u, "old") for i, u in enumerate(URLS + URLS)],
                                  "page_id long, url string, verdict string")
    rows = urls.judge(pages, rules).collect()
    assert len(rows) == 2 * len(URLS)
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == slow_judge(r.url), r.url
    none = urls.judge(pages, rules.limit(0), default="block")
    assert {r.verdict for r in none.collect()} == {"block"}
    assert urls.judge(pages.limit(0), rules).count() == 0
    tie = rules.unionByName(spark.createDataFrame([("com", "/", "block")], rules.schema))
    got = urls.judge(pages.filter("url = 'http://com/'"), tie).first()
    assert (got.rule, got.verdict) == ("com/", "block")


def test_oracle(spark, run_query, sf_small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf_small}/pages.parquet'")
    want = sorted(con.execute(ORACLE_SQL["op8_url_filter"]).fetchall(), key=str)
    assert sorted((tuple(r) for r in run_query("op8_url_filter")), key=str) == want
    con.execute("CREATE OR REPLACE VIEW pages AS SELECT * FROM (VALUES " + ", ".join(
        f"({i}, {'NULL' if u is None else chr(39) + u + chr(39)})" for i, u in enumerate(URLS)) + ") t(page_id, url)")
    got = con.execute(ORACLE_SQL["op8_url_filter"]).fetchall()
    assert {r[0]: tuple(r[1:]) for r in got} == {i: slow_judge(u) for i, u in enumerate(URLS)}
