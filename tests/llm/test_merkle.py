import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from rankforge.llm import merkle

DOCS = "doc_id long, source string, lang string, n_chars long, text string, leaf string, path int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(d, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}"
               for v in (d["doc_id"], d["source"], d["lang"], d["n_chars"], text)])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def beside(tree, i):
    out = []
    for nodes in tree[:-1]:
        run = i // 3 * 3
        out.append((nodes[run:i], nodes[i + 1:run + 3]))
        i //= 3
    return out


def brute(docs):
    """doc rows to (id, leaf, subroot, root, siblings, folded tampered leaf)."""
    groups = {}
    for d in docs:
        groups.setdefault(d["source"], []).append((d["doc_id"], leaf_of(d, d["text"]), d))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = levels([x[1] for x in groups[s]])
    top = levels([trees[s][-1][0] for s in names])
    out = []
    for at, s in enumerate(names):
        for i, (doc, leaf, d) in enumerate(groups[s]):
            path = beside(trees[s], i) + beside(top, at)
            text = d["text"]
            if text and doc is not None and zlib.crc32(str(doc).encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded = leaf_of(d, text)
            for a, b in path:
                folded = h(*a, folded, *b)
            out.append((doc, leaf, trees[s][-1][0], top[-1][0],
                        "".join(x for a, b in path for x in a + b), folded))
    return out


def found(df):
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    df = df.withColumn("changed", F.when(F.coalesce(even, F.lit(False)),
                                         F.replace("text", F.lit("\n"), F.lit("")))
                       .otherwise(F.col("text")))
    out = merkle.manifest(df, "changed")
    out = out.select("doc_id", "leaf", "subroot", "root",
                     merkle.siblings(F.col("path")).alias("s"),
                     merkle.fold_path(F.col("tampered_leaf"), F.col("path")).alias("f"))
    return [tuple(r) for r in out.collect()]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


def test_query_equals_brute_force(run_query, documents):
    got = run_query("op13_merkle_manifest")
    want = brute([r.asDict() for r in documents.collect()])
    assert order([(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root)
                  for r in got]) == order([(*w[:4], h(w[4]), w[5]) for w in want])
    assert all(r.verified == (r.folded_root == r.root) for r in got)
    assert 0 < sum(r.verified for r in got) < len(got)


def test_odd_rows(spark):
    """Nulls in every column, repeated rows and ids, empty and long texts, a hot group."""
    rng = random.Random(3)
    rows = [(None, None, None, None, None, "x", 1), (7, "b", "en", 3, "a\nb", "x", 1),
            (7, "b", "en", 3, "a\nb", "x", 1), (7, "b", "fr", 3, "a\nb", "x", 1),
            (None, "b", "en", 0, "", "x", 1), (8, "", "en", 9, "é\n" * 50_000, "x", 1),
            (9, "é", None, None, "\n", "x", 1), (9, None, "de", 2, None, "x", 1)]
    rows += [(i, "hot" if i % 3 else f"s{rng.randrange(12)}", "en", i, "line\n" * (i % 4), "x", 1)
             for i in range(100, 500)]
    rng.shuffle(rows)
    docs = [dict(zip(("doc_id", "source", "lang", "n_chars", "text"), r)) for r in rows]
    assert order(found(spark.createDataFrame(rows, DOCS))) == order(brute(docs))


@pytest.mark.parametrize("n", [1, 3, 4, 81, 82, 244])
def test_heights(spark, n):
    rows = [(i, "s", "en", 1, f"t{i}", "x", 1) for i in range(n)]
    docs = [dict(zip(("doc_id", "source", "lang", "n_chars", "text"), r)) for r in rows]
    assert order(found(spark.createDataFrame(rows, DOCS))) == order(brute(docs))


def test_empty_table(spark):
    assert found(spark.createDataFrame([], DOCS)) == []
