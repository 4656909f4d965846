"""Toxicity and quality: learning, held-out labels, edge cases."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rankforge.llm import quality, toxicity
from rankforge.llm.labelled import fold_of, labelled_sample

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name, folds, held, label, least", [
    ("op9_toxicity", 4, 2, "toxic", 0.85), ("op10_quality", 3, 1, "quality", 0.95)])
def test_held_out_labels(spark, name, folds, held, label, least):
    from rankforge.llm.queries import QUERIES
    rows = QUERIES[name](spark, SF).collect()
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    own = []
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == held)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= (0.3 if label == "toxic" else 0.5))
        if r.held_out and r.doc_id in labels:
            own.append((r.score, labels[r.doc_id]))
    pos, neg = [s for s, y in own if y], [s for s, y in own if not y]
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert auc >= least


def test_sample_is_bounded_and_clean(spark, make_docs):
    docs = make_docs([(1, "a"), (1, "b"), (2, None), (3, "c"), (4, "d"), (None, "e")])
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (4, 1), (4, 0), (9, 1), (None, 1)],
                                   "doc_id long, toxic int")
    got = labelled_sample(docs, labels, "toxic", F.lit(True), 10)
    assert got[["id", "text", "label"]].values.tolist() == [[1, "a", 1], [2, "", 0]]
    assert len(labelled_sample(docs, labels, "toxic", F.lit(True), 1)) <= 1
    none = labelled_sample(docs, labels, "toxic", fold_of("doc_id", 4) == 9, 10)
    assert len(none) == 0


@pytest.mark.parametrize("module", [toxicity, quality])
def test_without_labels_and_odd_texts(spark, make_docs, module):
    docs = make_docs([None, "", " \n ", "words", "%%% ###", "x " * 50_000, "é" * 9000])
    docs = docs.withColumnRenamed("lang", "score")
    labels = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    model = module.train(docs, labels)
    out = module.score(docs, model)
    assert out.columns == docs.columns and {r.score for r in out.collect()} == {0.5}
    assert module.score(docs.limit(0), model).count() == 0


def test_ftrl_is_sparse_and_finds_order():
    rng = np.random.default_rng(2)
    texts, labels = [], []
    for k in range(600):
        words = [f"w{i}" for i in rng.integers(0, 300, 30)]
        at = int(rng.integers(0, 29))
        words[at:at + 2] = ["not", "good"] if k % 2 else ["good", "not"]
        texts.append(" ".join(words))
        labels.append(k % 2)
    model = toxicity.fit(texts[:500], np.array(labels[:500], float), l1=1.0, epochs=8)
    score = model.totals(pa.array(texts[500:]))
    assert ((score > 0) == np.array(labels[500:], bool)).mean() > 0.97
    assert len(model.places) < 3000


def test_occurrences_stay_inside_their_text():
    one = toxicity.occurrences(pa.array(["a b c", "", "d e"]))
    alone = [toxicity.occurrences(pa.array([t]))[1] for t in ("a b c", "", "d e")]
    for i, places in enumerate(alone):
        assert sorted(one[1][one[0] == i]) == sorted(places)
    assert len(alone[0]) == 3 + 2 + 1


def test_attention_gradients():
    rng = np.random.default_rng(3)
    x, bags, y = rng.normal(size=(9, 4)), np.array([0, 2, 3, 9]), np.array([1.0, 0.0, 1.0])
    m = quality.Mil(np.zeros(4), np.ones(4), rng.normal(size=(4, 3)), rng.normal(size=3),
                    rng.normal(size=(3, 2)), rng.normal(size=(3, 2)), rng.normal(size=2),
                    rng.normal(size=3), rng.normal(size=1))

    def loss():
        p = m.forward(x, bags)[0]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))
    for p, g in zip(m.parameters(), m.gradients(x, bags, y)):
        flat, slope = p.reshape(-1), g.reshape(-1)
        for i in range(len(flat)):
            keep = flat[i]
            flat[i] = keep + 1e-6
            up = loss()
            flat[i] = keep - 1e-6
            down = loss()
            flat[i] = keep
            assert abs((up - down) / 2e-6 - slope[i]) < 1e-6


def test_passages_do_not_depend_on_the_batch():
    texts = ["a b c " * 60, "", "Ü! 12 x", "same same same"]
    x, bags = quality.passages(pa.array(texts))
    assert bags.tolist() == [0, 3, 4, 5, 6]
    for i, t in enumerate(texts):
        assert np.allclose(x[bags[i]:bags[i + 1]], quality.passages(pa.array([t]))[0])
