import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from rankforge.llm import lm
from rankforge.llm.queries import BYTE_LEVEL

PATH = public_tokenizers.path(BYTE_LEVEL)
WORDS = re.compile(r"[^\x20\x09-\x0d]+")


def words_of(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def base(rows):
    """(id, held_out, n_tokens, n_known, N, base) of every row, word by word."""
    count = Counter()
    for doc, text in rows:
        if not held(doc):
            count.update(words_of(text) + [None])
    n, v = sum(count.values()), len(count)
    out = []
    for doc, text in rows:
        tokens = words_of(text) + [None]
        out.append((doc, held(doc), len(tokens), sum(count[t] > 0 for t in tokens), n,
                    sum(math.log10((count[t] + 1) / (n + v + 1)) for t in tokens)))
    return out


N_CLASSES = lm.GROUPS * lm.MEMBERS


def tiny(n_inputs=7, seed=0):
    rng = np.random.default_rng(seed)
    size = sum(math.prod(s) for s in lm.shapes(n_inputs).values())
    w = lm.unpack(rng.normal(0, 0.4, size), n_inputs)
    return {k: p.astype(np.float64) for k, p in w.items()}


def slow_log_prob(w, inputs, targets):
    """Class log probabilities of one stream, target by target."""
    out = []
    for t in range(len(targets)):
        low = max(0, t // lm.BLOCK * lm.BLOCK - lm.BLOCK)
        e = w["emb"][inputs]
        q = e[t] @ w["wq"] / math.sqrt(lm.WIDTH)
        s = np.array([q @ (e[j] @ w["wk"]) + w["far"][t - j] for j in range(low, t + 1)])
        a = np.exp(s) / np.exp(s).sum()
        c = sum(x * (e[j] @ w["wv"]) for x, j in zip(a, range(low, t + 1)))
        z = np.maximum(c @ w["wo"] + e[t] @ w["ws"] + w["b"], 0)
        g, m = divmod(int(targets[t]), lm.MEMBERS)
        groups, members = z @ w["ug"] + w["ug0"], z @ w["uw"][g] + w["uw0"][g]
        out.append(groups[g] - math.log(np.exp(groups).sum())
                   + members[m] - math.log(np.exp(members).sum()))
    return out


def test_windows_score_each_target_once():
    rng = np.random.default_rng(4)
    w, net = tiny(), None
    net = lm.Network(w)
    sizes = [1, 2, 15, 16, 17, 33, 100]
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    x, y = rng.integers(0, 7, bounds[-1]), rng.integers(0, N_CLASSES, bounds[-1])
    wx, hidden, wy, stream = lm.windows(x, y, bounds)
    got = net.log_prob(wx, hidden, wy)
    assert (wy >= 0).sum() == bounds[-1]
    for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
        want = slow_log_prob(w, x[a:b], y[a:b])
        mine = got[stream == i].ravel()[wy[stream == i].ravel() >= 0]
        assert np.allclose(mine, want, atol=1e-5)


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(1)
    w = tiny(seed=3)
    x, y = rng.integers(0, 7, 40), rng.integers(0, 40, 40)
    x, hidden, y, _ = lm.windows(x, y, np.array([0, 19, 40]))

    def loss():
        net = lm.Network(w)
        return -net.log_prob(x, hidden, y).sum() / (y >= 0).sum()
    found = lm.Network(w).gradients(x, hidden, y)
    for name, g in found.items():
        flat = w[name].reshape(-1)
        for i in rng.choice(flat.size, min(6, flat.size), replace=False):
            keep, step = flat[i], 1e-5
            flat[i] = keep + step
            up = loss()
            flat[i] = keep - step
            down = loss()
            flat[i] = keep
            assert abs((up - down) / (2 * step) - g.reshape(-1)[i]) < 1e-5, name


def test_probabilities_of_all_ids_sum_to_one():
    rng = np.random.default_rng(0)
    counts = np.append(rng.poisson(3, 3000), 50).astype(float)
    c = lm.classes(counts, rng.random(3000) < 0.5)
    assert np.allclose(np.bincount(c.outputs, np.exp(c.within), len(c.prior)), 1)
    assert np.isclose(np.exp(c.prior).sum(), 1)
    empty = lm.classes(np.zeros(3001), rng.random(3000) < 0.5)
    assert np.allclose(np.bincount(empty.outputs, np.exp(empty.within), len(empty.prior)), 1)


def test_ids_give_back_the_words():
    encode = lm.Subwords(PATH)
    text = "don't the \x1c é x 日本 a<|endoftext|>b İ the 12345,.;"
    codes, words, offsets = lm.lower_words(pa.array([text, "", "the"]))
    ids, bounds = encode.streams(codes, words, offsets)
    for i, t in enumerate([text, "", "the"]):
        stream = ids[bounds[i]:bounds[i + 1]]
        assert stream[-1] == encode.end and (stream[:-1] != encode.end).all()
        assert b"".join(encode.bytes[k] for k in stream[:-1]).decode() == \
            "".join(" " + w for w in words_of(t))


def run(df, frequent=lm.FREQUENT):
    learn = ~F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    model = lm.train(df, PATH, learn)
    return model, lm.score(df, model, frequent=frequent).collect()


@pytest.mark.parametrize("frequent", [3, 200_000])
def test_odd_rows_and_joined_words(spark, frequent):
    rows = [(i, f"Alpha beta w{i % 9} w{i}  gamma\tA\nb" if i % 5 else "") for i in range(60)]
    rows += [(None, "null id Alpha"), (7, None), (7, None), (9, "dup"), (9, "dup"),
             (70, "long " * 30_000 + "z" * 9000), (71, "\u0085 é İ \0 日本")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows],
                               "doc_id long, text string, row string, word int")
    model, got = run(df, frequent)
    want = sorted(((d, k, n, round(b, 6)) for d, _, k, n, _, b in base(rows)), key=str)
    assert sorted(((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got),
                  key=str) == want
    assert model.train_tokens == base(rows)[0][4]
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    same = [r.score for r in got if r.doc_id == 9]
    assert abs(same[0] - same[1]) < 1e-9


def test_empty_table_and_no_training_rows(spark):
    schema = "doc_id long, text string"
    assert run(spark.createDataFrame([], schema))[1] == []
    alone = next(i for i in range(100) if held(i))
    _, got = run(spark.createDataFrame([(alone, "one two")], schema))
    assert got[0].base_score == 0 and got[0].n_known == 0 and got[0].score < 0


def test_network_learns_from_every_position(spark):
    """Every subword of every text, and each end, is a target once a pass."""
    texts = ["a b " * 3000 + "zebra", "", None, "one two three", "x" * 5000]
    encode = lm.subwords(PATH)
    ids, bounds = encode.streams(*lm.lower_words(pa.array([t or "" for t in texts])))
    c = lm.classes(np.bincount(ids, minlength=encode.end + 1).astype(float), encode.starts)
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    found = np.concatenate([y[y >= 0] for _, _, y in
                            lm._training_windows(iter([batch]), PATH, c)])
    assert sorted(found) == sorted(c.outputs[ids]) and len(found) == bounds[-1] > 6000


def test_words_beyond_the_first_are_learned(spark):
    """The order of words in the middle of long texts is learned, in one pass of
    several rounds as in several passes."""
    def text(i, first, then):
        return " ".join(["start"] * 40 + [f"{first} {then}" if (k * 7 + i) % 3 else "gap"
                                          for k in range(300)])
    df = spark.createDataFrame([(i, text(i, "alpha", "beta")) for i in range(60)],
                               "doc_id long, text string").repartition(2)
    ask = spark.createDataFrame([(1, text(1, "alpha", "beta")), (2, text(1, "beta", "alpha"))],
                                "doc_id long, text string")
    for passes in ((1, 1), (4, 4)):
        model = lm.train(df, PATH, F.lit(True), passes=passes)
        got = {r.doc_id: r.score for r in lm.score(ask, model).collect()}
        assert got[1] > got[2] + 10, passes


def test_query(run_query, documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in run_query("op12_lm_scores")}
    for doc, out, n, known, total, b in base(rows):
        r = got[doc]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out, n, known, total)
        assert math.isclose(r.base_score, b, rel_tol=1e-9)


def test_training_pays_on_unseen_texts(spark, documents):
    """Held-out texts are likelier than under the subwords' corpus frequencies
    alone, which the network starts from."""
    out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    model = lm.train(documents, PATH, ~out)
    unseen = documents.filter(out)
    trained = lm.score(unseen, model).agg(F.sum("score")).first()[0]
    model.weights = lm.start_weights(model.classes)
    untrained = lm.score(unseen, model).agg(F.sum("score")).first()[0]
    assert trained > 0.9 * untrained          # at least a tenth fewer digits


def test_tasks_hold_few_words_and_little_text(monkeypatch):
    """A text step is at most ``PIECE`` bytes (one text at least), and at most
    ``CACHE`` words stay encoded before the next step."""
    sizes, own = [], lm.lower_words

    def noted(texts):
        sizes.append(sum(len(t.encode()) for t in texts.to_pylist()))
        return own(texts)
    monkeypatch.setattr(lm, "lower_words", noted)
    monkeypatch.setattr(lm, "CACHE", 50)
    texts = [" ".join(f"w{i}x{k}" for k in range(40)) + " long" * 20_000 for i in range(30)]
    encode = lm.subwords(PATH)
    ids, bounds = encode.streams(*own(pa.array(texts)))
    c = lm.classes(np.bincount(ids, minlength=encode.end + 1).astype(float), encode.starts)
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    n = sum(int((y >= 0).sum()) for _, _, y in lm._training_windows(iter([batch]), PATH, c))
    assert n == bounds[-1] and max(sizes) <= lm.PIECE and len(sizes) > 2
    encode(["one"])
    assert len(encode.slots) == 1


def test_windows_in_runs_share_their_keys():
    """Runs of windows, whatever their length, give each target the same probability
    and the weights the same gradients as windows on their own."""
    rng = np.random.default_rng(2)
    bounds = np.cumsum([0, 1, 15, 16, 0, 17, 300, 33])
    x, y = rng.integers(0, 7, bounds[-1]), rng.integers(0, N_CLASSES, bounds[-1])
    net, want = lm.Network(tiny(seed=5)), None
    for run in (1, 3, lm.RUN, 40):
        wx, first, wy, stream = lm.windows(x, y, bounds, run)
        assert wx.shape == (len(wy), (run + 1) * lm.BLOCK)
        each = net.log_prob(wx, first, wy).reshape(-1, lm.BLOCK)[:len(stream)]
        found = each, net.gradients(wx, first, wy)
        want = want or found
        assert np.allclose(found[0], want[0], atol=1e-9)
        assert all(np.allclose(g, want[1][name], atol=1e-9) for name, g in found[1].items())


def test_learning_and_scoring_need_no_text(spark):
    """Texts are encoded once; both steps read the ids alone, and the words in them."""
    rows = [(i, f"Alpha beta w{i % 9} w{i} é 日本 \x1c" if i % 5 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    texts = lm.encoded(df, PATH, ~out)
    assert texts.columns == ["id", "row", "learn", "part", "ids"]
    model = lm.learn(texts, PATH)
    got = {r.id: r for r in lm.likelihoods(texts, model, frequent=4).collect()}
    for doc, _, n, known, total, b in base(rows):
        r = got[doc]
        assert (r.n_tokens, r.n_known, model.train_tokens) == (n, known, total)
        assert math.isclose(r.base_score, b, rel_tol=1e-9)


def test_ids_as_bytes_give_back_streams_and_words():
    encode = lm.Subwords(PATH)
    texts = ["the \x1c é x 日本 a İ the", "", "one", "the the"]
    codes, words, offsets = lm.lower_words(pa.array(texts))
    ids, bounds = encode.streams(codes, words, offsets)
    values = lm._bytes(ids.astype(encode.kind), bounds)
    for first in (0, 1, 3, 4):
        found, at = lm._ids(values.slice(first), encode.kind)
        assert (found == ids[bounds[first]:]).all() and (at == bounds[first:] - bounds[first]).all()
    kept, distinct, at = lm._words(encode, *lm._ids(values, encode.kind))
    assert list(np.diff(at)) == [len(words_of(t)) + 1 for t in texts]
    flat = [w for t in texts for w in [*words_of(t), None]]
    assert len(distinct) == len(set(flat)) == len(set(zip(kept, flat)))


def test_every_corpus_is_passed_twice_at_least():
    """Whatever its size, each eighth of the training documents is learned from twice."""
    for targets in (1, 10 ** 6, lm.TARGETS - 1, lm.TARGETS, 10 ** 9, 10 ** 12):
        rounds, *_ = lm.rounds_of(targets, lm.PASSES)
        for eighth in range(lm.ROUNDS[-1]):
            assert sum(first <= eighth < end for first, end in rounds) >= 2, targets
    assert len(lm.rounds_of(1, lm.PASSES)[0]) == lm.PASSES[1]
