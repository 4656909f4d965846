"""Secrets and personal data against plain regular expressions."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rankforge.llm import pii, secrets

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.I | re.A)


def n_digits(s):
    return sum("0" <= c <= "9" for c in s)


def slow_luhn(s):
    digits = [int(c) for c in s if "0" <= c <= "9"][::-1]
    return (sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10 == 0


def slow_pii(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text)
            if 14 <= n_digits(m[0]) <= 19 and slow_luhn(m[0])]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= n_digits(m[0]) <= 15]


def slow_secrets(text):
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return out + [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]


def joined(spans, kinds):
    spans = sorted(spans, key=lambda s: (s[1], kinds.index(s[0])))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


@given(st.text(alphabet="ab.@-%+ 019()é", max_size=50))
@settings(max_examples=400, deadline=None)
def test_strict_pii_on_random_texts(text):
    assert sorted(pii.strict(text)[0]) == sorted(slow_pii(text))


@given(st.lists(st.sampled_from(["4242 4242 4242 4242", "4242424242424241", "10.0.0.255", "1.2.3.4.5",
                                 "01.002.3.4", "256.1.1.1", "+1 (555) 010-2030", "+12", "a@b.c", "@",
                                 "x.y@z-.q.w@e.f", " ", "7", "."]), max_size=9))
@settings(max_examples=300, deadline=None)
def test_strict_pii_on_formats(parts):
    text = "".join(parts)
    assert sorted(pii.strict(text)[0]) == sorted(slow_pii(text))


@given(st.lists(st.sampled_from(["password", "PassWd", "api_key", "APIKEY", "token", "secret", ":", "=",
                                 " ", '"', "'", "abc123", "x", "AKIA", "ABCDEFGH01234567", "deadbeef",
                                 "0123456789abcdef01234567", "ſecret", "\n"]), max_size=9))
@settings(max_examples=400, deadline=None)
def test_scan_text(parts):
    text = "".join(parts)
    assert sorted(f for f in secrets.scan_text(text) if f[0] in secrets.KINDS[:3]) == \
        sorted(slow_secrets(text))


@pytest.mark.parametrize("name, slow, kinds", [
    ("op3_pii", slow_pii, pii.BASE_KINDS), ("op4_secret_scan", slow_secrets, secrets.KINDS[:3])])
def test_queries(run_query, texts, name, slow, kinds):
    rows = run_query(name)
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        want = slow(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(joined(want, kinds).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in kinds] == [sum(s[0] == k for s in want) for k in kinds]
        assert {f"{k}:{a}:{b}" for k, a, b in want} <= set(r.spans.split(",")) | {""}


def test_quadratic_inputs_end():
    for text in ("a" * 300_000, "a@" * 100_000, "1" * 300_000, "1." * 100_000, "+1" * 100_000):
        pii.strict(text)
        secrets.scan_text(text)


def test_trees_learn_a_rule_and_thresholds_keep_precision():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 6))
    x[:, 0] = 0
    y = ((x[:, 1] > 0.3) & (x[:, 2] < 0.5)).astype(float)
    model = pii.fit(x[:3000], y[:3000])
    assert ((model.predict(x[3000:]) > 0.5) == y[3000:]).mean() > 0.97
    model.thresholds = pii.calibrate(model, x[:3000], y[:3000])
    chosen = model.predict(x) >= model.thresholds[0]
    assert chosen.sum() > 300 and y[chosen].mean() > 0.97
    assert model.thresholds[1:] == (2.0, 2.0, 2.0)
    assert pii.fit(np.zeros((0, 6)), np.zeros(0)).predict(np.zeros((1, 6)))[0] == 0.5


def test_model_adds_spans_and_redacts(make_docs):
    docs = make_docs(["mail a@b.org or 10.1.2.3", None, "", "card 4242-4242-4242-4241"])
    keen = pii.Boosted(start=5.0, thresholds=(0.5,) * 4)
    rows = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans]
            for r in pii.find(docs, keen).collect()}
    assert rows == {0: [("email", 5, 12), ("ip", 16, 24)], 1: [], 2: [], 3: [("card_like", 5, 24)]}
    out = pii.redact(docs.withColumnRenamed("lang", "spans"), keen)
    assert out.columns == ["doc_id", "text", "spans", "source", "n_chars"]
    assert {r.doc_id: r.text for r in out.collect()} == {
        0: "mail [EMAIL] or [IP]", 1: None, 2: "", 3: "card [CARD_LIKE]"}


def test_training_without_candidates(make_docs):
    model = pii.train(make_docs(["plain words", None, ""]))
    assert model.thresholds == (2.0,) * 4
    assert pii.find(make_docs([]), model).count() == 0


def test_ledger_is_incremental(spark, make_docs, tmp_path):
    ledger = f"file://{tmp_path}/ledger"
    key = "token = abcdef123456"
    first = make_docs([(1, key), (2, key), (3, None), (4, "")])
    out = {r.doc_id: len(r.findings) for r in secrets.scan_versions(first, ledger).collect()}
    assert out == {1: 1, 2: 1, 3: 0, 4: 0}
    assert spark.read.option("recursiveFileLookup", "true").parquet(ledger).count() == 2
    second = first.union(make_docs([(5, "AKIA" + "Z" * 16), (6, key)]))
    out = {r.doc_id: len(r.findings) for r in secrets.scan_versions(second, ledger).collect()}
    assert out == {1: 1, 2: 1, 3: 0, 4: 0, 5: 1, 6: 1}
    assert spark.read.option("recursiveFileLookup", "true").parquet(ledger).count() == 3
    assert secrets.scan_versions(first, ledger, rule_version=2).count() == 4      # other rules, all anew
    assert spark.read.option("recursiveFileLookup", "true").parquet(ledger).count() == 5


def test_scan_keeps_rows_and_clashing_columns(make_docs):
    docs = make_docs([(1, "x"), (1, "x"), (None, None)]).withColumnRenamed("lang", "findings") \
        .withColumnRenamed("source", "_blob")
    out = secrets.scan_versions(docs)
    assert out.count() == 3 and out.columns == ["doc_id", "_blob", "n_chars", "blob", "findings"]
    assert secrets.scan_versions(docs.limit(0)).count() == 0


def test_redact(make_docs):
    docs = make_docs(["a token=abcdef123456 b", None, "", "secret: " + "0a" * 20, "clean"]) \
        .withColumnRenamed("lang", "blob")
    out = secrets.redact(docs)
    assert out.columns == docs.columns and out.schema == docs.schema
    assert {r.doc_id: (r.text, r.n_chars) for r in out.collect()} == {
        0: ("a [SECRET] b", 12), 1: (None, 0), 2: ("", 0), 3: ("[SECRET]", 8), 4: ("clean", 5)}
    assert secrets.redact(docs.filter(F.lit(False))).count() == 0


def test_tokens_in_long_runs():
    jwt = "eyJ" + "a" * 12 + ".eyJ" + "b" * 12 + "." + "c" * 12
    assert ("jwt", 6, 6 + len(jwt)) in secrets.scan_text("token=" + jwt)
    assert not [f for f in secrets.scan_text("eyJ" * 200_000 + " .eyJ") if f[0] == "jwt"]


def test_private_keys_go_with_their_bodies(make_docs):
    body = "MIIEpAIBAAKCAQEA7b+/Zq\nQx9LkTn0aBcDeFgHiJ==\n"
    fields = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0A1B2C\n\n"
    head, tail = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    whole = f"{head}\n{body}{tail}"
    texts = [f"a {whole} b", f"a {head}\n{fields}{body}{tail} b", f"a {head}\n{body}", f"a {head}\n{fields}{body}. b",
             f"a {whole}\n{whole} b", f"a {head}\n{body}{whole} b", "a " + whole.replace("\n", "\\n") + " b",
             "a " + whole.replace("\n", "\n> ") + " b", f"a {tail} b"]
    out = {r.doc_id: r.text for r in secrets.redact(make_docs(texts)).collect()}
    assert out == {0: "a [SECRET] b", 1: "a [SECRET] b", 2: "a [SECRET]\n", 3: "a [SECRET]\n. b",
                   4: "a [SECRET]\n[SECRET] b", 5: "a [SECRET]\n[SECRET] b", 6: "a [SECRET] b",
                   7: "a [SECRET] b", 8: f"a {tail} b"}
    secrets.scan_text((head + "\nDEK-Info: x") * 20_000 + " " * 300_000)
