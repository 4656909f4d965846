"""HTML layout, and the whole pipeline against its parts."""

import re
from html import unescape

import pytest

from rankforge.llm import decontaminate, html, secrets, simhash

CASES = [
    ("<p>One<p>Two <b>bold</b>\n  text</p>tail", "One\n\nTwo bold text\n\ntail"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
    ("<ol start=3><li>x<li><p>y</p></ol>", "3. x\n4. y"),
    ("<table><tr><th>Name<th>N<tr><td>long name<td>1</table>", "Name      | N\nlong name | 1"),
    ("<table><tr><td>a<br>b<td>c<tr><td colspan=2>wide</table>", "a | c\nb |\nwide"),
    ("<head><title>t</title><style>x</style><body>seen<script>if (a<b) 1;</script>", "seen"),
    ("a<div hidden>no<p>no</div><div style='display: none'>no</div><span style=visibility:hidden>no</span>b", "ab"),
    ("<!-- no > -->x<!doctype html>y &amp; &lt;z&gt; &copy;", "xy & <z> ©"),
    ("<pre>  keep\n   this</pre>", "  keep\n   this"),
    ("1 < 2 and <3 <a href='x>y'>link</a>", "1 < 2 and <3 link"),
    ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"),
    ("<blockquote>q<p>r</blockquote>z", "> q\n>\n> r\n\nz"),
    ("x<br>y<hr>z", "x\ny\n\n---\n\nz"),
    ("<table>out<tr><td><table><tr><td>in</table></table>", "out\nin"),
    ("<img alt='a cat'><input value=Go type=submit>", "a catGo"),
    ("<b>mis<i>nested</b> tags</i>", "misnested tags"), ("", ""), ("   ", ""), ("<", "<"),
    ("<p", "<p"), ("</p></x>a", "a"), ("<script>never closed", ""), ("<!-- open", ""),
]


@pytest.mark.parametrize("source, text", CASES)
def test_render(source, text):
    assert html.render(source) == text


def test_deep_and_broken_inputs_end():
    for s in ("<div>" * 20_000 + "x", "<blockquote>" * 3000 + "x", "<ul><li>" * 2000 + "x",
              "<a b='" * 20_000, "<" * 50_000, "<p>" * 20_000, "<table><tr><td>" * 500 + "x"):
        html.render(s)
    assert "x" in html.render("<ul><li>" * 2000 + "x")


def test_all_visible_words_of_the_pages(spark, run_query, sf_small):
    rows = {r.page_id: r for r in run_query("op1_html_extraction")}
    pages = spark.read.parquet(f"{sf_small}/pages.parquet").collect()
    assert len(rows) == len(pages)
    for p in pages:
        body = re.sub(r"(?s)<head>.*?</head>|<script.*?</script>|<!--.*?-->", " ", p.html)
        want = unescape(re.sub(r"<[^>]*>", " ", body)).split()
        got = [w for w in rows[p.page_id].text.split() if w not in ("-", "|")]
        assert [w for w in want if w not in ("-", "|")] == got
        assert rows[p.page_id].n_chars == len(rows[p.page_id].text)


def test_extract_keeps_rows(spark):
    pages = spark.createDataFrame([(1, None, "old"), (1, "<p>x", "old"), (None, "", "old")],
                                  "page_id long, html string, text string")
    out = html.extract(pages)
    assert out.columns == ["page_id", "text"]
    assert sorted(((r.page_id, r.text) for r in out.collect()), key=str) == sorted(
        [(1, None), (1, "x"), (None, "")], key=str)
    assert html.extract(pages.limit(0)).count() == 0


def test_pipeline(spark, sf_small, documents, texts):
    import corpus_pipeline as cp
    from rankforge.llm.common import settle
    from rankforge.llm.queries import op9_toxicity
    docs, kept = documents, []
    for name, stage in cp.STAGES:
        docs = settle(stage(spark, docs, sf_small), "test-" + name)
        if name != "packing":
            assert docs.columns == documents.columns
            kept.append({r.doc_id: r.text for r in docs.select("doc_id", "text").collect()})
    toxic = {r.doc_id for r in op9_toxicity(spark, sf_small).collect() if r.predicted}
    assert set(kept[0]) == set(texts) - toxic
    seen, roots = {d: simhash.fingerprint(t) for d, t in kept[0].items()}, []
    for d in sorted(kept[1]):
        assert all((seen[d] ^ seen[o]).bit_count() > 2 for o in roots)
        roots.append(d)
    assert all(any((seen[d] ^ seen[o]).bit_count() <= 2 for o in seen if o < d)
               for d in set(kept[0]) - set(kept[1]))
    bench = spark.read.parquet(f"{sf_small}/benchmark.parquet")
    bad = {r.doc_id for r in decontaminate.contaminated(
        documents.filter(documents.doc_id.isin(list(kept[1]))), bench).collect()}
    assert set(kept[2]) == set(kept[1]) - bad and bad
    assert set(kept[3]) == set(kept[2])
    changed = {d for d in kept[3] if kept[3][d] != kept[2][d]}
    assert changed == {d for d, t in kept[2].items() if secrets.scan_text(t)}
    assert not any(secrets.scan_text(t) for t in kept[3].values())
    assert {r.doc_id for r in docs.collect()} == set(kept[3])


def test_pipeline_of_odd_documents(spark, make_docs, sf_small):
    import corpus_pipeline as cp
    docs = make_docs([(1, None), (2, ""), (None, "token: abcdef123456"), (5, "word " * 30_000),
                      (5, "word " * 30_000)])
    for rows in (docs, docs.limit(0)):
        for name, stage in cp.STAGES:
            rows = stage(spark, rows, sf_small)
        rows.collect()
