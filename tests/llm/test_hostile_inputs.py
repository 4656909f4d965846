"""Small or odd inputs must neither hang an operator nor blow its output up."""
import time

import pytest
from pyspark.sql import functions as F

from rankforge.llm import html, pii, urls


def timed(fn, seconds=10):
    start = time.perf_counter()
    out = fn()
    assert time.perf_counter() - start < seconds
    return out


@pytest.mark.parametrize("source,most", [
    ("<a " * 350_000, 3), ('<a ">"' * 170_000, 3), ('<a "' * 250_000 + ">", 3), ("<" * 10 ** 6, 3),
    ("<div>" * 200_000 + "<li>x" * 20_000, 3), ("<ul><li>x" * 60_000, 8),
    ("<blockquote>y" * 60_000, 8), ("<table><tr><td>" * 40_000, 3),
    ("<table>" + "<tr><td>" + "w" * 100_000 + "</td></tr>" + "<tr><td>a<td>b</tr>" * 10_000, 3),
    ("<table>" + "<tr><td colspan=1000 rowspan=0>q" * 30_000, 3),
    ("<table><tr>" + "<td>c" * 3000 + "<tr><td colspan=1000>a<td>b" * 3000, 20),
    ("<table>" + "<tr>" * 300_000, 3)])
def test_html_stays_linear(source, most):
    out = timed(lambda: html.render(source))
    assert len(out) <= most * len(source) + 100


def test_html_keeps_all_words_of_sparse_tables():
    words = [f"w{i}" for i in range(500)]
    page = "<table>" + "".join(f"<tr><td>{w}<td rowspan=9 colspan=900>{w}x" for w in words)
    got = html.render(page).replace("|", " ").split()
    assert sorted(got) == sorted(words + [w + "x" for w in words])


def test_html_unclosed_quote_ends_the_tag():
    assert html.render('<div title="abc>text</div><p>more') == "text\n\nmore"
    assert html.render("<p title='a>b'>c") == "c"


def test_html_deep_items_keep_their_marks():
    out = html.render("<ul><li>a" * 30)
    assert [line.strip() for line in out.split("\n")] == ["- a"] * 30


def test_urls_with_very_many_labels(spark):
    host = "a." * 500_000 + "example.com"
    pages = spark.createDataFrame([(1, f"http://{host}/en/x"), (2, "http://b.example.com/en/"),
                                   (3, "http://com/"), (4, None)], "page_id long, url string")
    rules = spark.createDataFrame([("example.com", "/en/", "block"), ("com", "/", "allow")],
                                  "host string, path string, verdict string")
    got = timed(lambda: {r.page_id: (r.rule, r.verdict) for r in urls.judge(pages, rules).select(
        "page_id", "rule", "verdict").collect()}, 20)
    assert got == {1: ("example.com/en/", "block"), 2: ("example.com/en/", "block"),
                   3: ("com/", "allow"), 4: (None, "allow")}


def test_pii_selection_takes_what_overlaps_nothing():
    import random
    rng = random.Random(2)
    for _ in range(300):
        base = [(s, s + rng.randrange(1, 9)) for s in rng.choices(range(80), k=5)]
        taken, kept = pii._union(base), []
        for s, e in [(s, s + rng.randrange(1, 9)) for s in rng.choices(range(80), k=20)]:
            want = not any(s < b and a < e for a, b in base + kept)
            assert pii._take(taken, s, e) == want
            if want:
                kept.append((s, e))
    taken = []
    assert timed(lambda: sum(pii._take(taken, s, s + 2) for s in range(0, 300_000, 3))) == 100_000


def test_pii_megabyte_of_numbers(spark):
    docs = spark.createDataFrame([(i, f"call +49 30 {1000000 + i * 7919 % 8999999} now") for i in
                                  range(300)] + [(999, "555-123-4567 " * 80_000)],
                                 "doc_id long, text string")
    model = pii.train(docs.filter(F.col("doc_id") < 999))
    timed(lambda: pii.find(docs, model).select(F.size("spans")).collect(), 60)
