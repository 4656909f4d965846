"""Templates: verbatim, re-parameterised and merely similar texts."""

import pytest

from rankforge.llm import decontaminate as d

ITEM = ("A train leaves the station at 90 km and meets Alice after 3 hours on the road. "
        "Then Alice walks back with Bob to the old town and buys 12 apples for 5 dollars there.")
OTHER = ("A train leaves the station at 75 km and meets Carol after 8 hours on the road. "
         "Then Carol walks back with Dave to the old town and buys 40 apples for 9 dollars there.")
MIXED = ("A train leaves the station at 75 km and meets Carol after 8 hours on the road. "
         "Then Eve walks back with Dave to the old town and buys 40 apples for 9 dollars there.")
FILL = "Some ordinary words come first and more of them follow later on without any number. "


@pytest.fixture(scope="module")
def bench(spark):
    rows = [(1, ITEM), (2, None), (3, ""), (4, "what is it"), (5, "one"),
            (6, "unrelated question about the deep sea and the fish that live down in it forever")]
    return spark.createDataFrame(rows, "item_id long, text string")


def found(df):
    return {(r.doc_id, r.item_id, r.same) for r in df.collect()}


def test_matches(make_docs, bench):
    words = ITEM.split()
    docs = make_docs([FILL + ITEM + " " + FILL, FILL + OTHER, MIXED, None, "", FILL,
                      " ".join(words[:12]), " ".join(words[:14] + ["suddenly"] + words[14:]),
                      ITEM.upper(), "so what is it then", FILL * 300 + ITEM + FILL * 300, "one"])
    assert found(d.contaminated(docs, bench)) == {
        (0, 1, True), (1, 1, False), (7, 1, True), (9, 4, True), (10, 1, True)} | (
        found(d.contaminated(docs.filter("doc_id = 8"), bench)))
    kept = d.without_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert {2, 3, 4, 5, 6, 11} <= {r.doc_id for r in kept.collect()}


def test_long_words_take_linear_time(make_docs, bench):
    marks = "=" * 200_000 + "x"
    assert d._core(marks) == "x" and d._core("_" * 9) == "" and d._core("(a-b).") == "a-b"
    assert found(d.contaminated(make_docs([f"{marks} {ITEM} {marks[::-1]}"]), bench)) == {(0, 1, True)}


def test_inconsistent_fillers_are_no_match(make_docs, bench):
    """Alice must become the same name in both sentences."""
    assert not [r for r in d.contaminated(make_docs([MIXED]), bench).collect() if r.similarity == 1.0]


def test_edges(spark, make_docs, bench):
    docs = make_docs([(7, ITEM), (7, ITEM), (None, OTHER), (9, FILL)]) \
        .withColumnRenamed("lang", "h").withColumnRenamed("source", "bad")
    assert found(d.contaminated(docs, bench)) == {(7, 1, True), (None, 1, False)}
    assert {r.doc_id for r in d.without_contaminated(docs, bench).collect()} == {9}
    assert d.contaminated(docs.limit(0), bench).count() == 0
    assert d.contaminated(docs, bench.limit(0)).count() == 0
    assert d.without_contaminated(docs, bench.limit(0)).count() == 4


def test_query_finds_all_verbatim_items(spark, run_query, texts, sf_small):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()}
    held = {(doc, i) for doc, t in texts.items() for i, b in items.items() if b in t}
    rows = {(r.doc_id, r.item_id) for r in run_query("op2_decontamination")}
    assert held <= rows and held
    for doc, i in rows - held:                 # the rest shares most of the item's words
        words = set(texts[doc].lower().split())
        own = items[i].lower().split()
        assert sum(w in words for w in own) >= 0.7 * len(own)


def test_verbatim_items_with_few_plain_words(spark, make_docs):
    items = ["What is 25 * 17 + 36 / 4 - 12?", "Compute 12 + 45 * 78", "10 20 30 40 50 60",
             "Why did Alice Bob Carol Dave Eve leave?"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = make_docs([f"{FILL}{i} {FILL}" for i in items] + ["Compute 13 + 45 * 78", "10 20 30 40 51 60"])
    assert found(d.contaminated(docs, bench)) == {(i, i, True) for i in range(4)}


def test_case_and_the_words_before_do_not_matter(spark, make_docs):
    items = [ITEM, "What is 3 times 4?", "What does Alice owe Bob?", "Pay the street tax (straße) now"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    forms = [ITEM.upper(), ITEM.lower(), ITEM.title(), "Part 2, " + ITEM, OTHER.upper().replace(
        "CAROL", "ALICE").replace("DAVE", "BOB"), "1) What is 3 times 4?", "- Heading\nWhat is 5 times 6?",
        "so WHAT DOES ALICE OWE BOB", "1) What does Carol owe Dave?", items[3].upper()]
    assert found(d.contaminated(make_docs(forms), bench)) == {
        (0, 0, True), (1, 0, True), (2, 0, True), (3, 0, True), (4, 0, False), (5, 1, True),
        (6, 1, False), (7, 2, True), (8, 2, False), (9, 3, True)}


def test_one_altered_filler_of_several(spark, make_docs):
    one, two, three = ("some plain words that a long question has in it", "and others which follow "
                       "after those so that it gets longer still", "until nobody wants to read on")
    long = f"Now take 7 of them {one} then take 7 again {two} and say so"
    bench = spark.createDataFrame([(0, long), (1, ITEM)], "item_id long, text string")
    docs = make_docs([long.replace("7 again", "8 again"), long.replace("Now take 7", "Now take 8"),
                      ITEM.replace("Then Alice", "Then Alicia"), MIXED])
    rows = {(r.doc_id, r.item_id): (r.similarity, r.same) for r in d.contaminated(docs, bench).collect()}
    n = len(long.split())
    assert rows == {(0, 0): ((n - 1) / n, False), (1, 0): ((n - 3) / n, False), (2, 1): (34 / 35, False)}
    # Other values throughout, one of four contradicting.
    four = f"Take 7 of them {one} take 7 away {two} take 7 again {three} or 7"
    bench = spark.createDataFrame([(0, four)], "item_id long, text string")
    docs = make_docs([four.replace("7", "9").replace("9 again", "5 again")])
    assert found(d.contaminated(docs, bench)) == {(0, 0, False)}
