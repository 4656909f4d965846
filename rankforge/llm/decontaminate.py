"""Benchmark decontamination by template canonicalisation.

Words become template tokens: numbers, units after numbers and names inside a
sentence turn into typed placeholders, all else is the case-folded word without
outer punctuation.  Windows of five tokens are hash-joined with the
benchmark's with the words as they are, with numbers and units as placeholders,
and with names too.  The first two do not depend on case or on the words before,
so copies in capitals, title case or after a heading lose nothing.  A document matches an item if windows along consistent diagonals (same shift,
every filler of the item replaced by one and the same filler) cover at least
0.8 of the item's tokens; of a diagonal that is not, a consistent part counts.  So an item is found as it stands, whatever its words,
and with other numbers, names or units where windows have plain words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankforge.llm.common import settle, steps, word_codes

WINDOW = 5
SIMILARITY = 0.8
#: A window with placeholders and fewer plain words is no evidence.
MIN_PLAIN = 2
#: Bits of the prefilter, 2 MB whatever the benchmark's size.
FILTER_BITS = 24

# Units that become a placeholder after a number.
UNITS = frozenset("""mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters
metre metres kilometer kilometers g mg kg t lb lbs oz gram grams kilogram kilograms pound pounds ton
tons ml cl l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr
hour hours day days week weeks month months year years dollar dollars euro euros cent cents usd eur
percent degrees degree kmh mph hz khz mhz w kw v volt volts watt watts joule joules""".split())

PLAIN, NUMBER, UNIT, NAME, MEASURE = range(5)
_NUMBER = re.compile(r"[+-]?[0-9][0-9.,/:]*%?")
_MEASURE = re.compile(r"([+-]?[0-9][0-9.,]*)([A-Za-z]+)")
_SOLID = re.compile(r"[^\W_]")
_CACHE: dict[str, tuple] = {}
_CACHE_WORDS = 300_000
_SLOT = np.array([xxhash.xxh64_intdigest(b"slot %d" % k) for k in range(5)], np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _core(word: str) -> str:
    """The word without outer punctuation, in linear time however long it is."""
    first = _SOLID.search(word)
    return word[first.start():len(word) - _SOLID.search(word[::-1]).start()] if first else ""


def _fold(core: str) -> str:
    """The same for a word and its copy in capitals (``ß`` and ``SS``)."""
    return core.upper().casefold()


def _word(word: str) -> tuple[int, int, bool, bool, bool, bool]:
    """(hash of the plain form, kind by its form, has a core, may be a name, is a unit, ends a sentence)."""
    core = _core(word)
    low = core.lower()
    h = xxhash.xxh64_intdigest(_fold(core).encode("utf-8", "surrogatepass"))
    measure = _MEASURE.fullmatch(core)
    kind = NUMBER if _NUMBER.fullmatch(core) else \
        MEASURE if measure and measure[2].lower() in UNITS else PLAIN
    return (h, kind, bool(core), core[:1].isupper() and core[1:2].islower(), low in UNITS,
            word.rstrip("\"')]").endswith((".", "!", "?", ":")))


def canonical(texts: pa.Array):
    """Template tokens of a slice of texts.

    Returns (forms, kind, code of the word, distinct words, offsets), a form
    being (token hash, is a placeholder): the words as they are, the template
    without and with names.  Words without a letter or digit are no tokens.
    """
    codes, words, offsets = word_codes(texts)
    if len(_CACHE) > _CACHE_WORDS:
        _CACHE.clear()
    rows = []
    for w in words:
        got = _CACHE.get(w)
        if got is None:
            got = _CACHE[w] = _word(w)
        rows.append(got)
    plain, kinds, solid, names, units, ends = (np.array(x, dt) for x, dt in zip(
        zip(*rows) if rows else [()] * 6, (np.uint64, np.int8, bool, bool, bool, bool)))
    first = np.zeros(len(codes) + 1, bool)
    first[offsets] = True                                    # starts of texts
    opens = first[:-1] | np.concatenate(([True], ends[codes][:-1]))[:len(codes)]
    keep = solid[codes]
    at = np.concatenate(([0], np.cumsum(keep)))[offsets]
    codes, opens = codes[keep], opens[keep]
    kind = kinds[codes]
    number = np.concatenate(([False], kind[:-1] == NUMBER))[:len(kind)]
    number[at[:-1][at[:-1] < len(kind)]] = False
    kind = np.where((kind == PLAIN) & units[codes] & number, UNIT, kind)
    literal, filled = plain[codes], kind != PLAIN
    forms = [(literal, np.zeros(len(codes), bool)), (np.where(filled, _SLOT[kind], literal), filled)]
    kind = np.where((kind == PLAIN) & names[codes] & ~opens, NAME, kind)
    forms.append((np.where(kind == PLAIN, literal, _SLOT[kind]), kind != PLAIN))
    return forms, kind, codes, words, at


def window_hashes(forms: list[tuple[np.ndarray, np.ndarray]], at: np.ndarray, window: int):
    """(text, first token, hash) of every window: of its words, and of each form
    that has more placeholders than the one before and enough plain words.

    The form with names is also taken without one for the window's first token:
    an item's first word is at a text start, its copy's may follow other words.
    """
    n = len(forms[0][0]) - window + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    inside = text[:n] == text[window - 1:]
    literal, caseless, named = forms
    out, least = [], np.full(n, -1, np.int8)
    for head, rest in ((literal, literal), (caseless, caseless), (named, named), (caseless, named)):
        h, gaps = np.zeros(n, np.uint64), np.zeros(n, np.int8)
        for i in range(window):
            tokens, filled = rest if i else head
            h = (h ^ tokens[i:n + i]) * _BASE
            h ^= h >> np.uint64(29)
            gaps += filled[i:n + i]
        ok = inside & (gaps > least) & ((gaps == 0) | (window - gaps >= min(MIN_PLAIN, window)))
        if rest is named:
            ok &= (head is named) | (named[1] & ~caseless[1])[:n]
        else:
            least = gaps
        pos = np.flatnonzero(ok)
        out.append((text[pos], pos - at[text[pos]], h[pos]))
    return tuple(np.concatenate(x) for x in zip(*out))


_WINDOWS = "id long, pos int, h long, slots array<string>, n int"


def windows(df: DataFrame, id_col: str, text_col: str, window: int = WINDOW,
            maybe=None) -> DataFrame:
    """(id, pos, h, slots, n): the windows of each text with their words; n is
    the text's number of tokens.  ``maybe`` (broadcast bytes of the prefilter)
    keeps only windows that the benchmark may have.  Without it the texts are
    the benchmark, and words that are no fillers are null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if maybe is None else np.frombuffer(maybe.value, np.uint8)
        for batch in batches:
            ids = batch.column(0)
            for start, texts in steps(batch.column(1)):
                forms, kind, codes, words, at = canonical(texts)
                text, pos, h = window_hashes(forms, at, window)
                if bits is not None:
                    low = (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
                    hit = (bits[low >> 3] >> (low & 7).astype(np.uint8)) & 1 == 1
                    text, pos, h = text[hit], pos[hit], h[hit]
                slots = []
                for t, p in zip(text.tolist(), pos.tolist()):
                    a = int(at[t]) + p
                    slots.append([None if bits is None and kind[j] == PLAIN else
                                  _fold(_core(words[codes[j]])) for j in range(a, a + window)])
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(text + start)), pa.array(pos.astype(np.int32)),
                     pa.array(h.view(np.int64)), pa.array(slots, pa.list_(pa.string())),
                     pa.array(np.diff(at)[text].astype(np.int32))],
                    names=["id", "pos", "h", "slots", "n"])
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string")
                     .alias("text")).mapInArrow(run, _WINDOWS)


def _prefilter(bench: DataFrame) -> bytes:
    """Bit map of the leading bits of the benchmark's hashes, put together from
    at most 2 ** FILTER_BITS / 64 partial words."""
    lead = F.shiftrightunsigned("h", 64 - FILTER_BITS)
    rows = (bench.select(F.shiftright(lead, 6).alias("word"), F.call_function(
        "shiftleft", F.lit(1).cast("long"), lead.bitwiseAND(F.lit(63)).cast("int")).alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("bits")).collect())
    out = np.zeros((1 << FILTER_BITS) // 64, np.int64)
    for r in rows:
        out[r["word"]] = r["bits"]
    return out.astype("<i8").tobytes()


def _part(hits: list[dict]) -> list[int]:
    """The item's tokens that an inconsistent diagonal covers: those in windows
    with the item's own fillers or, if more, with the most frequent value of each
    filler.  A new value makes the text another template where it contradicts, so
    in the second case tokens of contradicting windows do not count."""
    filled = {(h["at"] + i, was, now) for h in hits
              for i, (was, now) in enumerate(zip(h["was"], h["now"])) if was is not None}
    votes: dict[str, dict[str, list[int]]] = {}
    for pos, was, now in filled:
        votes.setdefault(was, {}).setdefault(now, []).append(pos)
    best = {was: min(own, key=lambda now: (-len(own[now]), now != was, min(own[now]), now))
            for was, own in votes.items()}
    own, fits, against = set(), set(), set()
    for h in hits:
        places = range(h["at"], h["at"] + len(h["now"]))
        fill = [(was, now) for was, now in zip(h["was"], h["now"]) if was is not None]
        if all(was == now for was, now in fill):
            own.update(places)
        (fits if all(best[was] == now for was, now in fill) else against).update(places)
    return sorted(max(own, fits - against, key=len))


def _consistent_part(hits: Column) -> Column:
    @F.arrow_udf("array<int>")
    def of(lines: pa.Array) -> pa.Array:
        return pa.array([None if h is None else _part(h) for h in lines.to_pylist()],
                        pa.list_(pa.int32()))
    return of(hits)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                 window: int = WINDOW, similarity: float = SIMILARITY) -> DataFrame:
    """Pairs (id, item id, similarity, same): documents that hold an item.

    ``similarity`` is the share of the item's tokens in matched windows,
    ``same`` whether no filler was changed.  Items with fewer tokens than a
    window are matched as one window of all their tokens; items with fewer
    than two tokens, null and empty texts match nothing.  Rows that share an
    id count as one document (or item); a null id stays null.
    """
    spark = docs.sparkSession
    sizes = [window, *range(2, window)]
    bench = None
    for size in sizes:
        # Shorter items: the only window of their full length.
        w = windows(benchmark, item_col, item_text, size)
        w = w if size == window else w.filter(F.col("n") == size)
        w = w.withColumn("size", F.lit(size))
        bench = w if bench is None else bench.union(w)
    bench = settle(bench, "bench-windows")
    present = {r["size"] for r in bench.select("size").distinct().collect()}
    hits = None
    for size in sorted(present):
        own = bench.filter(F.col("size") == size)
        maybe = spark.sparkContext.broadcast(_prefilter(own))
        w = windows(docs, id_col, text_col, size, maybe).drop("n").withColumn("size", F.lit(size))
        hits = w if hits is None else hits.union(w)
    if hits is None:
        hits = bench.filter(F.lit(False)).select("id", "pos", "h", "slots", "size")
    hits = settle(hits, "doc-windows")
    b = bench.select(F.col("id").alias("item"), F.col("pos").alias("at"), "h", "size", "n",
                     F.col("slots").alias("was"))
    met = hits.join(b, ["h", "size"]).select(
        "id", "item", "n", "size", "at", (F.col("pos") - F.col("at")).alias("shift"), "was",
        F.col("slots").alias("now"))
    # One row for each occurrence of an item: as many windows as the item has.
    line = met.groupBy("id", "item", "n", "size", "shift").agg(
        F.collect_set(F.struct("at", "was", "now")).alias("hits"))
    line = line.withColumn("fill", F.array_distinct(F.flatten(F.transform(
        "hits", lambda h: F.filter(F.arrays_zip(h["was"].alias("was"), h["now"].alias("now")),
                                   lambda x: x["was"].isNotNull())))))
    consistent = F.size(F.array_distinct(F.transform("fill", lambda x: x["was"]))) == F.size("fill")
    line = line.withColumn("same", ~F.exists("fill", lambda x: x["was"] != x["now"])).withColumn(
        "part", _consistent_part(F.when(~consistent, F.col("hits"))))
    line = line.withColumn("tokens", F.coalesce("part", F.array_distinct(F.flatten(F.transform(
        "hits", lambda h: F.sequence(h["at"], h["at"] + F.col("size") - 1))))))
    pair = line.groupBy("id", "item", "n", "size").agg(
        F.array_distinct(F.flatten(F.collect_set("tokens"))).alias("tokens"),
        F.bool_or("same").alias("same"))
    pair = pair.withColumn("sim", F.size("tokens") / F.col("n")).filter(F.col("sim") >= similarity)
    return pair.groupBy("id", "item").agg(
        F.max("sim").alias("similarity"), F.bool_or("same").alias("same")).select(
        F.col("id").alias(id_col), F.col("item").alias(item_col), "similarity", "same")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item (rows without an id go
    with the null id's verdict)."""
    bad = settle(contaminated(docs, benchmark, id_col, text_col)
                 .select(F.col(id_col).alias("bad")).distinct(), "contaminated")
    return docs.join(bad, docs[id_col].eqNullSafe(bad["bad"]), "left_anti")
