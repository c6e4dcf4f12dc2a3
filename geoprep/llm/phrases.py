"""Operator 7: benchmark decontamination by a positional inverted index.

1. Windows: ``size`` consecutive words of an item (a shorter item is one window).
2. The occurrences of every benchmark term in all training texts are counted, and each
   window gets its ``anchors`` rarest terms with their offsets.  A window whose rarest term
   never occurs cannot match.
3. Index: the postings (term, text, position) of every window's rarest term, stored as a
   table, each with the words around it.
4. Each posting gives an offset-adjusted start for the windows it is the rarest term of.
   The start is intersected with the places of the other anchors, rarest first: they are
   looked up among the kept words, at their own offsets.  (Lists of their own for the
   commoner anchors were tried: their offset-adjusted rows outgrew the disk.)  What agrees is
   compared in full.  ``proximity_matches`` lets the anchors stray by ``slop`` words.

Texts are named by two hashes of their content, so copies share postings and results and a
text is never shuffled.  The benchmark side is broadcast only if it counts at most
``BROADCAST_ROWS`` rows, and is joined by shuffle beyond that.

DataFrame functions only.  A null or empty text has no words; a null or wordless item has no
windows; repeated rows and items count alike; a repeated item_id is one item; other columns
are not read; an empty table gives an empty (documents) or a clean (benchmark) result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_side, staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"       # what separates words; letters of either case


def lowered(word: Column) -> Column:
    """A-Z in lower case, nothing else."""
    return F.translate(word, UPPER, LOWER)


def raw_words(text: str = "text") -> Column:
    """The words in their own case; the first and last may be empty."""
    return F.split(F.coalesce(F.col(text), F.lit("")), BETWEEN, -1)


def n_words(words: Column) -> Column:
    empty = F.when(words[0] == "", 1).otherwise(0)
    last = F.when((F.size(words) > 1) & (F.element_at(words, -1) == ""), 1).otherwise(0)
    return (F.size(words) - empty - last).cast("long")


def text_key() -> list[Column]:
    text = F.coalesce(F.col("text"), F.lit(""))
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(7), text, F.length(text)).alias("k2")]


def item_windows(benchmark: DataFrame, size: int) -> DataFrame:
    """wid, words, items (as strings): one row per distinct window."""
    words = F.filter(raw_words(), lambda w: w != "")
    items = benchmark.where(F.col("text").isNotNull()).select(
        F.col("item_id").cast("string").alias("item_id"), F.transform(words, lowered).alias("words"))
    n = F.size("words")
    cut = F.when(n >= size, F.transform(F.sequence(F.lit(1), n - (size - 1)), lambda i: F.slice("words", i, size))) \
        .when(n > 0, F.array("words")).otherwise(F.array().cast("array<array<string>>"))
    windows = items.select("item_id", F.explode(cut).alias("words")).groupBy("words").agg(F.collect_set("item_id").alias("items"))
    return staged(windows.select(F.monotonically_increasing_id().alias("wid"), "words", "items"), "windows")


def _matched(docs: DataFrame, terms: DataFrame, keep: list[Column], extra: list[str]) -> DataFrame:
    """One row per training word that is one of ``terms``: term, pos, ``keep`` and ``extra``."""
    words = docs.select(*keep, raw_words().alias("words"))
    each = words.select("*", F.posexplode("words").alias("pos", "word"))
    found = each.join(terms.withColumn("__low", F.lower("term")), F.lower("word") == F.col("__low")) \
        .where(lowered(F.col("word")) == F.col("term"))          # lower() also folds letters beyond A-Z
    return found.select("term", "pos", *extra)


def rarest_terms(docs: DataFrame, windows: DataFrame, anchors: int) -> DataFrame:
    """wid, ts (the terms to intersect, structs of n, term and offset, rarest first), first
    (the rarest term): one row per window that can occur."""
    each = windows.select("wid", F.posexplode("words").alias("offset", "term"))
    terms = small_side(staged(each.select("term").distinct(), "terms"))
    counts = _matched(docs, terms, [], []).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    priced = each.join(staged(counts, "term-counts"), "term", "left").select(
        "wid", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term", "offset").alias("t"))
    chosen = priced.groupBy("wid").agg(F.slice(F.sort_array(F.collect_list("t")), 1, anchors).alias("ts"))
    return staged(chosen.where(F.col("ts")[0]["n"] > 0).withColumn("first", F.col("ts")[0]["term"]), "anchors")


def build_index(docs: DataFrame, rarest: DataFrame, reach: int) -> DataFrame:
    """The postings of the windows' rarest terms: term, k1, k2, pos, around (the words from
    ``reach`` before to ``reach`` after) and lead (how many of them stand before)."""
    terms = staged(rarest.select(F.col("first").alias("term")).distinct(), "anchor-terms")
    found = _matched(docs, small_side(terms), text_key(), ["k1", "k2", "words"])
    begin = F.greatest(F.col("pos") - reach, F.lit(0))
    around = F.slice("words", begin + 1, F.lit(2 * reach + 1))          # stays in generated code: no copy of the whole text
    return staged(found.select("term", "k1", "k2", "pos", around.alias("around"), (F.col("pos") - begin).alias("lead")), "postings")


def _starts(index: DataFrame, rarest: DataFrame) -> DataFrame:
    """Every posting as a start of each window whose rarest term it is; base: the place of
    the window's first word among the kept ones."""
    offset = F.col("ts")[0]["offset"]
    return index.join(small_side(rarest), F.col("term") == F.col("first")).select(
        "k1", "k2", "wid", "ts", F.transform("around", lowered).alias("around"), (F.col("pos") - offset).alias("start"), (F.col("lead") - offset).alias("base"))


def phrase_matches(docs: DataFrame, benchmark: DataFrame, size: int = 10, anchors: int = 3) -> DataFrame:
    """k1, k2, start, length, items: every occurrence of a window in a training text."""
    windows = item_windows(benchmark, size)
    rarest = rarest_terms(docs, windows, anchors)
    starts = _starts(build_index(docs, rarest, size - 1), rarest).where("base >= 0")
    agreed = starts.where(F.forall("ts", lambda t: F.coalesce(
        F.get("around", F.col("base") + t["offset"]) == t["term"], F.lit(False))))
    checked = agreed.join(small_side(windows), "wid")
    return checked.where(F.slice("around", F.col("base") + 1, F.size("words")) == F.col("words")).select(
        "k1", "k2", "start", F.size("words").alias("length"), "items")


def proximity_matches(docs: DataFrame, benchmark: DataFrame, size: int = 10, anchors: int = 3, slop: int = 4) -> DataFrame:
    """k1, k2, start, items: starts of a window's rarest term where every other anchor stands
    within ``slop`` words of its place."""
    windows = item_windows(benchmark, size)
    rarest = rarest_terms(docs, windows, anchors)
    starts = _starts(build_index(docs, rarest, size - 1 + slop), rarest)

    def near(t: Column) -> Column:
        low = F.greatest(F.col("base") + t["offset"] - slop, F.lit(0))
        high = F.col("base") + t["offset"] + slop
        return F.when(high < 0, False).otherwise(F.array_contains(F.slice("around", low + 1, F.greatest(high - low + 1, F.lit(0))), t["term"]))

    return starts.where(F.forall("ts", near)).join(small_side(windows), "wid").select("k1", "k2", "start", "items").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10, anchors: int = 3) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted strings) and k1, k2 for every document."""
    matches = phrase_matches(docs, benchmark, size, anchors)
    spans, items = F.collect_set(F.struct("start", "length")), F.array_distinct(F.flatten(F.collect_set("items")))
    per_text = matches.groupBy("k1", "k2").agg(spans.alias("spans"), F.array_sort(items).alias("items"))
    ordered = F.sort_array("spans")
    union = F.aggregate(ordered, F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n")), lambda a, x: F.struct(
        F.greatest(a["upto"], x["start"] + x["length"]).alias("upto"),
        (a["n"] + F.greatest(F.lit(0), x["start"] + x["length"] - F.greatest(a["upto"], x["start"]))).alias("n")),
        lambda a: a["n"])
    hits = staged(per_text.select("k1", "k2", union.cast("long").alias("n_hit"), "items"), "hits")
    rows = docs.select("doc_id", n_words(raw_words()).alias("n_words"), *text_key())
    return rows.join(hits, ["k1", "k2"], "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), "k1", "k2")


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """``docs`` without the rows that hold a benchmark window."""
    hits = staged(phrase_matches(docs.select("text"), benchmark, size).select("k1", "k2").distinct(), "hit-texts")
    k1, k2 = text_key()
    hits = small_side(hits).select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2"))
    return docs.join(hits, (k1 == F.col("__k1")) & (k2 == F.col("__k2")), "left_anti")
