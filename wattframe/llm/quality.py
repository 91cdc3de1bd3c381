"""Quality rules in native expressions: base limits and distribution divergence.

A text is compared with the reference of its language by the Jensen-Shannon
distance of two histograms: classes of characters, and common words.  The
references are sums over all documents of the language.  Short texts have
ragged histograms, so the limit for common words widens as texts get shorter,
classes of characters count only above a minimum length, and a language with
few documents gives no reference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattframe.llm.common import WORD_SPACE, staged

# Frequent words of each language.
COMMON_WORDS = {
    "en": "the of and to in is that it for was on be",
    "fr": "de la le et les des en un une que du est",
    "de": "der die und in den von zu das ein mit sich ist",
    "es": "de la que el en y los del se las un con",
}
CLASSES = {"lower": "[^a-z]+", "upper": "[^A-Z]+", "digit": "[^0-9]+", "space": "[^\\x20\\x09-\\x0D]+",
           "stop": "[^.,;:]+", "mark": "[^!?'\"()/-]+", "symbol": "[^#*$%&|<>]+"}
SIZE = 12

LEAST_WORDS = 50
MOST_REPEATED = 50  # percent of words in repeated windows
LEAST_CHARS = 200  # below, character classes are not judged
FULL_COUNT = 100  # words; a shorter text may be further from the reference in its common words
SLACK = 0.0008  # by so much for each word that it lacks
LEAST_DOCS = 20  # documents that make a reference
CHAR_LIMIT = 0.30
WORD_LIMIT = 0.24


def words_of(text: Column) -> Column:
    """The words of a text; none for an empty one."""
    return F.filter(F.split(text, WORD_SPACE), lambda w: w != "")


def _repeated(words: Column) -> Column:
    """Words that lie in a 3-word window found more than once in the text."""
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(
        F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    hashes = F.when(F.size(words) >= 3, windows).otherwise(F.array().cast("array<bigint>"))
    return F.transform(F.array(hashes), lambda h: F.when(
        F.size(h) == F.size(F.array_distinct(h)), F.lit(0)).otherwise(_covered(h)))[0]


def _covered(hashes: Column) -> Column:
    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def at(p: Column) -> Column:
        return F.array_sort(F.transform(F.filter(p, lambda x, k: (
            (F.get(p, k - 1)["h"] == x["h"]) | F.coalesce(F.get(p, k + 1)["h"] == x["h"], F.lit(False)))),
            lambda x: x["i"]))

    def total(a: Column) -> Column:
        return F.aggregate(F.transform(a, lambda x, k: F.least(
            F.lit(3), F.coalesce(F.get(a, k + 1) - x, F.lit(3)))), F.lit(0), lambda s, x: s + x)

    # one-element arrays bind a value for use in several places
    return F.transform(F.transform(F.array(pairs), at), total)[0]


def measured(docs: DataFrame) -> DataFrame:
    """The base statistics and histograms of each row, under ``stats``, beside all columns under ``row``."""
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    lists = F.create_map(*[x for k, v in COMMON_WORDS.items() for x in (F.lit(k), F.array(*map(F.lit, v.split())))])
    lang = F.col("row.lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    held = (docs.select(F.struct("*").alias("row")).select("row", text.alias("text"), lang.alias("lang"))
            .withColumn("words", words_of(F.col("text")))
            .withColumn("common", F.element_at(lists, F.col("lang")))
            .withColumn("few", F.filter("words", lambda w: w.isin(sorted(set(" ".join(COMMON_WORDS.values()).split()))))))
    words, text = F.col("words"), F.col("text")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    only = {k: F.length(F.regexp_replace(text, v, "")).cast("long") for k, v in CLASSES.items()}
    counts = [F.size("few") - F.size(F.array_remove("few", F.get("common", F.lit(k)))) for k in range(SIZE)]
    return held.withColumn("chars", F.struct(*[v.alias(k) for k, v in only.items()])).select("row", "lang", F.struct(
        F.size(words).cast("long").alias("n_words"),
        (F.length(text) - F.col("chars.space")).cast("long").alias("word_chars"),
        F.col("chars.symbol").alias("n_symbols"),
        F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x)))[0].cast("long").alias("n_dup_lines"),
        _repeated(words).cast("long").alias("n_repeat_words"),
        F.length(text).cast("long").alias("n_chars"),
        F.array(*[F.col("chars")[k] for k in CLASSES]).alias("classes"),
        F.when(F.col("common").isNotNull(), F.array(*[c.cast("long") for c in counts])).alias("common"),
    ).alias("stats"))


def _full(counts: Column, total: Column) -> Column:
    """``counts`` with what they leave of ``total`` as the last class."""
    return F.concat(counts, F.array(total - F.aggregate(counts, F.lit(0).cast("long"), lambda s, x: s + x)))


def _shares(counts: Column) -> Column:
    """Counts over their sum; null where the sum is zero or a count is missing."""
    def divided(a: Column) -> Column:
        return F.transform(F.array(F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)),
                           lambda total: F.when(total > 0, F.transform(a, lambda x: x / total)))[0]

    return F.transform(F.array(counts), divided)[0]


def js_distance(a: Column, b: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two arrays of counts; null if either has none."""
    def term(p: Column, q: Column) -> Column:
        m = (p + q) / 2
        return (F.when(p > 0, p * F.log2(p / m)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0)) / 2

    whole = F.aggregate(F.zip_with(_shares(a), _shares(b), term), F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.greatest(whole, F.when(whole.isNotNull(), F.lit(0.0))))


def references(stats: DataFrame) -> DataFrame:
    """For each language the sums of its documents' histograms; one row for each language."""
    sums = [F.sum(F.get("stats.classes", F.lit(i))).alias(f"c{i}") for i in range(len(CLASSES))]
    sums += [F.sum(F.get("stats.common", F.lit(i))).alias(f"w{i}") for i in range(SIZE)]
    totals = stats.where("lang is not null").groupBy("lang").agg(
        F.count("*").alias("docs"), F.sum("stats.n_chars").alias("chars"), F.sum("stats.n_words").alias("words"), *sums)
    return totals.where(F.col("docs") >= LEAST_DOCS).select(
        "lang", _full(F.array(*[f"c{i}" for i in range(len(CLASSES))]), F.col("chars")).alias("char_ref"),
        F.when(F.col("w0").isNotNull(), _full(F.array(*[f"w{i}" for i in range(SIZE)]), F.col("words"))).alias("word_ref"))


def judged(docs: DataFrame, carry: list[str]) -> DataFrame:
    """Statistics, distances and verdict of each row, with the columns ``carry`` of it.

    Null text counts as empty and fails the base limits.  A row whose language
    is null, or too rare for a reference, is judged by the base limits alone.
    Repeated rows count and are judged each.  Extra columns don't matter.
    """
    slim = docs.select(*[c for c in docs.columns if c in {*carry, "text", "lang"}])
    stats = staged(measured(slim).select(*[F.col("row")[c].alias(c) for c in carry], F.col("lang").alias("_lang"),
                                         "stats"), "stats").withColumn("lang", F.col("_lang"))
    refs = references(stats).withColumnRenamed("lang", "_lang")
    joined = stats.drop("lang").join(refs, "_lang", "left")
    s = F.col("stats")
    chars = js_distance(_full(s["classes"], s["n_chars"]), F.col("char_ref"))
    words = js_distance(_full(s["common"], s["n_words"]), F.col("word_ref"))
    word_limit = F.lit(WORD_LIMIT) + F.lit(SLACK) * F.greatest(F.lit(0), FULL_COUNT - s["n_words"])
    return (joined
            .withColumn("char_distance", F.when(s["n_chars"] >= LEAST_CHARS, chars))
            .withColumn("word_distance", F.when(s["n_words"] >= LEAST_WORDS, words))
            .withColumn("base_failed", (s["n_words"] < LEAST_WORDS)
                        | (100 * s["n_repeat_words"] > MOST_REPEATED * s["n_words"]))
            .withColumn("kept", ~F.col("base_failed")
                        & (F.coalesce("char_distance", F.lit(0.0)) <= CHAR_LIMIT)
                        & (F.coalesce("word_distance", F.lit(0.0)) <= word_limit))
            .select(*carry, *[s[c].alias(c) for c in
                              ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                    "char_distance", "word_distance", "base_failed", "kept"))
