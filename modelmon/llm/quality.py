"""Quality rules: counted rules, then divergence from the references of the text's language.

Each text gives two histograms: its characters by class, and its words among the function words below. The reference of a
language is, class by class, the median share over its different texts that pass the base rules, each counted once whatever
its length and number of copies: up to half of a language's texts can be junk without moving it to them. A text is rejected when the Jensen-Shannon distance (base 2, 0 to 1)
between its shares and the reference's is over a limit and the text is long enough for the comparison to mean anything.
Only DataFrame functions: everything about one text is computed inside its row, nothing about it is shuffled but counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from modelmon.functions.sizes import bounded
from modelmon.llm.common import fixed, numbered, passing_tables, unpack, words

# Frequent function words of four languages. A word in two lists counts once, as itself.
FUNCTION_WORDS = {
    "en": "the of and to in is that it for was on with".split(),
    "fr": "de la le les et des en un une que dans pour".split(),
    "de": "der die und in den von zu das mit sich auf nicht".split(),
    "es": "de la que el en y los se del las por con".split(),
}
COMMON = sorted({w for some in FUNCTION_WORDS.values() for w in some})
# One ASCII character per word, so that a text's function words become a short string to count in.
MARKS = [chr(48 + i) for i in range(len(COMMON))]
SYMBOLS = "#*$%&|<>"
# Character classes by what is left of a text without the others; letters outside ASCII are a class of their own.
CLASSES = {"upper": "[^A-Z]+", "lower": "[^a-z]+", "digit": "[^0-9]+", "beyond_ascii": r"[\x00-\x7F]+"}

MIN_WORDS = 50
REPEAT_PERCENT = 50
# Limits of the method, and the least text each comparison needs.
MAX_CHAR_DISTANCE = 0.32
MAX_WORD_DISTANCE = 0.75
MIN_CHARS = 200
MIN_COMMON = 20
# Shares are counted in steps of one in so many, so that medians are exact, the same on every run, and bounded in size.
STEPS = 2_000


def _windows(w: Column) -> Column:
    """The hash of each 3-word window, in order."""
    return F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))


def _covered(placed: Column) -> Column:
    """Words inside a window that is found twice or more, from sorted (hash, place) pairs.

    Equal windows stand side by side; the places of the repeated ones, in order, each add the words that the one before
    them has not covered.
    """
    again = F.filter(
        placed,
        lambda x, j: F.coalesce(F.get(placed, j + 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get(placed, j - 1)["h"] == x["h"], F.lit(False)),
    )
    places = F.sort_array(F.transform(again, lambda x: x["i"]))
    return F.aggregate(
        places,
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")),
        lambda a: a["n"],
    )


def counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns and every count the rules need, per row with columns ``text`` and ``lang``. Null texts are empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    step = docs.select(
        *keep, F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("language"), F.xxhash64(text).alias("same"), text.alias("t"), words(text).alias("w")
    )
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    mark = F.create_map(*[F.lit(x) for pair in zip(COMMON, MARKS) for x in pair])
    common = F.array_join(F.transform(F.filter(F.transform("w", F.lower), lambda x: x.isin(COMMON)), lambda x: mark[x]), "")
    symbols = reduce(lambda x, y: x + y, [F.length("t") - F.length(F.replace("t", F.lit(c))) for c in SYMBOLS])
    step = step.select(
        *keep, "language", "same",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.when(F.size("w") >= 3, _windows(F.col("w"))).otherwise(F.array().cast("array<bigint>")).alias("windows"),
        F.length("t").cast("long").alias("n_chars"),
        F.array(*[F.length(F.regexp_replace("t", pattern, "")).cast("long") for pattern in CLASSES.values()]).alias("classes"),
        common.alias("common"),
    )
    # Texts whose windows all differ need no sorting.
    distinct = F.size(F.array_distinct("windows")) == F.size("windows")
    step = step.withColumn(
        "placed", F.when(~distinct, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    )
    named = F.aggregate("classes", F.lit(0).cast("long"), lambda x, y: x + y)
    return step.select(
        *keep, "language", "same", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(_covered(F.col("placed")), F.lit(0)).cast("long").alias("n_repeat_words"),
        "n_chars",
        # White space, the named classes, symbols, and whatever else words are made of.
        F.concat(
            F.array(F.col("n_chars") - F.col("word_chars"), "n_symbols", F.col("word_chars") - F.col("n_symbols") - named), "classes"
        ).alias("by_class"),
        F.array(*[(F.length("common") - F.length(F.replace("common", F.lit(m)))).cast("long") for m in MARKS]).alias("by_word"),
    )


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0.0), lambda x, y: x + y)


def _distance(mine: str, reference: str) -> Column:
    """Jensen-Shannon distance between two histograms with totals beside them; null if either is empty."""

    def half(p: Column, middle: Column) -> Column:
        return F.when(p > 0, p * F.log2(p / middle)).otherwise(0.0)

    def part(x: Column, y: Column) -> Column:
        p, q = x / F.col(f"{mine}_n"), y / F.col(f"{reference}_n")
        return half(p, (p + q) / 2) + half(q, (p + q) / 2)

    total = F.aggregate(F.zip_with(mine, reference, part), F.lit(0.0), lambda x, y: x + y)
    return F.when((F.col(f"{mine}_n") > 0) & (F.col(f"{reference}_n") > 0), F.sqrt(F.greatest(total / 2, F.lit(0.0))))


SIZES = {"by_class": len(CLASSES) + 3, "by_word": len(COMMON)}


def _failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def references(counted: DataFrame) -> DataFrame:
    """One row per language: the median share of each class over its different texts that pass the base rules.

    Only texts long enough for a comparison count in it; a language without any has an empty reference. Texts are told apart
    by their hash, shares become counts per step before the shuffle, and a median is read from at most STEPS + 1 of them.
    """
    # Copies have equal counts, so any of them stands for all.
    texts = counted.where(~_failed()).groupBy("language", "same").agg(F.first("n_chars").alias("n_chars"), *[F.first(c).alias(c) for c in SIZES])
    places, at = [], 0
    for c, n in SIZES.items():
        total = F.aggregate(c, F.lit(0).cast("long"), lambda x, y: x + y)
        enough = (F.col("n_chars") >= MIN_CHARS) & (total > 0) if c == "by_class" else total >= MIN_COMMON
        start = at
        shares = F.transform(c, lambda x, i: ((i + start) * (STEPS + 1) + F.floor(x * STEPS / total + 0.5)).cast("int"))
        places.append(F.when(enough, shares).otherwise(F.array().cast("array<int>")))
        at += n
    counts = texts.select("language", F.explode(F.concat(*places)).alias("at")).groupBy("language", "at").agg(F.count("*").alias("n"))
    # Steps in order with their counts; the first one at which half of all is reached is the (lower) median.
    medians = (
        counts.select("language", F.floor(F.col("at") / (STEPS + 1)).cast("int").alias("part"), F.struct((F.col("at") % (STEPS + 1)).alias("s"), "n").alias("x"))
        .groupBy("language", "part").agg(F.sort_array(F.collect_list("x")).alias("xs"), F.sum("x.n").alias("total"))
        .select("language", "part", F.aggregate(
            "xs", F.struct(F.lit(0).cast("long").alias("upto"), F.lit(-1).alias("s")),
            lambda a, x: F.struct(
                (a["upto"] + x["n"]).alias("upto"), F.when((a["s"] < 0) & (2 * (a["upto"] + x["n"]) >= F.col("total")), x["s"]).otherwise(a["s"]).alias("s")
            ),
            lambda a: a["s"].cast("double"),
        ).alias("median"))
        .groupBy("language").agg(F.map_from_entries(F.collect_list(F.struct("part", "median"))).alias("m"))
    )
    whole_table = counted.select("language").distinct().join(medians, "language", "left")
    at, out = 0, []
    for c, n in SIZES.items():
        out.append(F.array(*[F.coalesce(F.try_element_at("m", F.lit(at + i)), F.lit(0.0)) for i in range(n)]).alias(f"{c}_all"))
        at += n
    return fixed(whole_table.select("language", *out), "references")


def judged(counted: DataFrame, reference: DataFrame) -> DataFrame:
    """The counts with base_failed, char_distance, word_distance (null: too short to compare) and kept."""
    both = counted.join(reference, "language")
    for c in SIZES:
        both = both.withColumns({c: F.col(c).cast("array<double>"), f"{c}_n": _total(F.col(c).cast("array<double>")), f"{c}_all_n": _total(F.col(f"{c}_all"))})
    return both.select(
        *[c for c in counted.columns if c not in SIZES],
        _failed().alias("base_failed"),
        F.when(F.col("n_chars") >= MIN_CHARS, _distance("by_class", "by_class_all")).alias("char_distance"),
        F.when(F.col("by_word_n") >= MIN_COMMON, _distance("by_word", "by_word_all")).alias("word_distance"),
    ).withColumn(
        "kept",
        ~F.col("base_failed")
        & (F.coalesce("char_distance", F.lit(0.0)) <= MAX_CHAR_DISTANCE)
        & (F.coalesce("word_distance", F.lit(0.0)) <= MAX_WORD_DISTANCE),
    )


def quality(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang): the counted rules, the two distances and the verdict.

    Null texts count as empty, and empty texts fail the base rules (under 50 words). Null languages are one language of
    their own. Repeated rows come out repeated, an empty table gives an empty one, further columns are ignored.
    """
    counted = fixed(counts(docs.select("doc_id", "text", "lang"), ["doc_id"]), "quality")
    return judged(counted, references(counted)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("char_distance", 6).alias("char_distance"), F.round("word_distance", 6).alias("word_distance"),
    )


def keep_good(docs: DataFrame, stored: bool = False) -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, with their own columns. ``stored``: see ``numbered``."""
    table = numbered(docs, stored)
    with passing_tables(docs.sparkSession):
        counted = fixed(
            counts(table.select("row", F.col("d.text").alias("text"), F.col("d.lang").alias("lang")), ["row"]), "quality"
        )
        dropped = fixed(judged(counted, references(counted)).where(~F.coalesce("kept", F.lit(False))).select("row"), "rejected", lasting=True)
    return unpack(table.join(bounded(dropped), "row", "left_anti"), docs.columns)
