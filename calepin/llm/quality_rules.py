"""Quality rules: a threshold table compiled into one Spark projection.

Every measure is a built-in function over the text: translate() for symbol
counts, split() for words and lines, sorted arrays of packed window hashes for
repeated windows. No user function runs and no row moves between tasks.

Null or empty text has no words: its measures are 0 and it fails. Rows that
repeat are judged each on their own, extra columns are left alone, an empty
table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bytes between words, as a class for split() and as characters for btrim().
WORD_GAP = "[\\x20\\x09-\\x0D]+"
GAP_CHARACTERS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

# Frequent function words of the four languages of the corpus.
STOP_WORDS = {
    "en": "the of and to in is it that was for on are as with his they at be this have from or had by not but what were when we an your which their if will each about how",
    "fr": "le la les de des du et en un une que est pour qui dans au sur ne se ce il sont avec son lui pas plus ou par",
    "de": "der die und den von zu das mit sich auf ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um für des",
    "es": "de la el los las y en que del por con no una su para lo como un se es al más o mi",
}


@dataclass(frozen=True)
class Rule:
    """Keep a document if low <= measure <= high; a bound may be missing."""

    measure: str
    low: float | None = None
    high: float | None = None

    def holds(self) -> Column:
        value = F.col(self.measure)
        checks = [F.lit(True)]
        if self.low is not None:
            checks.append(value >= F.lit(float(self.low)))
        if self.high is not None:
            checks.append(value <= F.lit(float(self.high)))
        verdict = checks[0]
        for check in checks[1:]:
            verdict = verdict & check
        return verdict


RULES = (
    Rule("n_words", low=50),
    Rule("repeat_share", high=0.5),
    Rule("mean_word_length", low=3, high=10),
    Rule("symbol_ratio", high=0.1),
    Rule("shout_ratio", high=0.3),
    Rule("stop_word_ratio", low=0.05),
    Rule("dup_line_ratio", high=0.5),
)
# The first two bounds again, in whole numbers: they alone decide base_failed.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


def stop_forms() -> list[str]:
    words = sorted({w for words in STOP_WORDS.values() for w in words.split()})
    return words + [w[0].upper() + w[1:] for w in words]


def count_of(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def repeat_words(words: Column, grams: Column, packed: Column, low: Column) -> Column:
    """Words in windows found twice. ``packed`` holds window hashes in sorted
    order whose low bits are the window's position, so equal windows are
    neighbours; neighbours count as equal only if their full hashes agree."""

    def position(x: Column) -> Column:
        return F.pmod(x, low).cast("int")

    def gram(x: Column) -> Column:
        return F.get(grams, position(x))

    def twice(x: Column, k: Column) -> Column:
        before = F.coalesce(gram(F.get(packed, k - 1)) == gram(x), F.lit(False))
        after = F.coalesce(gram(F.get(packed, k + 1)) == gram(x), F.lit(False))
        return before | after

    places = F.transform(F.filter(packed, twice), position)
    covered = F.flatten(F.transform(places, lambda p: F.array(p, p + 1, p + 2)))
    return F.size(F.array_distinct(covered))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Each row as a struct ``row`` beside its measures."""
    base = docs.select(
        F.struct("*").alias("row"),
        F.coalesce(F.col(text), F.lit("")).alias("body"),
    )
    base = base.withColumn("trimmed", F.btrim("body", F.lit(GAP_CHARACTERS)))
    base = base.withColumn(
        "words",
        F.when(F.col("trimmed") == "", F.array().cast("array<string>")).otherwise(
            F.split("trimmed", WORD_GAP)
        ),
    ).withColumn("lines", F.filter(F.split("body", "\n"), lambda x: F.btrim(x, F.lit(GAP_CHARACTERS)) != ""))
    words = F.col("words")
    base = base.withColumn("n", F.size("words")).withColumn(
        "grams",
        F.when(
            F.col("n") >= 3,
            F.transform(
                F.sequence(F.lit(0), F.col("n") - 3),
                lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    # A power of two above every position.
    base = base.withColumn(
        "low", F.call_function("shiftleft", F.lit(1).cast("long"), F.ceil(F.log2(F.col("n") + 1)).cast("int"))
    ).withColumn("repeats", F.size(F.array_distinct("grams")) < F.size("grams"))
    low = F.col("low")
    base = base.withColumn(
        "packed",
        F.when(
            F.col("repeats"),
            F.sort_array(
                F.transform("grams", lambda g, i: g.bitwiseAND(-low).bitwiseOR(i.cast("long")))
            ),
        ),
    )
    n = F.greatest(F.col("n"), F.lit(1)).cast("double")
    base = base.select(
        "row",
        F.col("n").cast("long").alias("n_words"),
        (F.length("body") - F.length(F.translate("body", GAP_CHARACTERS, ""))).alias("gaps"),
        F.length("body").alias("length"),
        count_of(F.col("body"), SYMBOLS).cast("long").alias("n_symbols"),
        count_of(F.col("body"), "!").alias("shouts"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("repeats"), repeat_words(words, F.col("grams"), F.col("packed"), low))
        .otherwise(0)
        .cast("long")
        .alias("n_repeat_words"),
        F.size(F.filter("words", lambda w: w.isin(stop_forms()))).alias("stops"),
        n.alias("n"),
    )
    return base.select(
        "row",
        "n_words",
        (F.col("length") - F.col("gaps")).cast("long").alias("word_chars"),
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (F.col("n_repeat_words") / F.col("n")).alias("repeat_share"),
        ((F.col("length") - F.col("gaps")) / F.col("n")).alias("mean_word_length"),
        (F.col("n_symbols") / F.col("n")).alias("symbol_ratio"),
        (F.col("shouts") / F.col("n")).alias("shout_ratio"),
        (F.col("stops") / F.col("n")).alias("stop_word_ratio"),
        (F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))).alias("dup_line_ratio"),
    )


def judged(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Measures with ``base_failed``, the first rule broken and ``kept``."""
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    broken = F.coalesce(*(F.when(~rule.holds(), F.lit(rule.measure)) for rule in rules), F.lit(None))
    return (
        measured(docs, text)
        .withColumn("base_failed", base_failed)
        .withColumn("broken_rule", broken)
        .withColumn("kept", ~F.col("base_failed") & F.col("broken_rule").isNull())
    )


def keep_good(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that break no rule, with their own columns."""
    # A row number keeps the filter above the measures: pushed below them, it
    # would hold a copy of every measure's whole expression.
    numbered = judged(docs, text, rules).select("row", "kept", F.monotonically_increasing_id().alias("number"))
    return numbered.where("kept and number >= 0").select("row.*")
