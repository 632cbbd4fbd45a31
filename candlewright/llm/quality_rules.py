"""Quality rules with thresholds learned per language and source (operator 10, DataFrame functions only).

Every document gets a few integer figures. Their distribution per (language, source) is kept in a mergeable
quantile sketch: counts per bin, so partial sketches of any split of the rows add up to the same sketch, whatever the
order. Bins are exact below 2^12; above they keep the 12 leading bits, so a quantile is low by a factor of 2^-11 at
most, without an upper end: a figure of b bits has at most 2^12 + 2^11 (b - 12) bins. Thresholds are read from the
sketches and joined back to the documents.

Defined cases: a null text is an empty one (no words, fails the base rule); null language or source is a group of
its own, shared with the empty string; repeated rows are judged separately and alike; an empty table gives an
empty result; further columns are ignored by ``judged`` and kept by ``kept_documents``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlewright.llm.base import SPACE, saved

WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """A figure per document as an integer, and how far from the middle half of its group it may lie."""

    name: str
    figure: str
    least_spread: int
    spreads: int = 3
    low: bool = False


#: Ratios are in thousandths, word lengths in hundredths of a character.
RULES = (
    Rule("symbols", "1000 * n_symbols div greatest(word_chars, 1)", 20),
    Rule("dup_lines", "1000 * n_dup_lines div greatest(n_lines, 1)", 150),
    Rule("repeats", "1000 * n_repeat_words div greatest(n_words, 1)", 90),
    Rule("stutter", "1000 * n_stutter div greatest(n_words, 1)", 70),
    Rule("capitals", "1000 * n_capitals div greatest(word_chars, 1)", 40),
    Rule("word_length", "100 * word_chars div greatest(n_words, 1)", 60, 5),
    Rule("short_words", "100 * word_chars div greatest(n_words, 1)", 60, 5, True),
)
#: A group's thresholds are mixed with those of its language, which count as this many documents.
PRIOR = 50
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30


def repeat_words(hashes: Column, sorted_: Column) -> tuple[Column, Column]:
    """Positions of windows that occur again, out of the sorted (hash, position) pairs, and the words they cover."""
    flagged = F.filter(sorted_, lambda x, i: ((i > 0) & (F.get(sorted_, i - 1)["h"] == x["h"])) | F.coalesce(F.get(sorted_, i + 1)["h"] == x["h"], F.lit(False)))
    positions = F.array_sort(F.transform(flagged, lambda x: x["p"]))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate(
        positions, start, lambda a, p: F.struct((a["n"] + p + WINDOW - F.greatest(a["end"], p)).alias("n"), (p + WINDOW).alias("end")), lambda a: a["n"]
    )
    return positions, covered


def figures(documents: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines, n_repeat_words, n_capitals and n_stutter (words like the one before) to ``doc_id``, ``lang`` and ``source``; __row holds the columns that are ``carried``."""
    at = documents.select(
        "doc_id", F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce("text", F.lit("")).alias("text"), *([F.struct(*carried).alias("__row")] if carried else []),
    )
    at = at.withColumns({
        "words": F.filter(F.split("text", SPACE + "+"), lambda w: w != ""),
        "lines": F.filter(F.split("text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")),
        "word_chars": F.char_length(F.regexp_replace("text", SPACE + "+", "")).cast("long"),
        "n_symbols": F.char_length(F.regexp_replace("text", "[^#*$%&|<>]+", "")).cast("long"),
        "n_capitals": F.char_length(F.regexp_replace("text", "\\P{Lu}+", "")).cast("long"),
    })
    at = at.withColumns({"n": F.size("words"), "hashed": F.transform("words", lambda w: F.xxhash64(w))})
    windows = F.transform(F.sequence(F.lit(0), F.col("n") - WINDOW), lambda i: F.xxhash64(F.slice("hashed", i + 1, WINDOW)))
    stutter = F.size(F.filter("hashed", lambda h, i: (i > 0) & (F.get(F.col("hashed"), i - 1) == h))).cast("long")
    at = at.select(
        "doc_id", "lang", "source", *(["__row"] if carried else []), "word_chars", stutter.alias("n_stutter"), "n_symbols", "n_capitals", F.col("n").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("n") >= WINDOW, windows).otherwise(F.array().cast("array<bigint>")).alias("hashes"),
    )
    again = F.size(F.array_distinct("hashes")) < F.size("hashes")
    pairs = F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("p")))
    at = at.withColumn("sorted", F.when(again, F.sort_array(pairs)))
    _, covered = repeat_words(F.col("hashes"), F.col("sorted"))
    return at.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("hashes", "sorted")


def bin_of(figure: Column) -> Column:
    """The figure with its 12 leading bits, the others zero."""
    rest = F.greatest(F.length(F.bin(figure)) - 12, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", figure, rest), rest)


def sketches(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts per (lang, source, rule, bin); sketches of parts are merged by adding counts."""
    bins = F.array(*[F.struct(F.lit(r.name).alias("rule"), bin_of(F.expr(r.figure)).alias("bin")) for r in rules])
    return measured.select("lang", "source", F.inline(bins)).groupBy("lang", "source", "rule", "bin").agg(F.count("*").alias("c"))


def quartiles(bins: DataFrame, by: list[str]) -> DataFrame:
    """First and third quartile and the number of documents per group; a group has some thousand bins at most."""
    merged = bins.groupBy(*by, "rule", "bin").agg(F.sum("c").alias("c"))
    whole = Window.partitionBy(*by, "rule")
    ranked = merged.withColumns({"upto": F.sum("c").over(whole.orderBy("bin")), "n": F.sum("c").over(whole)})
    return ranked.groupBy(*by, "rule").agg(
        F.first("n").alias("n"), F.min(F.when(4 * F.col("upto") >= F.col("n"), F.col("bin"))).alias("q1"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("n"), F.col("bin"))).alias("q3"),
    )


def thresholds(bins: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per (lang, source) with a column per rule: the bound that its figure must not pass."""
    def bound(q1: str, q3: str) -> Column:
        chosen = None
        for r in rules:
            reach = r.spreads * F.greatest(F.col(q3) - F.col(q1), F.lit(r.least_spread))
            value = F.col(q1) - reach if r.low else F.col(q3) + reach
            chosen = F.when(F.col("rule") == r.name, value) if chosen is None else chosen.when(F.col("rule") == r.name, value)
        return chosen

    own = quartiles(bins, ["lang", "source"])
    wide = quartiles(bins, ["lang"]).select("lang", "rule", bound("q1", "q3").alias("wide"))
    mixed = own.join(wide, ["lang", "rule"]).select(
        "lang", "source", "rule", F.floor((F.col("n") * bound("q1", "q3") + PRIOR * F.col("wide")) / (F.col("n") + PRIOR)).alias("bound")
    )
    return mixed.groupBy("lang", "source").agg(*[F.max(F.when(F.col("rule") == r.name, F.col("bound"))).alias(f"{r.name}_bound") for r in rules])


def judged(documents: DataFrame, rules: tuple[Rule, ...] = RULES, carried: Sequence[str] = ()) -> DataFrame:
    """Per row of ``documents``: doc_id, the figures, base_failed, the names of the adaptive rules it breaks, and kept."""
    measured = saved(figures(documents, carried), "quality-figures")
    bounds = saved(thresholds(sketches(measured, rules), rules), "quality-bounds")
    broken = F.filter(F.array(*[
        F.when(F.expr(r.figure) < F.col(f"{r.name}_bound") if r.low else F.expr(r.figure) > F.col(f"{r.name}_bound"), F.lit(r.name))
        for r in rules
    ]), lambda x: x.isNotNull())
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return measured.join(bounds, ["lang", "source"]).withColumns({"base_failed": failed, "broken": broken}).withColumn(
        "kept", ~F.col("base_failed") & (F.size("broken") == 0)
    )


def kept_documents(documents: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns: these are written beside the figures, no text is shuffled to find its verdict."""
    return judged(documents, carried=documents.columns).where("kept").select("__row.*")
