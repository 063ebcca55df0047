"""Quality rules: a table of thresholds compiled into one Spark projection.

Every measure is a column expression over the text and its words; a rule is a
measure with a lower and an upper bound.  ``verdict`` turns any such table
into one boolean expression.  There is no user function and no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import WORD


class Rule(NamedTuple):
    """A document fails when ``measure`` lies outside [low, high]; None: no bound."""

    name: str
    measure: str
    low: float | None
    high: float | None


#: Frequent function words of the languages in the corpus.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "it", "with", "for", "as", "was", "on", "are", "by", "this", "be",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "sich", "des", "auf", "für", "ist", "im", "dem", "nicht", "ein", "eine",
    "de", "la", "le", "les", "et", "des", "en", "un", "une", "du", "que", "est", "pour", "qui", "dans", "par", "au", "sur",
    "el", "los", "las", "del", "se", "por", "con", "para", "una", "su", "al", "lo", "y", "es",
)

#: The threshold table of production.
RULES = (
    Rule("mean word length", "mean_word_chars", 2.0, 14.0),
    Rule("symbols for each word", "symbols_per_word", None, 0.1),
    Rule("stop words among words", "stop_share", 0.03, None),
    Rule("repeated lines among lines", "dup_line_share", None, 0.5),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once for each row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_window_words(words: Column, width: int = 3) -> Column:
    """Words that lie in a ``width``-word window found twice or more in the
    array, the first one included.  Windows are told apart by a 64-bit hash."""

    def of(w: Column) -> Column:
        n = F.size(w)
        hashes = F.transform(F.sequence(F.lit(0), n - width), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))

        def covered(h: Column) -> Column:
            at = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

            def twice(s: Column) -> Column:
                same = F.filter(s, lambda e, j: (F.get(s, j + 1)["x"] == e["x"]) | (F.get(s, j - 1)["x"] == e["x"]))
                return F.size(F.array_distinct(F.flatten(F.transform(same, lambda e: F.array(*[e["i"] + k for k in range(width)])))))

            return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(at, twice))

        return F.when(n <= width, F.lit(0)).otherwise(let(hashes, covered))

    return let(words, of)


def measures(docs: DataFrame) -> DataFrame:
    """``docs`` as a struct ``r`` with every measure of its text beside it, in one projection over one scan."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select(F.struct("*").alias("r"), text.alias("t"),
                        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("w"),
                        F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)).alias("lines"))
    counted = split.select(
        "r",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_window_words(F.col("w")).cast("long").alias("n_repeat_words"),
        F.size(F.filter("w", lambda x: F.lower(x).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
    )
    per_word = lambda c: F.col(c) / F.greatest(F.col("n_words"), F.lit(1))
    return counted.select(
        "*", per_word("word_chars").alias("mean_word_chars"), per_word("n_symbols").alias("symbols_per_word"),
        per_word("n_stop_words").alias("stop_share"),
        (F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))).alias("dup_line_share"))


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """True when a row of ``measures`` lies inside every bound of the table."""
    out = F.lit(True)
    for r in rules:
        if r.low is not None:
            out = out & (F.col(r.measure) >= F.lit(float(r.low)))
        if r.high is not None:
            out = out & (F.col(r.measure) <= F.lit(float(r.high)))
    return out


def base_failed() -> Column:
    """Fewer than 50 words, or over half of the words in repeated windows."""
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``r`` (the row of ``docs``), its measures, ``base_failed`` and ``kept``.

    A null text counts as empty: no words, all counts 0, base failed.  Rows
    are judged one by one, so repeated rows get equal verdicts; an empty table
    gives no rows.
    """
    return measures(docs).withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & verdict(rules))


def passing(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns."""
    return judge(docs, rules).filter("kept").select("r.*")
