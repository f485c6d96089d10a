"""Quality rules: a threshold table compiled into one projection of built-in expressions.

``measures`` adds length, symbol, stop-word, repetition and line counts of a text; ``verdict``
compiles a table of ``Threshold`` rows into one boolean expression and the list of failed rules. All
of it is a narrow projection: no shuffle, no user function, one pass over the texts.

Edge cases: a NULL or empty text has no words and lines, all counts 0, and fails ``n_words``; a
repeated row is judged like its copies; other columns pass through, and a column of the input that
is named like a measure is replaced by it. Ratios are compared as integer products, so a text that
lies exactly on a threshold passes on every platform.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from saleslake.llm.common import SPACE_CLASS, boxed, words

#: Frequent function words of English, French, German and Spanish (fixed values).
STOP_WORDS = (
    "a and are as at be by for from in is it of on that the this to was with "
    "avec dans de des du en est et la le les pas pour que qui un une "
    "das den der die ein für ist mit nicht sich und von zu "
    "como con del el es las los no para por se su y"
).split()


class Threshold(NamedTuple):
    """``low <= measure / per <= high``; bounds are integer fractions (numerator, denominator)."""

    name: str
    measure: str
    per: str | None
    low: tuple[int, int] | None
    high: tuple[int, int] | None


#: What a text has to meet. The base rules come first; the bounds of the others are wide, to keep
#: every ordinary text and to reject lists of symbols, foreign alphabets and repeated boilerplate.
BASE = (
    Threshold("n_words", "n_words", None, (50, 1), None),
    Threshold("repeated words", "n_repeat_words", "n_words", None, (1, 2)),
)
RULES = (
    Threshold("mean word length", "word_chars", "n_words", (5, 2), (12, 1)),
    Threshold("symbols per word", "n_symbols", "n_words", None, (1, 10)),
    Threshold("stop words", "n_stop_words", "n_words", (1, 25), None),
    Threshold("repeated lines", "n_dup_lines", "n_lines", None, (1, 2)),
)

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_stop_words", "n_lines", "n_dup_lines", "n_repeat_words",
)


def measures(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the columns of MEASURES."""
    symbol = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^#*$%&|<>]+", "")
    blank = F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACE_CLASS}]+", "")
    line = F.filter(
        F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(f"[^{SPACE_CLASS}]")
    )
    rest = [c for c in df.columns if c not in MEASURES]
    first = df.select(
        *(F.col(f"`{c}`") for c in rest),
        F.char_length(blank).cast("long").alias("word_chars"),
        F.char_length(symbol).cast("long").alias("n_symbols"),
        words(F.col(text)).alias("_words"),
        line.alias("_lines"),
    )
    last = F.greatest(F.size("_words") - 2, F.lit(0))
    second = first.select(
        *(F.col(f"`{c}`") for c in rest),
        "word_chars",
        "n_symbols",
        F.size("_words").cast("long").alias("n_words"),
        F.size(F.filter("_words", lambda w: w.isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform(
            F.slice("_words", F.lit(1), last),
            lambda w, i: F.concat_ws(" ", w, F.get("_words", i + 1), F.get("_words", i + 2)),
        ).alias("_windows"),
    )
    # Equal windows become neighbours by sorting (window, position); a text without any repeated
    # window, the common case, skips that. Windows less than three words apart share words.
    kept = [c for c in second.columns if c != "_windows"]
    some = F.size(F.array_distinct("_windows")) < F.size("_windows")
    pairs = F.transform("_windows", lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    third = second.select(
        *(F.col(f"`{c}`") for c in kept), F.when(some, F.sort_array(pairs)).alias("_sorted")
    )

    def repeated(x: Column, k: Column) -> Column:
        before, after = F.get("_sorted", k - 1), F.get("_sorted", k + 1)
        return x["w"].eqNullSafe(before["w"]) | x["w"].eqNullSafe(after["w"])

    at = F.sort_array(F.transform(F.filter("_sorted", repeated), lambda x: x["i"]))
    fourth = third.select(*(F.col(f"`{c}`") for c in kept), at.alias("_at"))
    steps = F.transform(
        "_at", lambda x, k: F.least(F.lit(3), F.coalesce(F.get("_at", k + 1) - x, F.lit(3)))
    )
    covered = F.aggregate(steps, F.lit(0), lambda total, x: total + x)
    return fourth.select(
        *(F.col(f"`{c}`") for c in kept),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def meets(rule: Threshold) -> Column:
    """The rule as one expression over the measures."""
    per = F.col(rule.per) if rule.per else F.lit(1)
    found = F.lit(True)
    if rule.low:
        found = found & (F.col(rule.measure) * rule.low[1] >= per * rule.low[0])
    if rule.high:
        found = found & (F.col(rule.measure) * rule.high[1] <= per * rule.high[0])
    return found


def verdict(df: DataFrame, text: str = "text", base=BASE, rules=RULES) -> DataFrame:
    """``df`` with measures, ``base_failed``, ``failed_rules`` and ``kept``."""
    passed = F.lit(True)
    for rule in base:
        passed = passed & meets(rule)
    failed = F.array_compact(F.array(*(F.when(~meets(r), F.lit(r.name)) for r in (*base, *rules))))
    return (
        measures(df, text)
        .withColumn("base_failed", ~passed)
        .withColumn("failed_rules", failed)
        .withColumn("kept", F.size("failed_rules") == 0)
    )


def kept(df: DataFrame, text: str = "text", base=BASE, rules=RULES) -> DataFrame:
    """The rows of ``df`` that meet all rules, with their own columns."""
    judged = verdict(boxed(df, F.col(text).alias("text")), "text", base, rules)
    # The id, never negative, keeps the optimizer from pushing the filter into the measures, where it would
    # repeat each of them at every place that refers to it.
    once = F.col("kept") & (F.monotonically_increasing_id() >= 0)
    return judged.select("_row", once.alias("_kept")).where("_kept").select("_row.*")
