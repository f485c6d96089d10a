"""Mixing sources to target weights by hash-threshold histograms.

Every document gets a fixed hash of its id and text, cut into LEVELS digits. A source that has to give ``r``
words more than ``full`` whole repeats of itself takes the documents whose hash lies below a threshold.
The threshold is found digit by digit: sum words by source and digit, run a total over the digits of
each source, keep the digit in which the budget ends, and look at that bucket alone with the next
digit. Nothing is sorted and no document is shuffled: the shuffled rows are sums per source and
digit. The rule is nested: a larger target takes a superset, and reruns agree.

Sources in code-point order (NULL last) weigh 1, 2, 3, 1, ...; targets share all words by weight, stop
at MAX_REPEATS times the source, and what is cut is shared again by weight.

Edge cases: a NULL text or one without words has size 0 and gives nothing; a NULL doc_id or text hashes
like the empty string, so rows without an id are told apart by their texts; rows with the same id and text are taken
together; a source without words has target 0;
an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from saleslake.llm.common import boxed, words, written

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
#: Three digits of 4,096 values: 2**36 cells a source, far below one document each.
DIGIT = 3
LEVELS = 3


def digits(text: str = "text") -> list[Column]:
    """d0, d1, ...: the digits of the hash of doc_id and text."""
    named = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    code = F.md5(F.concat(named, F.lit("\n"), F.coalesce(F.col(text), F.lit(""))).cast("binary"))
    return [
        F.conv(F.substring(code, 1 + DIGIT * k, DIGIT), 16, 10).cast("int").alias(f"d{k}")
        for k in range(LEVELS)
    ]


def sized(df: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, source, size in words and the digits of the hash."""
    return df.select(
        "doc_id", "source", F.size(words(F.col(text))).cast("long").alias("size"), *digits(text)
    )


def targets(totals: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """source, source_size, target of a frame (source, source_size); one row per source.

    The fixed point of "cut at the cap and share the rest again": in order of cap / weight, a source
    is cut if its share of the words not yet given, by weight among itself and the later sources,
    reaches its cap. The first one that is not cut fixes the rate of all later ones. The windows run
    over one row per source.
    """
    by_code = Window.orderBy(F.col("source").asc_nulls_last())
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(1))
    turn = (F.row_number().over(by_code) - 1) % len(weights)
    ranked = totals.withColumn("weight", F.get(F.array(*map(F.lit, weights)), turn).cast("long"))
    ranked = ranked.withColumn("cap", F.col("source_size") * max_repeats)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    filled = ranked.select("*", left.alias("left"), F.sum("weight").over(after).alias("among"))
    filled = filled.withColumn(
        "capped", F.col("cap") / F.col("weight") <= F.col("left") / F.col("among")
    )
    free = F.when(~F.col("capped"), F.struct("left", "among"))
    rate = F.max_by(free, F.when(~F.col("capped"), F.col("among"))).over(whole)
    share = F.col("weight") * F.col("rate.left") / F.col("rate.among")
    return filled.withColumn("rate", rate).select(
        "source",
        "source_size",
        F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(share).alias("target"),
    )


def _boundary(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """Per source whose budget ends within it: the digits of that cell and whether it is taken."""
    cut = plan.select("source", "rest")
    found: list[str] = []
    for level in range(LEVELS):
        digit = f"d{level}"
        known = cut.select(F.col("source").alias("_source"), *(F.col(d).alias(f"_{d}") for d in found))
        here = docs
        if found:  # only the documents of the boundary buckets go on
            same = [docs[d] == known[f"_{d}"] for d in found]
            on = reduce(lambda a, b: a & b, same, docs["source"].eqNullSafe(known["_source"]))
            here = docs.join(known, on, "left_semi")
        cells = here.groupBy("source", digit).agg(F.sum("size").alias("words"))
        upto = F.sum("words").over(Window.partitionBy("source").orderBy(digit))
        budget = cut.withColumnRenamed("source", "_source").drop("words")
        over = (
            cells.withColumn("upto", upto)
            .join(budget, F.col("source").eqNullSafe(F.col("_source")))
            .where(F.col("upto") > F.col("rest"))
        )
        ends = over.groupBy("source", "rest", *found).agg(
            F.min(digit).alias(digit), F.min_by(F.struct("upto", "words"), digit).alias("end")
        )
        cut = written(
            ends.select(
                "source",
                *found,
                digit,
                (F.col("rest") - (F.col("end.upto") - F.col("end.words"))).alias("rest"),
                F.col("end.words").alias("words"),
            ),
            f"mixing-level{level}",
        )
        found.append(digit)
    cells = (F.col(d).alias(f"_{d}") for d in found)
    nearer = F.col("rest") * 2 >= F.col("words")  # take the last cell if that comes nearer
    return cut.select(F.col("source").alias("_source"), *cells, nearer.alias("_take"))


def _rule(docs: DataFrame, weights, max_repeats: int) -> DataFrame:
    """One row per source (_plan): source_size, target, full repeats, and the cell up to which one more.

    It is read from a written table, so its size is known: Spark broadcasts it below
    ``spark.sql.autoBroadcastJoinThreshold`` and splits hot sources otherwise.
    """
    totals = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    full = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(0)
    plan = targets(totals, weights, max_repeats).withColumn("full", full)
    rest = F.col("target") - F.col("full") * F.col("source_size")
    plan = written(plan.withColumn("rest", rest), "mixing-plan")
    cut = _boundary(docs, plan)
    rule = plan.withColumnRenamed("source", "_plan").join(
        cut, F.col("_plan").eqNullSafe(F.col("_source")), "left"
    )
    return written(rule.drop("_source"), "mixing-rule")


def _repeats() -> Column:
    """How often a document is taken, from its digits and the rule of its source."""
    below, same = F.lit(False), F.lit(True)
    for level in range(LEVELS):
        mine, bound = F.col(f"d{level}"), F.col(f"_d{level}")
        below, same = below | (same & (mine < bound)), same & (mine == bound)
    # Without a boundary cell the budget, if any, covers the whole source.
    once = F.when(F.col("_d0").isNull(), F.col("rest") > 0).otherwise(below | (same & F.col("_take")))
    return (F.col("full") + once.cast("long")).cast("long")


def mix(df: DataFrame, text: str = "text", weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """doc_id, source, size, source_size, target, repeats, taken (= size * repeats)."""
    docs = written(sized(df, text), "mixing-sizes")
    rule = _rule(docs, weights, max_repeats)
    return (
        docs.join(rule, F.col("source").eqNullSafe(F.col("_plan")))
        .withColumn("repeats", _repeats())
        .withColumn("taken", F.col("size") * F.col("repeats"))
        .select("doc_id", "source", "size", "source_size", "target", "repeats", "taken")
    )


def mixed(df: DataFrame, text: str = "text", weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The rows of ``df`` as often as the mix takes them, with their own columns."""
    rule = _rule(written(sized(df, text), "mixing-sizes"), weights, max_repeats)
    rows = boxed(df, F.col("source").alias("_own"), *digits(text))
    return (
        rows.join(rule, F.col("_own").eqNullSafe(F.col("_plan")))
        .select("_row", F.explode(F.array_repeat(F.lit(0), _repeats().cast("int"))))
        .select("_row.*")
    )
