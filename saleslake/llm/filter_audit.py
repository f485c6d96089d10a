"""Filter interaction audit: what each filter removes, alone and behind others, from failing-id relations.

Five filters judge whole texts. Each stores one table of the ids that fail it. A prefix of an order of
filters is a set: its survivors are the documents left over by anti joins with the tables of the set, and
what the next filter removes is the semi join of the survivors with that filter's table. All prefixes go
through the same joins: before the table of a filter is anti-joined, each survivor is doubled, once for the
prefixes without the filter (which skip the join) and once for those with it. So the 32 sets of prefixes
need five joins, and the removals of one filter four more behind its semi join. The rows that are
joined are ids with a few flags; they are dealt by id once, and all joins use that partitioning.

A: fewer than 200 words. B: fewer distinct words than half the words. C: capital letters A-Z are more than
2 % of the code points. D: holds one of ``#$%&*|``. E: the same text has a smaller doc_id somewhere in the table.

Edge cases: a NULL text is empty (fails A; E as any other text); a NULL source is the part ''; a row
without doc_id has no label, doesn't fail E and makes no other fail it; equal rows count as many
times as there are; rows that share an id but no text are judged one by one and share the id's labels. Labels
repeated for an id count once, NULL labels are none. Extra columns are ignored; an empty table gives no rows.
Texts are the same if their SHA-256 is. A row is known by its id and 128 bits of that; the smallest
long is reserved for rows without id.
"""

from __future__ import annotations

import json
from functools import reduce
from itertools import combinations, permutations
from math import factorial

from pyspark.sql import Column, DataFrame, functions as F

from saleslake.llm.common import NO_ID, words, written

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
KEY = ("rid", "t1", "t2")
#: The counts of a document: rows, rows labelled as good, rows labelled as toxic.
COUNTS = ("n", "good", "toxic")


def failed(text: Column) -> dict[str, Column]:
    """The conditions that a text meets by itself; E needs the whole table."""
    found = words(text)
    return {
        "A": F.size(found) < 200,
        "B": F.size(F.array_distinct(found)) * 100 < F.size(found) * 50,
        "C": F.char_length(F.regexp_replace(text, "[^A-Z]", "")) * 100 > F.char_length(text) * 2,
        "D": text.rlike("[#$%&*|]"),
    }


def _judged(docs: DataFrame) -> DataFrame:
    """One row per id, text and part: key, part, number of rows and the letters that its text fails."""
    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("rid"),
        F.coalesce("source", F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    digest = F.sha2(F.col("text"), 256)
    halves = (F.conv(F.substring(digest, k, 16), 16, -10).cast("long") for k in (1, 17))
    letters = [F.when(condition, F.lit(letter)) for letter, condition in failed(F.col("text")).items()]
    marked = texts.select(
        "rid", *(h.alias(c) for h, c in zip(halves, KEY[1:], strict=True)), "part", F.concat_ws("", *letters).alias("own")
    )
    return written(marked.groupBy(*KEY, "part", "own").agg(F.count(F.lit(1)).alias("n")), "audit-rows")


def _failing(rows: DataFrame) -> dict[str, DataFrame]:
    """The table of failing ids of each filter, a folder each."""
    has_id = F.col("rid") != NO_ID
    firsts = rows.where(has_id).groupBy("t1", "t2").agg(F.min("rid").alias("rid"))
    copies = rows.where(has_id).join(firsts, list(KEY), "left_anti").withColumn("filter", F.lit("E"))
    own = rows.withColumn("filter", F.explode(F.array_remove(F.split("own", ""), "")))
    columns = [*KEY, "filter"]
    ids = written(own.select(columns).unionByName(copies.select(columns)).distinct(), "audit-failing", "filter")
    return {f: ids.where(F.col("filter") == f).select(*KEY) for f in FILTERS}


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows with their counts: n, and n again where the id is labelled good or toxic."""
    wanted = labels.select(
        F.col("doc_id").cast("long").alias("rid"),
        F.coalesce(F.col("quality") == 1, F.lit(False)).alias("is_good"),
        F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("is_toxic"),
    ).where("rid IS NOT NULL AND (is_good OR is_toxic)")
    wanted = wanted.groupBy("rid").agg(F.max("is_good").alias("is_good"), F.max("is_toxic").alias("is_toxic"))
    counts = [
        F.when(F.col(f"is_{c}"), F.col("n")).otherwise(0).cast("long").alias(c) for c in ("good", "toxic")
    ]
    has_id = F.col("rid") != NO_ID
    none = rows.where(~has_id).withColumns({c: F.lit(0).cast("long") for c in COUNTS[1:]})
    known = rows.where(has_id).join(wanted, "rid", "left").select(*KEY, "part", "n", *counts)
    return known.unionByName(none.select(known.columns))


def _past(rows: DataFrame, failing: dict[str, DataFrame], filters: str) -> DataFrame:
    """The rows once for each set of ``filters`` that they survive, with the set as ``prefix``."""
    rows = rows.withColumn("prefix", F.lit(""))
    for f in filters:
        doubled = rows.withColumn("with", F.explode(F.array(F.lit(False), F.lit(True))))
        ids = failing[f].select(*(F.col(c).alias(f"_{c}") for c in KEY))
        same = reduce(lambda a, b: a & b, (F.col(c) == F.col(f"_{c}") for c in KEY))
        left = doubled.join(ids, same & F.col("with"), "left_anti")
        prefix = F.when(F.col("with"), F.concat("prefix", F.lit(f))).otherwise(F.col("prefix"))
        rows = left.withColumn("prefix", prefix).drop("with")
    return rows


def _sums(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(*(F.sum(c).alias(c) for c in COUNTS))


def prefixes(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, next ('' or a filter), prefix, n, good, toxic: the survivors of each set of filters (next is ''),
    and of these what the next filter removes. Sets that leave nothing have no row."""
    rows = _judged(docs)
    failing = {f: ids.repartition(*KEY) for f, ids in _failing(rows).items()}
    # Dealt by key here, since a join by id alone would leave all rows of one id together.
    labelled = written(_labelled(rows, labels), "audit-labelled").repartition(*KEY)
    found = [_sums(_past(labelled, failing, FILTERS), "part", "prefix").withColumn("next", F.lit(""))]
    for f in FILTERS:
        removed = _past(labelled.join(failing[f], list(KEY), "left_semi"), failing, FILTERS.replace(f, ""))
        found.append(_sums(removed, "part", "prefix").withColumn("next", F.lit(f)))
    return written(reduce(DataFrame.unionByName, found).select("part", "next", "prefix", *COUNTS), "audit-prefixes")


def _steps() -> Column:
    """All orders and their steps: order, step, filter, the sets before and after the step."""
    steps = [
        {
            "filter_order": order,
            "step": k + 1,
            "next": f,
            "before": "".join(sorted(order[:k])),
            "after": "".join(sorted(order[: k + 1])),
            "others": FILTERS.replace(f, ""),
        }
        for order in ORDERS
        for k, f in enumerate(order)
    ]
    kind = "array<struct<filter_order: string, step: int, next: string, before: string, after: string, others: string>>"
    return F.from_json(F.lit(json.dumps(steps)), kind)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step; see the contract's columns.

    shapley is what the step's filter removes, summed over all orders: each set of k filters before it
    stands for the k! (4 - k)! orders that begin with it.
    """
    found = prefixes(docs, labels)
    entry = F.struct(F.concat_ws(":", "next", "prefix"), F.struct(*COUNTS))
    by_part = found.groupBy("part").agg(F.map_from_entries(F.collect_list(entry)).alias("sums"))

    def of(next_: Column, prefix: Column, count: str = "n") -> Column:
        held = F.col("sums")[F.concat(next_, F.lit(":"), prefix)][count]
        return F.coalesce(held, F.lit(0)).cast("long")

    def shapley(f: str) -> Column:
        sets = (s for k in range(len(FILTERS)) for s in combinations(FILTERS.replace(f, ""), k))
        weighted = (
            of(F.lit(f), F.lit("".join(s))) * (factorial(len(s)) * factorial(len(FILTERS) - 1 - len(s))) for s in sets
        )
        return reduce(lambda a, b: a + b, weighted)

    shares = F.create_map(*(x for f in FILTERS for x in (F.lit(f), shapley(f))))
    steps = by_part.withColumn("shares", shares).withColumn("s", F.explode(_steps()))
    step, removed = F.col("s.next"), of(F.col("s.next"), F.col("s.before"))
    return steps.select(
        "part",
        F.col("s.filter_order").alias("filter_order"),
        F.col("s.step").alias("step"),
        of(F.lit(""), F.col("s.after")).alias("kept"),
        removed.alias("removed"),
        (of(step, F.lit("")) - removed).alias("redundant"),
        of(step, F.col("s.others")).alias("unique_fails"),
        of(step, F.col("s.before"), "good").alias("good_lost"),
        of(step, F.col("s.before"), "toxic").alias("toxic_lost"),
        F.col("shares")[step].alias("shapley"),
    )
