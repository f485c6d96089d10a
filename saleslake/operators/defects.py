"""Planting a known number of defects in clean data, to test the rules at any scale.

Rows are picked by the order of md5(seed:id), which every engine computes alike. Ranking does not
sort the table: the first four hex digits split it into 65,536 even buckets, their counts tell
which buckets the wanted ranks fall in, and only those buckets are shuffled and numbered.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from saleslake.errors import QualityError
from saleslake.operators.lookup import MAX_BROADCAST_ROWS

BUCKET_DIGITS = 4


def pick_order(id_column: str, seed: int) -> Column:
    """The pseudo-random sort key of a row."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_column).cast("string")))


def ranked(df: DataFrame, id_column: str, seed: int, first: int, last: int) -> DataFrame:
    """id and rank (1-based) of the rows ranked first..last. ``id_column`` has to be unique.

    ``last`` must not exceed the number of rows.
    """
    order = pick_order(id_column, seed)
    keyed = df.select(F.col(id_column), order.alias("_order")).withColumn(
        "_bucket", F.substring("_order", 1, BUCKET_DIGITS)
    )
    sizes = keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"))
    before, rank_before = [], 0
    # at most 16 ** BUCKET_DIGITS rows, whatever the size of the table
    for row in sorted(sizes.collect()):
        if rank_before < last and rank_before + row["n"] >= first:
            before.append((row["_bucket"], rank_before))
        rank_before += row["n"]
    if last > rank_before:
        raise QualityError(f"cannot pick rank {last} out of {rank_before} rows")
    offsets = df.sparkSession.createDataFrame(before, "_bucket string, _before bigint")
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy("_order", id_column))
    return (
        keyed.join(F.broadcast(offsets), "_bucket")
        .select(id_column, (F.col("_before") + within).alias("rank"))
        .where(F.col("rank").between(first, last))
    )


def _with_rank(df: DataFrame, id_column: str, seed: int, first: int, last: int) -> DataFrame:
    picked = ranked(df, id_column, seed, first, last).select(
        F.col(id_column).alias("_picked"), F.col("rank").alias("_rank")
    )
    if last - first < MAX_BROADCAST_ROWS:
        picked = F.broadcast(picked)
    return df.join(picked, F.col(id_column) == F.col("_picked"), "left").drop("_picked")


def _replace(
    df: DataFrame, column: str, value: Column, id_column: str, seed: int, first: int, count: int
) -> DataFrame:
    columns = df.columns
    kind = df.schema[column].dataType
    marked = _with_rank(df, id_column, seed, first, first + count - 1)
    changed = F.when(F.col("_rank").isNotNull(), value.cast(kind)).otherwise(F.col(column))
    return marked.withColumn(column, changed).select(*columns)


def null_out(df: DataFrame, column: str, count: int, *, id_column: str, seed: int, first: int = 1) -> DataFrame:
    """Exactly ``count`` rows lose their value."""
    return _replace(df, column, F.lit(None), id_column, seed, first, count)


def orphan_out(
    df: DataFrame, column: str, count: int, namespace: int, *, id_column: str, seed: int, first: int = 1
) -> DataFrame:
    """Exactly ``count`` rows point to namespace, namespace + 1, ... instead of a real parent."""
    target = F.lit(namespace) + F.col("_rank") - F.lit(first)
    return _replace(df, column, target, id_column, seed, first, count)


def future_out(
    df: DataFrame, column: str, count: int, as_of: date, *, id_column: str, seed: int, first: int = 1
) -> DataFrame:
    """Exactly ``count`` rows get the days as_of + 1 .. as_of + count."""
    day = F.date_add(F.lit(as_of), (F.col("_rank") - F.lit(first) + 1).cast("int"))
    return _replace(df, column, day, id_column, seed, first, count)


def copy_rows(df: DataFrame, count: int, *, id_column: str, seed: int, first: int = 1) -> DataFrame:
    """All rows, and ``count`` of them a second time."""
    columns = df.columns
    marked = _with_rank(df, id_column, seed, first, first + count - 1)
    times = F.when(F.col("_rank").isNotNull(), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return marked.withColumn("_copy", F.explode(times)).select(*columns)


def disjoint_ranges(*counts: int) -> list[int]:
    """First ranks of consecutive, never overlapping rank ranges of the given lengths."""
    starts, position = [], 1
    for count in counts:
        starts.append(position)
        position += count
    return starts
