"""One row per business key: the earliest landed row wins, quality flags play no part."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import (
    BooleanType, DataType, DateType, DecimalType, NumericType, TimestampNTZType, TimestampType,
)

from saleslake.sources.contracts import ROW_ID


def canonical(df: DataFrame, key: str, attributes: Sequence[str], row_id: str = ROW_ID) -> DataFrame:
    """key + attributes of the row with the smallest row id, for every non-null key. Row ids are unique.

    Aggregates instead of a ranking window: they combine map-side, so even a key with very many copies reaches the
    reducer as one row per map task. Attributes of fixed width go with the row id through one hash aggregate. Texts
    would turn it into a sort: then the smallest row id of each key comes first, and a semi join on key
    and row id fetches that row's texts once.
    """
    known = df.where(F.col(key).isNotNull())
    by_key = known.groupBy(key)
    if all(_fixed_width(df.schema[a].dataType) for a in attributes):
        found = by_key.agg(F.min(row_id).alias("_first"), *[F.min_by(a, row_id).alias(a) for a in attributes])
        return found.select(key, *attributes)
    first = by_key.agg(F.min(row_id).alias("_first_id")).withColumnRenamed(key, "_first_key")
    match = (F.col(key) == F.col("_first_key")) & (F.col(row_id) == F.col("_first_id"))
    return known.join(first, match, "left_semi").select(key, *attributes)


def _fixed_width(kind: DataType) -> bool:
    """Whether a value of the type can be changed in place in an aggregation buffer."""
    if isinstance(kind, DecimalType):
        return kind.precision <= 18
    return isinstance(kind, (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType))


def canonical_by_rank(df: DataFrame, key: str, attributes: Sequence[str], row_id: str = ROW_ID) -> DataFrame:
    """The ranking-window form of :func:`canonical`; Spark prunes each task to the first row."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(row_id))
    return (
        df.where(F.col(key).isNotNull())
        .withColumn("_rank", rank)
        .where(F.col("_rank") == 1)
        .select(key, *attributes)
    )


def densify(domain: DataFrame, aggregated: DataFrame, on: str) -> DataFrame:
    """Left join of a literal domain with already aggregated rows, so empty buckets appear.

    Aggregating first keeps the join at the size of the domain; joining the raw rows would shuffle
    them onto a handful of bucket values.
    """
    return domain.join(aggregated, on, "left")
