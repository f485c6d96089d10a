"""Multiset comparison of two frames, and profiles of defects."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows whose multiplicity differs, with the surplus on each side.

    Both directions of EXCEPT ALL in one grouping that combines map-side; surplus copies stay a
    number instead of being repeated as rows.
    """
    columns = left.columns
    signed = left.select(*columns, F.lit(1).alias("_n")).unionAll(
        right.select(*columns, F.lit(-1).alias("_n"))
    )
    balance = signed.groupBy(*columns).agg(F.sum("_n").alias("_n")).where(F.col("_n") != 0)
    return balance.select(
        *columns,
        F.greatest(F.col("_n"), F.lit(0)).alias("only_left"),
        F.greatest(-F.col("_n"), F.lit(0)).alias("only_right"),
    )


def difference_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: surplus rows on the left and on the right; both zero for equal multisets."""
    return multiset_difference(left, right).agg(
        F.coalesce(F.sum("only_left"), F.lit(0)).alias("only_left"),
        F.coalesce(F.sum("only_right"), F.lit(0)).alias("only_right"),
    )


def bucket_of(columns: Sequence[str], buckets: int) -> Column:
    """The bucket of a row by the values of some columns; equal rows share one."""
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).alias("_bucket")


def bucket_digests(df: DataFrame, columns: Sequence[str], digest: Column, buckets: int) -> DataFrame:
    """Rows and an order-insensitive digest of each bucket: a small aggregate, combined map-side."""
    return df.groupBy(bucket_of(columns, buckets)).agg(F.count(F.lit(1)).alias("rows"), F.sum(digest).alias("digest"))


def differing_buckets(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row from two sides' ``bucket_digests``: rows of each, and the buckets that differ."""
    a, b = left.alias("a"), right.alias("b")
    same = F.col("a.rows").eqNullSafe(F.col("b.rows")) & F.col("a.digest").eqNullSafe(F.col("b.digest"))
    return a.join(b, "_bucket", "full").agg(
        F.coalesce(F.sum("a.rows"), F.lit(0)).alias("rows_left"),
        F.coalesce(F.sum("b.rows"), F.lit(0)).alias("rows_right"),
        F.collect_list(F.when(~same, F.col("_bucket"))).alias("buckets"),
    )


def bucket_difference(
    left: DataFrame, right: DataFrame, columns: Sequence[str], buckets: int, chosen: Sequence[int]
) -> DataFrame:
    """``multiset_difference`` of the rows in the chosen buckets, which are all that is shuffled."""
    here = bucket_of(columns, buckets).isin(list(chosen))
    return multiset_difference(left.where(here).select(*columns), right.where(here).select(*columns))


def in_order(df: DataFrame, *order: tuple[str, bool]) -> DataFrame:
    """One row: rows of a full sorted result, inversions, and whether it comes in the order.

    ``order`` names columns with True for descending; NULLs come first when ascending and last when
    descending, as in Spark. Rows are compared with their predecessor within each range partition, and the last row
    of a partition with the first of the next that has rows; only the sort columns are shuffled, and no task
    holds more than one of the partitions of the sort.
    """
    names = [name for name, _ in order]
    placed = df.select(F.struct(*names).alias("_k"), F.monotonically_increasing_id().alias("_place"))
    parts = placed.withColumn("_part", F.shiftright("_place", 33))
    before = F.lag("_k").over(Window.partitionBy("_part").orderBy("_place"))
    ranges = (
        parts.withColumn("_wrong", _after(before, F.col("_k"), order))
        .groupBy("_part")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if("_wrong").alias("wrong"),
            F.min_by("_k", "_place").alias("first"),
            F.max_by("_k", "_place").alias("last"),
        )
    )
    last = F.lag("last").over(Window.orderBy("_part"))  # one row per partition of the sort
    crossed = ranges.withColumn("wrong", F.col("wrong") + _after(last, F.col("first"), order).cast("long"))
    wrong = F.coalesce(F.sum("wrong"), F.lit(0))
    return crossed.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), wrong.alias("inversions"), (wrong == 0).alias("ordered")
    )


def _after(a: Column, b: Column, order: Sequence[tuple[str, bool]]) -> Column:
    """Whether key struct ``a`` belongs behind ``b``; no ``a`` (NULL) belongs behind nothing."""
    found = F.lit(False)
    for name, descending in reversed(order):
        x, y = (b[name], a[name]) if descending else (a[name], b[name])
        greater = F.coalesce(x > y, x.isNotNull() & y.isNull())
        found = greater | (x.eqNullSafe(y) & found)
    return a.isNotNull() & found


def _entries(wide: DataFrame) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("check_name"), F.col(c).alias("rows")) for c in wide.columns]
    return wide.select(F.inline(F.array(*pairs)))


# Profile entries as SQL over one row per (kind, key) with its references, parents and future dates. Kinds are numbers:
# with keys of a fixed width, a grouped key takes less memory than with a text. What is only counted over all customers
# are references to NULL of two more kinds, and no sums that every key would carry.
_CUSTOMER, _ORDER, _PRODUCT, _NO_EMAIL, _FUTURE_NO_EMAIL = (f"kind = {k}" for k in range(1, 6))
_PROFILE = {
    "customers.rows": f"sum(CASE WHEN {_CUSTOMER} THEN parents END)",
    "customers.null_email": f"sum(CASE WHEN {_NO_EMAIL} THEN refs END)",
    "customers.future_signups": "sum(futures)",
    "customers.future_and_null_email": f"sum(CASE WHEN {_FUTURE_NO_EMAIL} THEN refs END)",
    "customers.future_and_duplicate": f"count_if({_CUSTOMER} AND id IS NOT NULL AND parents > 1 AND futures > 0)",
    "customers.duplicate_keys": f"count_if({_CUSTOMER} AND id IS NOT NULL AND parents > 1)",
    "customers.duplicate_rows": f"sum(CASE WHEN {_CUSTOMER} AND id IS NOT NULL AND parents > 1 THEN parents END)",
    "orders.rows": f"sum(CASE WHEN {_ORDER} THEN refs END)",
    "orders.null_customer_id": f"sum(CASE WHEN {_CUSTOMER} AND id IS NULL THEN refs END)",
    "orders.null_product_id": f"sum(CASE WHEN {_PRODUCT} AND id IS NULL THEN refs END)",
    "orders.duplicate_keys": f"count_if({_ORDER} AND id IS NOT NULL AND refs > 1)",
    "orders.duplicate_rows": f"sum(CASE WHEN {_ORDER} AND id IS NOT NULL AND refs > 1 THEN refs END)",
    "orders.orphan_customer_id": f"sum(CASE WHEN {_CUSTOMER} AND id IS NOT NULL AND parents = 0 THEN refs END)",
    "orders.orphan_product_id": f"sum(CASE WHEN {_PRODUCT} AND id IS NOT NULL AND parents = 0 THEN refs END)",
    "products.rows": f"sum(CASE WHEN {_PRODUCT} THEN parents END)",
}


def profile(customers: DataFrame, orders: DataFrame, products: DataFrame, as_of: date) -> DataFrame:
    """check_name, rows: row counts, NULLs, duplicates, orphans, future dates.

    Every table is read once and nothing is joined: orders refer to keys, customers and products
    are keys, and one grouping by (kind, key) that combines map-side brings both together.
    """
    future = f"coalesce(signup_date > DATE'{as_of}', false)"
    keys = [
        orders.selectExpr(
            "inline(array(struct(2 AS kind, order_id AS id), struct(1 AS kind, customer_id AS id), "
            "struct(3 AS kind, product_id AS id)))"
        ).selectExpr("kind", "id", "1 AS ref", "0 AS parent", "0 AS future"),
        customers.selectExpr("customer_id", f"CAST({future} AS int) AS future", "CAST(email IS NULL AS int) AS absent")
        .selectExpr(
            "inline(array(struct(1 AS kind, customer_id AS id, 0 AS ref, 1 AS parent, future), "
            "struct(4 AS kind, NULL AS id, absent AS ref, 0 AS parent, 0 AS future), "
            "struct(5 AS kind, NULL AS id, absent * future AS ref, 0 AS parent, 0 AS future)))"
        ),
        products.selectExpr("3 AS kind", "product_id AS id", "0 AS ref", "1 AS parent", "0 AS future"),
    ]
    sums = [F.sum(c).alias(f"{c}s") for c in ("ref", "parent", "future")]
    per_key = reduce(DataFrame.unionAll, keys).groupBy("kind", "id").agg(*sums)
    wide = per_key.agg(*[F.expr(f"coalesce({text}, 0) AS `{name}`") for name, text in _PROFILE.items()])
    pairs = ", ".join(f"struct('{name}' AS check_name, `{name}` AS rows)" for name in _PROFILE)
    return wide.selectExpr(f"inline(array({pairs}))")


# The profile entries that add up to the mandatory issue instances.
ISSUE_CHECKS = (
    "customers.null_email",
    "customers.duplicate_keys",
    "orders.null_customer_id",
    "orders.null_product_id",
    "orders.orphan_customer_id",
    "orders.orphan_product_id",
    "orders.duplicate_keys",
)


# The profile of the seed-42 sales data set.
SEED_42_PROFILE = {
    "customers.rows": 10_010,
    "customers.null_email": 50,
    "customers.duplicate_keys": 10,
    "customers.duplicate_rows": 20,
    "customers.future_signups": 30,
    "customers.future_and_null_email": 0,
    "customers.future_and_duplicate": 0,
    "orders.rows": 100_020,
    "orders.null_customer_id": 100,
    "orders.null_product_id": 200,
    "orders.duplicate_keys": 20,
    "orders.duplicate_rows": 40,
    "orders.orphan_customer_id": 50,
    "orders.orphan_product_id": 30,
    "products.rows": 500,
    "issue_instances": 460,
}


def issue_instances(profiled: DataFrame) -> DataFrame:
    """One row: the total of the mandatory issue classes."""
    wanted = profiled.where(F.col("check_name").isin(*ISSUE_CHECKS))
    return wanted.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("issue_instances"))


def inexact_copies(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Keys whose copies are not identical in ``columns``: key, copies, versions.

    Grouping by key and row digest first combines map-side, so many identical copies of one key
    shrink to one row per task before anything is shuffled.
    """
    nulls = F.array(*[F.col(c).isNull() for c in columns])
    versions = (
        df.where(F.col(key).isNotNull())
        .groupBy(key, F.xxhash64(*columns, nulls).alias("_version"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    per_key = versions.groupBy(key).agg(
        F.sum("_n").alias("copies"), F.count(F.lit(1)).alias("versions")
    )
    return per_key.where(F.col("versions") > 1)


def overlaps(df: DataFrame, classes: dict[str, Column]) -> DataFrame:
    """pair, rows: how many rows two defect classes share, for every pair of classes."""
    names = list(classes)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    return _entries(
        df.agg(*[F.count_if(classes[a] & classes[b]).alias(f"{a}+{b}") for a, b in pairs])
    ).withColumnRenamed("check_name", "pair")
