"""Queries a dashboard asks of the business aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from saleslake.functions.expressions import MONEY, bin_floor, equals_or_any

TOP = 10
BIN_WIDTH = 30


def top_products(sales: DataFrame, category: str | None = None, n: int = TOP) -> DataFrame:
    """Best products by revenue, lower id first among ties; the category filter acts before the limit."""
    return (
        sales.where(equals_or_any(F.col("category"), category))
        .orderBy(F.col("total_revenue").desc(), F.col("product_id").asc())
        .limit(n)
        .select("product_id", "product_name", "category", "total_revenue", "total_orders")
    )


TOP_PRODUCTS_SQL = """
SELECT product_id, product_name, category, total_revenue, total_orders
FROM {sales}
WHERE :category IS NULL OR category <=> :category
ORDER BY total_revenue DESC, product_id ASC
LIMIT 10
"""


def top_products_sql(sales: DataFrame, category: str | None = None) -> DataFrame:
    """The same as parameterised SQL; the value is bound, never pasted into the text."""
    return sales.sparkSession.sql(TOP_PRODUCTS_SQL, args={"category": category}, sales=sales)


def revenue_distribution(customers: DataFrame, segment: str | None = None) -> DataFrame:
    """One row per customer, zero revenue included."""
    return (
        customers.where(equals_or_any(F.col("customer_segment"), segment))
        .select("customer_id", "customer_segment", "lifetime_value_actual")
        .orderBy("customer_id")
    )


def segment_counts(segmentation: DataFrame) -> DataFrame:
    return segmentation.select("segment_type", "customer_count")


def filter_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values for a drop-down, NULL last."""
    return df.select(column).distinct().orderBy(F.col(column).asc_nulls_last())


def value_counts(df: DataFrame, column: str, chosen: str | None = None) -> DataFrame:
    """Rows per filter value that match a chosen value; all rows match when nothing is chosen."""
    matches = equals_or_any(F.col(column), chosen)
    return df.groupBy(column).agg(F.count_if(matches).alias("matching_rows"))


def revenue_histogram(customers: DataFrame, segment: str | None = None, width: int = BIN_WIDTH) -> DataFrame:
    """Customers per revenue bin; customers without revenue are in bin 0."""
    return (
        customers.where(equals_or_any(F.col("customer_segment"), segment))
        .groupBy(bin_floor(F.col("lifetime_value_actual"), width).alias("bin_start"))
        .agg(F.count(F.lit(1)).alias("customers"))
    )


def measure_by(df: DataFrame, dimension: str, measure: str) -> DataFrame:
    """What a chart plots: the sum of a measure per dimension value."""
    total = F.sum(measure)
    if dict(df.dtypes)[measure].startswith("decimal"):
        total = total.cast(MONEY)
    return df.groupBy(dimension).agg(total.alias(measure))
