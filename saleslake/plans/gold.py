"""Business aggregates over flagged tables. Facts are reduced to their key before any join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from saleslake.functions.expressions import MONEY, money_average, week_start
from saleslake.operators.canonical import canonical, densify
from saleslake.operators.quality import PASS, RESULT
from saleslake.sources import lake
from saleslake.sources.lake import LakeConfig

# Segments by priority and the revenue from which a customer is High-Value.
SEGMENTS = (("Inactive", 1), ("High-Value", 2), ("Repeat", 3), ("One-Time", 4))
HIGH_VALUE_FROM = "1000.00"

TABLES = (
    "sales_by_product",
    "revenue_by_customer",
    "daily_trends",
    "weekly_trends",
    "customer_segmentation",
)


def qualifying(orders: DataFrame, *keys: str) -> DataFrame:
    """Completed orders that passed every check, with the named keys present."""
    present = [f"{key} IS NOT NULL" for key in keys]
    return orders.where(" AND ".join(["order_status = 'Completed'", f"{RESULT} = '{PASS}'", *present]))


def order_totals(orders: DataFrame, key: str) -> DataFrame:
    """Number and exact amount of orders per key."""
    return orders.groupBy(key).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("total_amount").cast(MONEY).alias("total_revenue"),
    )


def _average() -> Column:
    return money_average("total_revenue", "total_orders").alias("avg_order_value")


def all_totals(orders: DataFrame) -> DataFrame:
    """Number and exact amount of the qualifying orders per product, customer and day, from one scan.

    One aggregate over grouping sets: ``key_name`` says which of the three keys a row is about, the other two
    are NULL. Orders without a key count for the other keys only.
    """
    keys = ("product_id", "customer_id", "order_date")
    sets = qualifying(orders).groupingSets([[k] for k in keys], *keys).agg(
        F.grouping_id().alias("others"),
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("total_amount").cast(MONEY).alias("total_revenue"),
    )
    # the bits of the keys that a row is not about, the first key's bit being the highest
    alone = (F.when((F.col("others") == 7 - (4 >> k)) & F.col(key).isNotNull(), key) for k, key in enumerate(keys))
    return sets.select(F.coalesce(*alone).alias("key_name"), *keys, "total_orders", "total_revenue").where(
        "key_name IS NOT NULL"
    )


def totals_of(totals: DataFrame, key: str) -> DataFrame:
    """One key's part of ``all_totals``."""
    return totals.where(F.col("key_name") == key).select(key, "total_orders", "total_revenue")


def sales_by_product(orders: DataFrame, products: DataFrame) -> DataFrame:
    return sales_of(order_totals(qualifying(orders, "product_id"), "product_id"), products)


def sales_of(totals: DataFrame, products: DataFrame) -> DataFrame:
    """Sales of the products that occur in the totals per product."""
    names = canonical(products, "product_id", ["product_name", "category"])
    return totals.join(names, "product_id").select(
        "product_id", "product_name", "category", "total_orders", "total_revenue", _average()
    )


def _per_customer(orders: DataFrame) -> DataFrame:
    return order_totals(qualifying(orders, "customer_id"), "customer_id")


def _customer_totals(totals: DataFrame, customers: DataFrame, attributes: Sequence[str]) -> DataFrame:
    known = canonical(customers, "customer_id", attributes)
    return known.join(totals, "customer_id", "left").select(
        "customer_id",
        *attributes,
        F.expr("coalesce(total_orders, 0) AS total_orders"),
        F.expr(f"CAST(coalesce(total_revenue, 0) AS {MONEY}) AS total_revenue"),
    )


def revenue_by_customer(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return revenue_of(_per_customer(orders), customers)


def revenue_of(totals: DataFrame, customers: DataFrame) -> DataFrame:
    """Every canonical customer; those without qualifying orders have zeros and no average."""
    totals = _customer_totals(totals, customers, ["customer_name", "customer_segment"])
    return totals.select(
        *totals.columns, _average(), F.col("total_revenue").alias("lifetime_value_actual")
    )


def daily_trends(orders: DataFrame) -> DataFrame:
    return daily_of(order_totals(qualifying(orders, "order_date"), "order_date"))


def daily_of(totals: DataFrame) -> DataFrame:
    totals = totals.withColumnRenamed("order_date", "trend_date")
    return totals.select(*totals.columns, _average())


def weekly_of(daily: DataFrame) -> DataFrame:
    """Weeks from the daily trends; weeks are whole days, so the totals add up exactly."""
    totals = daily.groupBy(week_start(F.col("trend_date")).alias("week_start_date")).agg(
        F.sum("total_orders").alias("total_orders"),
        F.sum("total_revenue").cast(MONEY).alias("total_revenue"),
    )
    return totals.select(*totals.columns, _average())


def weekly_trends(orders: DataFrame) -> DataFrame:
    return weekly_of(daily_trends(orders))


def segment_of(orders: str, revenue: str) -> Column:
    """Segment of a customer: no order, then revenue, then number of orders."""
    return F.expr(
        f"CASE WHEN {orders} = 0 THEN 'Inactive' WHEN {revenue} >= {HIGH_VALUE_FROM} THEN 'High-Value' "
        f"WHEN {orders} >= 2 THEN 'Repeat' ELSE 'One-Time' END"
    )


def segment_domain(spark: SparkSession) -> DataFrame:
    return lake.relation(spark, list(SEGMENTS), "segment_type string, segment_priority int")


def segmentation_of(revenue: DataFrame) -> DataFrame:
    """Segments from the revenue per customer; always one row per segment, ordered by priority."""
    labelled = revenue.select(
        segment_of("total_orders", "total_revenue").alias("segment_type"),
        "total_revenue",
    )
    per_segment = labelled.groupBy("segment_type").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("total_revenue").alias("revenue")
    )
    dense = densify(segment_domain(revenue.sparkSession), per_segment, "segment_type").selectExpr(
        "segment_type",
        "segment_priority",
        "coalesce(customers, 0) AS customer_count",
        f"CAST(coalesce(revenue, 0) AS {MONEY}) AS total_revenue",
    )
    return dense.orderBy("segment_priority").select(
        "segment_type",
        "customer_count",
        money_average("total_revenue", "customer_count").alias("avg_revenue"),
        "total_revenue",
    )


def customer_segmentation(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return segmentation_of(_customer_totals(_per_customer(orders), customers, []))


def gold_frames(orders: DataFrame, customers: DataFrame, products: DataFrame) -> dict[str, DataFrame]:
    return {
        "sales_by_product": sales_by_product(orders, products),
        "revenue_by_customer": revenue_by_customer(orders, customers),
        "daily_trends": daily_trends(orders),
        "weekly_trends": weekly_trends(orders),
        "customer_segmentation": customer_segmentation(orders, customers),
    }


def build_gold(spark: SparkSession, config: LakeConfig) -> dict[str, int]:
    """Full refresh of the five tables from the flagged layer; rows per table as read back.

    One scan of the orders: their totals per product, customer and day are written once (one row per key), and
    the tables are built from those; weeks and segments from the staged days and customers. All five replace the
    old tables together.
    """
    lake.recover(spark, config, "silver", "gold")
    silver = {t: lake.read_table(spark, config, "silver", t) for t in ("orders", "customers", "products")}
    orders, customers, products = (silver[t] for t in ("orders", "customers", "products"))
    staged: dict[str, str] = {}
    scratch: list[str] = []

    def stage(table: str, frame: DataFrame) -> DataFrame:
        staged[config.table("gold", table)] = lake.stage_table(spark, frame, config, "gold", table)
        return spark.table(staged[config.table("gold", table)])

    try:
        scratch.append(lake.stage_table(spark, all_totals(orders), config, "gold", "order_totals", by="key_name"))
        per_product, per_customer, per_day = (
            totals_of(spark.table(scratch[0]), key) for key in ("product_id", "customer_id", "order_date")
        )
        sales = stage("sales_by_product", sales_of(per_product, products))
        revenue = stage("revenue_by_customer", revenue_of(per_customer, customers))
        daily = stage("daily_trends", daily_of(per_day))
        weekly = stage("weekly_trends", weekly_of(daily))
        segments = stage("customer_segmentation", segmentation_of(revenue))
        frames = zip(TABLES, (sales, revenue, daily, weekly, segments), strict=True)
        rows = {table: frame.count() for table, frame in frames}
        lake.swap(spark, staged)
    except Exception:
        lake.drop_tables(spark, list(staged.values()))
        raise
    finally:
        lake.drop_tables(spark, scratch)
    return rows
