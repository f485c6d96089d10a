"""Queries per business aggregate and per dashboard query."""

from __future__ import annotations

from pyspark.sql import functions as F

from saleslake.plans import checks, gold, serving
from saleslake.registry import oracle
from saleslake.registry.catalog import Catalog, scratch
from saleslake.sources import lake, testdata as td
from saleslake.sources.lake import LakeConfig

catalog = Catalog()
query = catalog.query


def sales(spark, d):
    return gold.sales_by_product(td.silver(spark, d, "orders"), td.products(spark, d))


def revenue(spark, d):
    return gold.revenue_by_customer(td.silver(spark, d, "orders"), td.customers(spark, d))


def segments(spark, d):
    return gold.customer_segmentation(td.silver(spark, d, "orders"), td.customers(spark, d))


@query("g_sales_by_product", oracle.query("SELECT * FROM gold_sales"))
def _(spark, d):
    return sales(spark, d)


@query("g_revenue_by_customer", oracle.query("SELECT * FROM gold_revenue"))
def _(spark, d):
    return revenue(spark, d)


@query("g_daily_trends", oracle.query("SELECT * FROM gold_daily"))
def _(spark, d):
    return gold.daily_trends(td.silver(spark, d, "orders"))


@query("g_weekly_trends", oracle.query("SELECT * FROM gold_weekly"))
def _(spark, d):
    return gold.weekly_trends(td.silver(spark, d, "orders"))


@query("g_customer_segmentation", oracle.query("SELECT * FROM gold_segments"))
def _(spark, d):
    return segments(spark, d)


@query(
    "g_build",
    oracle.query(
        "SELECT 'sales_by_product' AS table_name, count(*) AS n_rows FROM gold_sales UNION ALL "
        "SELECT 'revenue_by_customer', count(*) FROM gold_revenue UNION ALL "
        "SELECT 'daily_trends', count(*) FROM gold_daily UNION ALL "
        "SELECT 'weekly_trends', count(*) FROM gold_weekly UNION ALL "
        "SELECT 'customer_segmentation', count(*) FROM gold_segments"
    ),
)
def _(spark, d):
    place = scratch(spark, "gold")
    mark = place[-8:]
    config = LakeConfig(silver=f"flagged_{mark}", gold=f"business_{mark}", location=place)
    for table, frame in td.flagged(spark, d).items():
        lake.overwrite_table(spark, frame, config, "silver", table)
    gold.build_gold(spark, config)
    counts = [
        lake.read_table(spark, config, "gold", t)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(t).alias("table_name"), "n_rows")
        for t in gold.TABLES
    ]
    return checks.union(counts)


_TOP = "SELECT product_id, product_name, category, total_revenue, total_orders FROM gold_sales"


@query("d_top_products", oracle.query(f"{_TOP} ORDER BY total_revenue DESC, product_id LIMIT 10"))
def _(spark, d):
    return serving.top_products(sales(spark, d))


@query(
    "d_top_products_in_category",
    oracle.query(f"{_TOP} WHERE category = 'ECONOMY' ORDER BY total_revenue DESC, product_id LIMIT 10"),
)
def _(spark, d):
    return serving.top_products_sql(sales(spark, d), "ECONOMY")


_DISTRIBUTION = "SELECT customer_id, customer_segment, lifetime_value_actual FROM gold_revenue"


@query("d_revenue_distribution", oracle.query(f"{_DISTRIBUTION} ORDER BY customer_id"))
def _(spark, d):
    return serving.revenue_distribution(revenue(spark, d))


@query("d_revenue_distribution_in_segment", oracle.query(f"{_DISTRIBUTION} WHERE customer_segment = 'MACHINERY'"))
def _(spark, d):
    return serving.revenue_distribution(revenue(spark, d), "MACHINERY")


@query("d_segment_counts", oracle.query("SELECT segment_type, customer_count FROM gold_segments"))
def _(spark, d):
    return serving.segment_counts(segments(spark, d))


@query("d_filter_category", oracle.query("SELECT DISTINCT category FROM gold_sales"))
def _(spark, d):
    return serving.filter_values(sales(spark, d), "category")


@query("d_filter_segment", oracle.query("SELECT DISTINCT customer_segment FROM gold_revenue"))
def _(spark, d):
    return serving.filter_values(revenue(spark, d), "customer_segment")


@query(
    "d_revenue_histogram",
    oracle.query(
        "SELECT CAST(floor(lifetime_value_actual / 30) * 30 AS BIGINT) AS bin_start, count(*) AS customers "
        "FROM gold_revenue GROUP BY 1"
    ),
)
def _(spark, d):
    return serving.revenue_histogram(revenue(spark, d))
