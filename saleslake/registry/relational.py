"""Queries per relational operator: projections, filters, joins, aggregates, windows, sorts, sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from saleslake.errors import QualityError
from saleslake.functions import expressions as E
from saleslake.operators import canonical, compare, lookup, metrics, quality, rules
from saleslake.plans import checks, gold, serving
from saleslake.registry import oracle
from saleslake.registry.catalog import Catalog, landed, row_count
from saleslake.sources import testdata as td
from saleslake.sources.contracts import ORDERS, ROW_ID

catalog = Catalog()
query = catalog.query


def _sales(spark: SparkSession, d: str) -> DataFrame:
    return gold.sales_by_product(td.silver(spark, d, "orders"), td.products(spark, d))


def _orders_and_flagged(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The orders before and after flagging. Every pass over either reads the same landed rows."""
    tables = td.raw(spark, d)
    tables["orders"] = landed(spark, tables["orders"], "orders")
    return tables["orders"], td.silver(spark, d, "orders", tables)


def _revenue(spark: SparkSession, d: str) -> DataFrame:
    return gold.revenue_by_customer(td.silver(spark, d, "orders"), td.customers(spark, d))


# --- projections, filters, predicates -------------------------------------------------------


@query(
    "p_project_alias",
    oracle.query("SELECT product_id AS id, product_name AS name, price AS list_price FROM raw_products"),
)
def _(spark, d):
    return td.products(spark, d).select(
        F.col("product_id").alias("id"), F.col("product_name").alias("name"), F.col("price").alias("list_price")
    )


@query(
    "p_derive_drop",
    oracle.query("SELECT product_id, CAST(price - cost AS DECIMAL(18,2)) AS margin FROM raw_products"),
)
def _(spark, d):
    wide = td.products(spark, d).withColumns({"_m": F.col("price") - F.col("cost")})
    return wide.withColumn("margin", F.col("_m").cast(E.MONEY)).select("product_id", "margin", "_m").drop("_m")


@query(
    "p_source_projection",
    oracle.query(
        "SELECT customer_id, customer_name, email, country, signup_date, customer_segment, lifetime_value, "
        "row_id AS _ingest_row_id FROM raw_customers"
    ),
)
def _(spark, d):
    flagged = td.silver(spark, d, "customers")
    return flagged.select(*quality.source_columns(flagged))


@query(
    "p_required_columns",
    oracle.query(
        "SELECT 'complete' AS variant, TRUE AS accepted, count(*) AS n_rows FROM raw_products "
        "UNION ALL SELECT 'without_row_id', FALSE, count(*) FROM raw_products "
        "UNION ALL SELECT 'without_price', FALSE, count(*) FROM raw_products"
    ),
)
def _(spark, d):
    products = td.products(spark, d)
    variants = {
        "complete": products,
        "without_row_id": products.drop(ROW_ID),
        "without_price": products.drop("price"),
    }
    frames = []
    for name, df in variants.items():
        try:
            df = quality.apply_modules(df, "products", [rules.TYPE])
            accepted = True
        except QualityError:
            accepted = False
        frames.append(
            df.agg(row_count("n_rows")).select(
                F.lit(name).alias("variant"), F.lit(accepted).alias("accepted"), "n_rows"
            )
        )
    return checks.union(frames)


@query(
    "p_is_null",
    oracle.query(
        "SELECT order_status, count(*) FILTER (WHERE payment_date IS NULL) AS unpaid, "
        "count(*) FILTER (WHERE payment_date IS NOT NULL) AS paid FROM raw_orders GROUP BY 1"
    ),
)
def _(spark, d):
    paid = F.col("payment_date")
    return td.orders(spark, d).groupBy("order_status").agg(
        F.count_if(paid.isNull()).alias("unpaid"), F.count_if(paid.isNotNull()).alias("paid")
    )


@query(
    "p_domain",
    oracle.query(
        "SELECT customer_id, customer_segment FROM raw_customers WHERE customer_segment "
        "NOT IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY', 'FURNITURE')"
    ),
)
def _(spark, d):
    return (
        td.customers(spark, d)
        .where(E.outside("customer_segment", td.SEGMENTS))
        .select("customer_id", "customer_segment")
    )


@query(
    "p_compare",
    oracle.query(
        "SELECT count(*) FILTER (WHERE quantity < 5) AS lt, count(*) FILTER (WHERE quantity <= 5) AS le, "
        "count(*) FILTER (WHERE unit_price > 1000) AS gt, count(*) FILTER (WHERE unit_price >= 1000) AS ge, "
        "count(*) FILTER (WHERE payment_date = order_date) AS eq FROM raw_orders"
    ),
)
def _(spark, d):
    q, p = F.col("quantity"), F.col("unit_price")
    tests = {
        "lt": q < 5,
        "le": q <= 5,
        "gt": p > 1000,
        "ge": p >= 1000,
        "eq": F.col("payment_date") == F.col("order_date"),
    }
    return td.orders(spark, d).agg(*[F.count_if(E.truth(t)).alias(n) for n, t in tests.items()])


@query(
    "p_case",
    oracle.query(
        "SELECT customer_id, CASE WHEN total_orders = 0 THEN 'Inactive' WHEN total_revenue >= 1000 THEN 'High-Value' "
        "WHEN total_orders >= 2 THEN 'Repeat' ELSE 'One-Time' END AS segment_type FROM customer_full"
    ),
)
def _(spark, d):
    return _revenue(spark, d).select(
        "customer_id",
        gold.segment_of("total_orders", "total_revenue").alias("segment_type"),
    )


@query(
    "p_coalesce",
    oracle.query(
        "SELECT customer_id, coalesce(email, 'unknown') AS email, len([]) AS codes FROM raw_customers"
    ),
)
def _(spark, d):
    return td.customers(spark, d).select(
        "customer_id",
        F.coalesce("email", F.lit("unknown")).alias("email"),
        F.size(F.coalesce(F.lit(None).cast(E.CODES), E.no_codes())).cast("bigint").alias("codes"),
    )


@query(
    "p_nullif",
    oracle.query(
        "SELECT quantity, NULLIF(quantity, 0) AS divisor, count(*) AS n_rows FROM raw_orders GROUP BY 1, 2"
    ),
)
def _(spark, d):
    return (
        td.orders(spark, d)
        .groupBy("quantity", F.nullif("quantity", F.lit(0)).alias("divisor"))
        .agg(row_count("n_rows"))
    )


@query(
    "p_cast",
    "SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, "
    "CAST(l_quantity AS BIGINT) AS quantity, CAST(l_shipdate AS DATE) AS ship_date FROM lineitem",
)
def _(spark, d):
    return td.table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("l_extendedprice").cast(E.MONEY).alias("amount"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
    )


@query(
    "p_qualifying",
    oracle.query(
        "SELECT count(*) AS orders, CAST(sum(total_amount) AS DECIMAL(18,2)) AS revenue FROM silver_orders "
        f"WHERE {oracle.QUALIFYING} AND product_id IS NOT NULL"
    ),
)
def _(spark, d):
    kept = gold.qualifying(td.silver(spark, d, "orders"), "product_id")
    return kept.agg(row_count("orders"), F.sum("total_amount").cast(E.MONEY).alias("revenue"))


@query(
    "p_optional_filter",
    oracle.query(
        "SELECT * FROM (SELECT 'all' AS variant, product_id, category, total_revenue, total_orders FROM gold_sales "
        "ORDER BY total_revenue DESC, product_id LIMIT 10) "
        "UNION ALL SELECT * FROM (SELECT 'SMALL', product_id, category, total_revenue, total_orders FROM gold_sales "
        "WHERE category = 'SMALL' ORDER BY total_revenue DESC, product_id LIMIT 10)"
    ),
)
def _(spark, d):
    sales = _sales(spark, d)
    frames = [
        serving.top_products_sql(sales, wanted).withColumn("variant", F.lit(wanted or "all")).drop("product_name")
        for wanted in (None, "SMALL")
    ]
    return checks.union(frames)


@query(
    "p_segment_slice",
    oracle.query("SELECT customer_id, total_revenue FROM gold_revenue WHERE customer_segment = 'BUILDING'"),
)
def _(spark, d):
    return _revenue(spark, d).where(F.col("customer_segment") == "BUILDING").select("customer_id", "total_revenue")


@query(
    "p_negate",
    oracle.query("SELECT order_id, count(*) AS n_rows FROM silver_orders WHERE NOT (len(business_codes) = 0) GROUP BY 1"),
)
def _(spark, d):
    flagged = td.silver(spark, d, "orders").where(~F.col("business_logic_pass"))
    return flagged.groupBy("order_id").agg(row_count("n_rows"))


# --- joins ----------------------------------------------------------------------------------

_EXISTENCE = oracle.query(
    "SELECT customer_id, parent_customer IS NOT NULL AS known, count(*) AS n_rows FROM wide_orders GROUP BY 1, 2"
)


def _existence(spark: SparkSession, d: str, limit: int) -> DataFrame:
    parents = quality.customer_parents(td.customers(spark, d)).select(rules.CUSTOMER_KEY)
    joined = lookup.lookup(
        td.orders(spark, d),
        parents,
        "customer_id",
        rules.CUSTOMER_KEY,
        other_rows=td.customers(spark, d).count(),
        max_broadcast_rows=limit,
    )
    known = F.col(rules.CUSTOMER_KEY).isNotNull().alias("known")
    return joined.groupBy("customer_id", known).agg(row_count("n_rows"))


@query("j_existence", _EXISTENCE)
def _(spark, d):
    return _existence(spark, d, lookup.MAX_BROADCAST_ROWS)


@query("j_existence_salted", _EXISTENCE)
def _(spark, d):
    return _existence(spark, d, 0)


@query(
    "j_canonical_lookup",
    oracle.query(
        "SELECT order_status, parent_signup IS NULL AS without_signup, count(*) AS n_rows, "
        "min(parent_signup) AS first_signup, max(parent_signup) AS last_signup FROM wide_orders GROUP BY 1, 2"
    ),
)
def _(spark, d):
    customers = td.customers(spark, d)
    joined = lookup.lookup(
        td.orders(spark, d),
        quality.customer_parents(customers),
        "customer_id",
        rules.CUSTOMER_KEY,
        other_rows=customers.count(),
    )
    signup = F.col(rules.CUSTOMER_SIGNUP)
    return joined.groupBy("order_status", signup.isNull().alias("without_signup")).agg(
        row_count("n_rows"), F.min(signup).alias("first_signup"), F.max(signup).alias("last_signup")
    )


@query(
    "j_inner_dimension",
    oracle.query(
        "SELECT o.product_id, category, count(*) AS n_rows FROM raw_orders o "
        "JOIN first_products p ON o.product_id = p.product_id GROUP BY 1, 2"
    ),
)
def _(spark, d):
    counts = td.orders(spark, d).groupBy("product_id").agg(row_count("n_rows"))
    names = canonical.canonical(td.products(spark, d), "product_id", ["category"])
    return counts.join(names, "product_id").select("product_id", "category", "n_rows")


@query(
    "j_left_dimension",
    oracle.query(
        "SELECT c.customer_id, CAST(count(o.order_id) AS BIGINT) AS n_rows FROM first_customers c "
        "LEFT JOIN raw_orders o ON o.customer_id = c.customer_id GROUP BY 1"
    ),
)
def _(spark, d):
    known = canonical.canonical(td.customers(spark, d), "customer_id", [])
    counts = td.orders(spark, d).groupBy("customer_id").agg(row_count("n"))
    return known.join(counts, "customer_id", "left").select(
        "customer_id", F.coalesce("n", F.lit(0)).alias("n_rows")
    )


@query(
    "j_densify",
    oracle.query(
        "SELECT s.order_status, CAST(count(o.order_status) AS BIGINT) AS n_rows FROM "
        "(VALUES ('Pending'), ('Completed'), ('Cancelled'), ('Returned')) s(order_status) "
        "LEFT JOIN raw_orders o ON s.order_status = o.order_status GROUP BY 1"
    ),
)
def _(spark, d):
    domain = spark.createDataFrame([("Pending",), ("Completed",), ("Cancelled",), ("Returned",)], "order_status string")
    counts = td.orders(spark, d).groupBy("order_status").agg(row_count("n"))
    return canonical.densify(domain, counts, "order_status").select(
        "order_status", F.coalesce("n", F.lit(0)).alias("n_rows")
    )


@query(
    "j_anti",
    oracle.query(
        "SELECT o.customer_id, count(*) AS n_rows FROM raw_orders o WHERE o.customer_id IS NOT NULL "
        "AND NOT EXISTS (SELECT 1 FROM raw_customers c WHERE c.customer_id = o.customer_id) GROUP BY 1"
    ),
)
def _(spark, d):
    found = lookup.orphan_counts(td.orders(spark, d), "customer_id", td.customers(spark, d), "customer_id")
    return found.withColumnRenamed("rows", "n_rows")


@query(
    "j_semi",
    oracle.query(
        "SELECT order_id, CAST(count(*) AS BIGINT) AS n_rows FROM raw_orders WHERE order_id IN "
        "(SELECT order_id FROM raw_orders WHERE order_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1) GROUP BY 1"
    ),
)
def _(spark, d):
    orders = td.orders(spark, d)
    counts = orders.groupBy("order_id").agg(row_count("n_rows"))
    return counts.join(lookup.duplicated_keys(orders, "order_id"), "order_id", "left_semi")


@query(
    "j_no_fanout",
    oracle.query("SELECT count(*) AS rows_before, count(*) AS rows_after, TRUE AS same FROM raw_orders"),
)
def _(spark, d):
    orders, flagged = _orders_and_flagged(spark, d)
    columns = list(ORDERS.names)
    before = quality.count_and_digest(orders, columns).select(
        F.col("rows").alias("rows_before"), F.col("digest").alias("digest_before"), F.lit(1).alias("one")
    )
    after = quality.count_and_digest(flagged, columns).select(
        F.col("rows").alias("rows_after"), F.col("digest").alias("digest_after"), F.lit(1).alias("one")
    )
    return before.join(after, "one").select(
        "rows_before", "rows_after", (F.col("digest_before") == F.col("digest_after")).alias("same")
    )


@query(
    "j_exact_guard",
    oracle.query(
        "SELECT order_id, quantity, CAST(greatest(sum(n), 0) AS BIGINT) AS only_before, "
        "CAST(greatest(-sum(n), 0) AS BIGINT) AS only_after FROM (SELECT order_id, quantity, 1 AS n FROM raw_orders "
        "UNION ALL SELECT order_id, CASE WHEN order_id % 1009 = 7 THEN quantity + 1 ELSE quantity END, -1 "
        "FROM raw_orders) GROUP BY 1, 2 HAVING sum(n) <> 0"
    ),
)
def _(spark, d):
    """Some quantities change on the way; only the buckets whose digests differ are compared row by row."""
    orders, flagged = _orders_and_flagged(spark, d)
    columns = ["order_id", "quantity"]
    changed = F.when(F.col("order_id") % 1009 == 7, F.col("quantity") + 1).otherwise(F.col("quantity"))
    after = flagged.withColumn("quantity", changed)
    buckets = quality.BUCKETS
    sides = [compare.bucket_digests(x, columns, E.row_digest(columns), buckets) for x in (orders, after)]
    found = compare.differing_buckets(*sides).first()["buckets"]
    rows = compare.bucket_difference(orders, after, columns, buckets, found)
    return rows.withColumnsRenamed({"only_left": "only_before", "only_right": "only_after"})


# --- aggregates -----------------------------------------------------------------------------


@query(
    "a_grouped",
    oracle.query(
        "SELECT product_id, CAST(count(*) AS BIGINT) AS total_orders, CAST(sum(total_amount) AS DECIMAL(18,2)) "
        "AS total_revenue FROM raw_orders GROUP BY 1"
    ),
)
def _(spark, d):
    return gold.order_totals(td.orders(spark, d), "product_id")


@query(
    "a_ratio_average",
    oracle.query(
        f"SELECT product_id, {oracle.average('total', 'n')} AS avg_order_value FROM (SELECT product_id, count(*) AS n, "
        "CAST(sum(total_amount) AS DECIMAL(18,2)) AS total FROM raw_orders GROUP BY 1)"
    ),
)
def _(spark, d):
    totals = gold.order_totals(td.orders(spark, d), "product_id")
    average = E.money_average("total_revenue", "total_orders")
    return totals.select("product_id", average.alias("avg_order_value"))


@query(
    "a_count_matched",
    oracle.query(
        "SELECT c.country, count(*) AS customers, CAST(count(t.customer_id) AS BIGINT) AS with_orders "
        "FROM first_customers c LEFT JOIN customer_totals t ON c.customer_id = t.customer_id GROUP BY 1"
    ),
)
def _(spark, d):
    known = canonical.canonical(td.customers(spark, d), "customer_id", ["country"])
    totals = gold.order_totals(gold.qualifying(td.silver(spark, d, "orders"), "customer_id"), "customer_id")
    joined = known.join(totals, "customer_id", "left")
    return joined.groupBy("country").agg(row_count("customers"), F.count("total_orders").alias("with_orders"))


@query(
    "a_pass_fail",
    oracle.query(
        "SELECT count(*) AS total, count(*) FILTER (WHERE len(completeness_codes) = 0) AS passed, "
        "count(*) FILTER (WHERE len(completeness_codes) > 0) AS failed FROM silver_orders"
    ),
)
def _(spark, d):
    flagged = quality.apply_modules(td.orders(spark, d), "orders", [rules.COMPLETENESS])
    ok = F.col("completeness_pass")
    return flagged.agg(row_count("total"), F.count_if(ok).alias("passed"), F.count_if(~ok).alias("failed"))


_ORDER_CODES = [rule.code for rule in rules.all_rules("orders", td.SPEC)]


@query(
    "a_code_counts",
    oracle.query(
        "SELECT check_name, CAST(sum(found) AS BIGINT) AS fail_count FROM (SELECT unnest(failed_checks) AS "
        f"check_name, 1 AS found FROM silver_orders UNION ALL SELECT unnest({_ORDER_CODES}), 0) GROUP BY 1"
    ),
)
def _(spark, d):
    measured = metrics.row_metrics(td.silver(spark, d, "orders"), "orders", td.SPEC, outcome=False)
    return measured.where(F.col("check_name").contains(":")).select("check_name", "fail_count")


@query(
    "a_distinct_keys",
    oracle.query(
        "SELECT count(DISTINCT order_id) AS keys, count(DISTINCT CASE WHEN duplicated THEN order_id END) "
        "AS duplicate_keys FROM wide_orders"
    ),
)
def _(spark, d):
    flagged = quality.apply_modules(td.orders(spark, d), "orders", [rules.UNIQUENESS])
    return metrics.key_metrics(flagged, "orders").select(
        F.col("total_evaluated").alias("keys"), F.col("fail_count").alias("duplicate_keys")
    )


@query(
    "a_table_outcome",
    oracle.query(
        "SELECT quality_check_result, count(*) AS n_rows FROM silver_orders GROUP BY 1"
    ),
)
def _(spark, d):
    return td.silver(spark, d, "orders").groupBy("quality_check_result").agg(row_count("n_rows"))


@query(
    "a_having",
    oracle.query(
        "SELECT order_id, count(*) AS copies FROM raw_orders WHERE order_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1"
    ),
)
def _(spark, d):
    return lookup.duplicated_keys(td.orders(spark, d), "order_id")


@query(
    "a_metric_rates",
    oracle.query(
        f"SELECT product_id, n AS total_evaluated, f AS fail_count, {oracle.share('(n - f)', 'n')} AS pass_pct, "
        f"{oracle.share('f', 'n')} AS fail_pct FROM (SELECT product_id, count(*) AS n, "
        "count(*) FILTER (WHERE order_status = 'Cancelled') AS f FROM raw_orders WHERE product_id IS NOT NULL GROUP BY 1)"
    ),
)
def _(spark, d):
    counts = (
        td.orders(spark, d)
        .where(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(row_count("total_evaluated"), F.count_if(F.col("order_status") == "Cancelled").alias("fail_count"))
    )
    rated = metrics.with_rates(
        counts.select(
            F.lit("orders").alias("table_name"),
            F.col("product_id").cast("string").alias("check_name"),
            "total_evaluated",
            "fail_count",
            F.lit(metrics.PHYSICAL_ROW).alias("population_kind"),
        )
    )
    return rated.select(
        F.col("check_name").cast("int").alias("product_id"), "total_evaluated", "fail_count", "pass_pct", "fail_pct"
    )


@query(
    "a_reconcile",
    oracle.query(
        "SELECT (SELECT CAST(sum(total_revenue) AS DECIMAL(18,2)) FROM gold_sales) AS by_product, "
        "(SELECT CAST(sum(total_revenue) AS DECIMAL(18,2)) FROM gold_revenue) AS by_customer, "
        "(SELECT CAST(sum(total_revenue) AS DECIMAL(18,2)) FROM gold_daily) AS by_day"
    ),
)
def _(spark, d):
    orders = td.silver(spark, d, "orders")
    frames = {
        "by_product": gold.sales_by_product(orders, td.products(spark, d)),
        "by_customer": gold.revenue_by_customer(orders, td.customers(spark, d)),
        "by_day": gold.daily_trends(orders),
    }
    row = checks.one_row(*[df.agg(F.sum("total_revenue").alias(n)) for n, df in frames.items()])
    return row.select(*[F.col(c).cast(E.MONEY).alias(c) for c in frames])


@query(
    "a_measure_by",
    oracle.query(
        "SELECT category, CAST(sum(total_revenue) AS DECIMAL(18,2)) AS total_revenue FROM gold_sales GROUP BY 1"
    ),
)
def _(spark, d):
    return serving.measure_by(_sales(spark, d), "category", "total_revenue")


@query(
    "a_count_if",
    oracle.query(
        "SELECT customer_segment, count(*) FILTER (WHERE customer_segment = 'BUILDING') AS matching_rows "
        "FROM gold_revenue GROUP BY 1"
    ),
)
def _(spark, d):
    return serving.value_counts(_revenue(spark, d), "customer_segment", "BUILDING")


@query(
    "a_histogram",
    oracle.query(
        "SELECT CAST(floor(unit_price / 30) * 30 AS BIGINT) AS bin_start, count(*) AS orders FROM raw_orders GROUP BY 1"
    ),
)
def _(spark, d):
    bins = E.bin_floor(F.col("unit_price"), 30).alias("bin_start")
    return td.orders(spark, d).groupBy(bins).agg(row_count("orders"))


@query("a_distinct", oracle.query("SELECT DISTINCT country, customer_segment FROM raw_customers"))
def _(spark, d):
    return td.customers(spark, d).select("country", "customer_segment").distinct()


# --- windows --------------------------------------------------------------------------------

_KEY_COUNT = oracle.query("SELECT order_id, duplicated, count(*) AS n_rows FROM wide_orders GROUP BY 1, 2")


@query("w_key_count", _KEY_COUNT)
def _(spark, d):
    marked = lookup.is_duplicated(td.orders(spark, d), "order_id", "duplicated")
    return marked.groupBy("order_id", "duplicated").agg(row_count("n_rows"))


@query("w_key_count_salted", _KEY_COUNT)
def _(spark, d):
    marked = lookup.is_duplicated(td.orders(spark, d), "order_id", "duplicated", max_broadcast_rows=0)
    return marked.groupBy("order_id", "duplicated").agg(row_count("n_rows"))


_CANONICAL = oracle.query("SELECT customer_id, customer_name, signup_date FROM first_customers")


@query("w_canonical", _CANONICAL)
def _(spark, d):
    return canonical.canonical(td.customers(spark, d), "customer_id", ["customer_name", "signup_date"])


@query("w_canonical_rank", _CANONICAL)
def _(spark, d):
    return canonical.canonical_by_rank(td.customers(spark, d), "customer_id", ["customer_name", "signup_date"])


# --- sorts and limits -----------------------------------------------------------------------


@query(
    "t_top_n",
    oracle.query(
        "SELECT product_id, product_name, category, total_revenue, total_orders FROM gold_sales "
        "ORDER BY total_revenue DESC, product_id LIMIT 10"
    ),
)
def _(spark, d):
    return serving.top_products(_sales(spark, d))


@query(
    "t_top_n_in_category",
    oracle.query(
        "SELECT product_id, product_name, category, total_revenue, total_orders FROM gold_sales "
        "WHERE category = 'PROMO' ORDER BY total_revenue DESC, product_id LIMIT 10"
    ),
)
def _(spark, d):
    return serving.top_products(_sales(spark, d), "PROMO")


@query("t_full_order", oracle.query("SELECT product_id, price FROM raw_products ORDER BY product_id"))
def _(spark, d):
    return td.products(spark, d).select("product_id", "price").orderBy("product_id")


@query(
    "t_nulls_last",
    oracle.query("SELECT customer_id, email FROM raw_customers ORDER BY email ASC NULLS LAST, customer_id"),
)
def _(spark, d):
    return td.customers(spark, d).select("customer_id", "email").orderBy(
        F.col("email").asc_nulls_last(), "customer_id"
    )


@query(
    "t_latest_run",
    "SELECT event_type, event_id, user_id FROM events WHERE event_type = "
    "(SELECT event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 1)",
)
def _(spark, d):
    # events stand in for audit rows: event_type is the run, ts the time it was written
    events = td.table(spark, d, "events").withColumns(
        {"ingest_id": F.col("event_type"), "ingested_at": F.struct("ts", "event_id")}
    )
    return checks.latest_run(events).select("event_type", "event_id", "user_id")


@query(
    "t_priority_order",
    oracle.query("SELECT segment_type, priority AS segment_priority, customer_count FROM segment_sums ORDER BY priority"),
)
def _(spark, d):
    segments = gold.customer_segmentation(td.silver(spark, d, "orders"), td.customers(spark, d))
    return (
        segments.join(gold.segment_domain(spark), "segment_type")
        .orderBy("segment_priority")
        .select("segment_type", "segment_priority", "customer_count")
    )


@query(
    "t_order_verified",
    oracle.query("SELECT least(count(*), 10) AS n_rows, TRUE AS ordered FROM gold_sales"),
)
def _(spark, d):
    found = checks.in_rank_order(serving.top_products(_sales(spark, d)))
    return found.withColumnRenamed("rows", "n_rows")


@query(
    "t_full_order_verified",
    oracle.query(
        "SELECT 'sorted' AS variant, count(*) AS n_rows, CAST(0 AS BIGINT) AS inversions, TRUE AS ordered FROM raw_customers "
        "UNION ALL SELECT 'planted', count(*), 1, FALSE FROM raw_customers"
    ),
)
def _(spark, d):
    """All customers by segment and id, descending ids; in the second variant the last row belongs to the front."""
    order = [("customer_segment", False), ("customer_id", True)]
    rows = td.customers(spark, d).select(*(name for name, _ in order))
    full = rows.orderBy(*(F.col(n).desc() if desc else F.col(n).asc() for n, desc in order))
    last = full.tail(1)[0]
    moved = (F.col("customer_segment") == last["customer_segment"]) & (F.col("customer_id") == last["customer_id"])
    planted = full.withColumn("customer_segment", F.when(moved, "").otherwise(F.col("customer_segment")))
    variants = {"sorted": full, "planted": planted}
    return checks.union(
        [
            compare.in_order(df, *order).select(
                F.lit(name).alias("variant"), F.col("rows").alias("n_rows"), "inversions", "ordered"
            )
            for name, df in variants.items()
        ]
    )


# --- set operations -------------------------------------------------------------------------


@query(
    "u_except_all",
    oracle.query(
        "SELECT 'left' AS side, * FROM (SELECT customer_id, country FROM raw_customers EXCEPT ALL "
        "SELECT CAST(c_custkey AS BIGINT), n_name FROM customer JOIN nation ON c_nationkey = n_nationkey) "
        "UNION ALL SELECT 'right', * FROM (SELECT CAST(c_custkey AS BIGINT), n_name FROM customer JOIN nation "
        "ON c_nationkey = n_nationkey EXCEPT ALL SELECT customer_id, country FROM raw_customers)"
    ),
)
def _(spark, d):
    with_copies = td.customers(spark, d).select("customer_id", "country")
    without = with_copies.distinct()
    left = with_copies.exceptAll(without).select(F.lit("left").alias("side"), "*")
    return left.unionAll(without.exceptAll(with_copies).select(F.lit("right").alias("side"), "*"))


@query(
    "u_multiset_difference",
    oracle.query(
        "SELECT customer_id, country, CAST(count(*) - 1 AS BIGINT) AS only_left, CAST(0 AS BIGINT) AS only_right "
        "FROM raw_customers GROUP BY 1, 2 HAVING count(*) > 1"
    ),
)
def _(spark, d):
    with_copies = td.customers(spark, d).select("customer_id", "country")
    return compare.multiset_difference(with_copies, with_copies.distinct())


_SOURCE = ", ".join(ORDERS.names)


@query(
    "u_source_unchanged",
    oracle.query(
        f"SELECT (SELECT count(*) FROM (SELECT {_SOURCE} FROM raw_orders EXCEPT ALL "
        f"SELECT {_SOURCE} FROM silver_orders)) AS only_left, (SELECT count(*) FROM (SELECT {_SOURCE} "
        f"FROM silver_orders EXCEPT ALL SELECT {_SOURCE} FROM raw_orders)) AS only_right"
    ),
)
def _(spark, d):
    columns = list(ORDERS.names)
    before, after = _orders_and_flagged(spark, d)
    return compare.difference_counts(before.select(*columns), after.select(*columns))


@query(
    "u_union_all",
    oracle.query(
        "SELECT entity, count(*) AS n_rows FROM (SELECT 'customers' AS entity FROM raw_customers UNION ALL "
        "SELECT 'orders' FROM raw_orders UNION ALL SELECT 'products' FROM raw_products) GROUP BY 1"
    ),
)
def _(spark, d):
    frames = [df.select(F.lit(t).alias("entity")) for t, df in td.raw(spark, d).items()]
    return checks.union(frames).groupBy("entity").agg(row_count("n_rows"))


@query(
    "u_array_union",
    oracle.query(
        "SELECT order_id, array_to_string(list_sort(completeness_codes || ri_codes), ',') AS codes, "
        "count(*) AS n_rows FROM silver_orders WHERE len(completeness_codes || ri_codes) > 0 GROUP BY 1, 2"
    ),
)
def _(spark, d):
    a, b = F.col("completeness_failed_checks"), F.col("referential_integrity_failed_checks")
    flagged = td.silver(spark, d, "orders").select("order_id", E.merge_codes(a, b, a).alias("c"))
    return (
        flagged.where(F.size("c") > 0)
        .groupBy("order_id", F.array_join(F.array_sort("c"), ",").alias("codes"))
        .agg(row_count("n_rows"))
    )
