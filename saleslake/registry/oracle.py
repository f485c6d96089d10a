"""Building blocks of the comparison SQL: the same views, rules and aggregates in plain SQL.

They state the rules a second time and independently, with window functions and set operators
instead of the Spark formulations.
"""

from __future__ import annotations

RAW_CUSTOMERS = """
raw_customers AS (
  SELECT CAST(c_custkey AS BIGINT) AS customer_id, c_name AS customer_name,
         CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE concat(lower(c_name), '@example.com') END AS email,
         n_name AS country, DATE '1995-01-01' + CAST(c_custkey % 900 AS INTEGER) AS signup_date,
         c_mktsegment AS customer_segment, CAST(c_acctbal AS DECIMAL(18,2)) AS lifetime_value,
         c_custkey * 2 + copy_no AS row_id
  FROM (SELECT *, 0 AS copy_no FROM customer
        UNION ALL SELECT *, 1 AS copy_no FROM customer WHERE c_custkey % 89 = 1) c
  JOIN nation ON c_nationkey = n_nationkey)"""

RAW_ORDERS = """
raw_orders AS (
  SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS order_id,
         CAST(CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 103 = 1 THEN -o_orderkey
                   ELSE o_custkey END AS BIGINT) AS customer_id,
         CAST(o_orderdate AS DATE) AS order_date,
         CAST(CASE WHEN l_orderkey % 107 = 2 THEN NULL WHEN l_orderkey % 109 = 3 THEN -l_partkey
                   ELSE l_partkey END AS BIGINT) AS product_id,
         CAST(CASE WHEN l_orderkey % 127 = 6 THEN 0 ELSE l_quantity END AS INTEGER) AS quantity,
         CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price,
         CAST(CAST(l_quantity AS DECIMAL(9,2)) * CAST(p_retailprice AS DECIMAL(18,2))
              + CASE WHEN l_orderkey % 113 = 5 THEN CAST(0.02 AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END
              AS DECIMAL(18,2)) AS total_amount,
         CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'P' THEN 'Pending' WHEN 'O' THEN 'Cancelled' END AS order_status,
         CAST(CASE WHEN o_orderstatus = 'F' AND l_orderkey % 131 <> 7 THEN
                     CASE WHEN l_orderkey % 137 = 8 THEN CAST(o_orderdate AS DATE) - 1
                          ELSE CAST(greatest(l_shipdate, o_orderdate) AS DATE) END
                   WHEN o_orderstatus = 'O' AND l_orderkey % 139 = 9 THEN CAST(o_orderdate AS DATE) END
              AS DATE) AS payment_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

RAW_PRODUCTS = """
raw_products AS (
  SELECT CAST(p_partkey AS BIGINT) AS product_id, p_name AS product_name, p_type AS category,
         CAST(p_retailprice AS DECIMAL(18,2)) AS price,
         CAST(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(0.60 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS cost,
         CAST(CASE WHEN p_partkey % 41 = 3 THEN -p_size ELSE p_size END AS INTEGER) AS stock_quantity,
         CAST(p_size % 7 AS INTEGER) AS reorder_level, p_partkey AS row_id
  FROM part)"""

CANONICAL = """
first_customers AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY row_id) AS rn
                 FROM raw_customers WHERE customer_id IS NOT NULL) WHERE rn = 1),
first_products AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY row_id) AS rn
                 FROM raw_products WHERE product_id IS NOT NULL) WHERE rn = 1)"""

WIDE = """
wide_customers AS (
  SELECT *, customer_id IS NOT NULL AND count(*) OVER (PARTITION BY customer_id) > 1 AS duplicated FROM raw_customers),
wide_products AS (
  SELECT *, product_id IS NOT NULL AND count(*) OVER (PARTITION BY product_id) > 1 AS duplicated FROM raw_products),
wide_orders AS (
  SELECT o.*, o.order_id IS NOT NULL AND count(*) OVER (PARTITION BY o.order_id) > 1 AS duplicated,
         c.customer_id AS parent_customer, c.signup_date AS parent_signup, p.product_id AS parent_product
  FROM raw_orders o LEFT JOIN first_customers c ON o.customer_id = c.customer_id
  LEFT JOIN (SELECT DISTINCT product_id FROM raw_products) p ON o.product_id = p.product_id)"""

# Every rule as SQL: table -> module -> (code, condition of a violation over the wide_ view).
RULES: dict[str, dict[str, list[tuple[str, str]]]] = {
    "customers": {
        "completeness": [
            ("completeness:customers.email", "email IS NULL"),
            ("completeness:customers.customer_id", "customer_id IS NULL"),
        ],
        "uniqueness": [("uniqueness:customers.customer_id", "duplicated")],
        "type": [
            (
                "type:customers.customer_segment_domain",
                "customer_segment NOT IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY', 'FURNITURE')",
            ),
            ("type:customers.signup_date", "signup_date IS NULL"),
            ("type:customers.lifetime_value", "lifetime_value IS NULL"),
        ],
        "ri": [],
        "business": [
            ("business:customers.signup_not_future", "signup_date > DATE '1997-06-01'"),
            ("business:customers.lifetime_value_non_negative", "lifetime_value < 0"),
        ],
    },
    "orders": {
        "completeness": [
            ("completeness:orders.customer_id", "customer_id IS NULL"),
            ("completeness:orders.product_id", "product_id IS NULL"),
            ("completeness:orders.order_id", "order_id IS NULL"),
        ],
        "uniqueness": [("uniqueness:orders.order_id", "duplicated")],
        "type": [
            ("type:orders.order_status_domain", "order_status NOT IN ('Pending', 'Completed', 'Cancelled')"),
            ("type:orders.order_date", "order_date IS NULL"),
            ("type:orders.quantity", "quantity IS NULL"),
            ("type:orders.unit_price", "unit_price IS NULL"),
            ("type:orders.total_amount", "total_amount IS NULL"),
        ],
        "ri": [
            ("ri:orders.customer_id_orphan", "customer_id IS NOT NULL AND parent_customer IS NULL"),
            ("ri:orders.product_id_orphan", "product_id IS NOT NULL AND parent_product IS NULL"),
        ],
        "business": [
            ("business:orders.quantity_positive", "quantity <= 0"),
            ("business:orders.unit_price_non_negative", "unit_price < 0"),
            ("business:orders.total_amount_non_negative", "total_amount < 0"),
            ("business:orders.amount_equals_qty_price", "abs(total_amount - quantity * unit_price) > 0.01"),
            ("business:orders.completed_has_payment", "order_status = 'Completed' AND payment_date IS NULL"),
            ("business:orders.cancelled_without_payment", "order_status = 'Cancelled' AND payment_date IS NOT NULL"),
            ("business:orders.payment_on_or_after_order", "payment_date < order_date"),
            ("business:orders.order_not_before_signup", "order_date < parent_signup"),
        ],
    },
    "products": {
        "completeness": [("completeness:products.product_id", "product_id IS NULL")],
        "uniqueness": [("uniqueness:products.product_id", "duplicated")],
        "type": [
            ("type:products.price", "price IS NULL"),
            ("type:products.cost", "cost IS NULL"),
            ("type:products.stock_quantity", "stock_quantity IS NULL"),
            ("type:products.reorder_level", "reorder_level IS NULL"),
        ],
        "ri": [],
        "business": [
            ("business:products.price_non_negative", "price < 0"),
            ("business:products.cost_non_negative", "cost < 0"),
            ("business:products.stock_non_negative", "stock_quantity < 0"),
            ("business:products.reorder_non_negative", "reorder_level < 0"),
        ],
    },
}
KEYS = {"customers": "customer_id", "orders": "order_id", "products": "product_id"}
MODULES = ("completeness", "uniqueness", "type", "ri", "business")


def _codes(rules: list[tuple[str, str]]) -> str:
    cases = ", ".join(f"CASE WHEN {condition} THEN '{code}' END" for code, condition in rules)
    return f"list_filter([{cases or 'CAST(NULL AS VARCHAR)'}], lambda x: x IS NOT NULL)"


def _silver(table: str) -> str:
    lists = ", ".join(f"{_codes(RULES[table][m])} AS {m}_codes" for m in MODULES)
    every = " || ".join(f"{m}_codes" for m in MODULES)
    return f"""
silver_{table} AS MATERIALIZED (
  SELECT *, {every} AS failed_checks,
         CASE WHEN len({every}) > 0 THEN 'FAIL' ELSE 'PASS' END AS quality_check_result
  FROM (SELECT *, {lists} FROM wide_{table}))"""


def average(total: str, count: str) -> str:
    """Exact half-up average of a non-negative decimal(18,2) total, by integer cents."""
    cents = f"CAST({total} * 100 AS HUGEINT)"
    rounded = f"((2 * {cents} + {count}) // (2 * {count}))"
    return (
        f"CASE WHEN {count} > 0 THEN "
        f"CAST(CAST({rounded} AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) END"
    )


def share(part: str, whole: str) -> str:
    """Ratio to four places, ties to even, by integer arithmetic; 0 for an empty whole."""
    scaled = f"(CAST({part} AS HUGEINT) * 10000)"
    q, r = f"({scaled} // {whole})", f"({scaled} % {whole})"
    up = f"CASE WHEN 2 * {r} > {whole} OR (2 * {r} = {whole} AND {q} % 2 = 1) THEN 1 ELSE 0 END"
    value = f"CASE WHEN {whole} = 0 THEN 0 ELSE {q} + {up} END"
    return f"CAST(CAST({value} AS DECIMAL(7,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(7,4))"


QUALIFYING = "order_status = 'Completed' AND quality_check_result = 'PASS'"

_TOTALS = "CAST(count(*) AS BIGINT) AS total_orders, CAST(sum(total_amount) AS DECIMAL(18,2)) AS total_revenue"
GOLD = f"""
product_totals AS (
  SELECT product_id, {_TOTALS} FROM silver_orders
  WHERE {QUALIFYING} AND product_id IS NOT NULL GROUP BY product_id),
customer_totals AS (
  SELECT customer_id, {_TOTALS} FROM silver_orders
  WHERE {QUALIFYING} AND customer_id IS NOT NULL GROUP BY customer_id),
gold_sales AS MATERIALIZED (
  SELECT t.product_id, product_name, category, total_orders, total_revenue,
         {average('total_revenue', 'total_orders')} AS avg_order_value
  FROM product_totals t JOIN first_products p ON t.product_id = p.product_id),
customer_full AS (
  SELECT c.customer_id, customer_name, customer_segment, coalesce(total_orders, 0) AS total_orders,
         CAST(coalesce(total_revenue, 0) AS DECIMAL(18,2)) AS total_revenue
  FROM first_customers c LEFT JOIN customer_totals t ON c.customer_id = t.customer_id),
gold_revenue AS MATERIALIZED (
  SELECT *, {average('total_revenue', 'total_orders')} AS avg_order_value, total_revenue AS lifetime_value_actual
  FROM customer_full),
gold_daily AS (
  SELECT *, {average('total_revenue', 'total_orders')} AS avg_order_value FROM (
    SELECT order_date AS trend_date, {_TOTALS} FROM silver_orders
    WHERE {QUALIFYING} AND order_date IS NOT NULL GROUP BY 1)),
gold_weekly AS (
  SELECT *, {average('total_revenue', 'total_orders')} AS avg_order_value FROM (
    SELECT CAST(date_trunc('week', order_date) AS DATE) AS week_start_date, {_TOTALS} FROM silver_orders
    WHERE {QUALIFYING} AND order_date IS NOT NULL GROUP BY 1)),
labelled AS (
  SELECT customer_id, total_revenue,
         CASE WHEN total_orders = 0 THEN 'Inactive' WHEN total_revenue >= 1000 THEN 'High-Value'
              WHEN total_orders >= 2 THEN 'Repeat' ELSE 'One-Time' END AS segment_type
  FROM customer_full),
segment_sums AS (
  SELECT d.segment_type, d.priority, CAST(count(l.customer_id) AS BIGINT) AS customer_count,
         CAST(coalesce(sum(l.total_revenue), 0) AS DECIMAL(18,2)) AS total_revenue
  FROM (VALUES ('Inactive', 1), ('High-Value', 2), ('Repeat', 3), ('One-Time', 4)) d(segment_type, priority)
  LEFT JOIN labelled l ON d.segment_type = l.segment_type GROUP BY 1, 2),
gold_segments AS MATERIALIZED (
  SELECT segment_type, customer_count, {average('total_revenue', 'customer_count')} AS avg_revenue, total_revenue
  FROM segment_sums)"""


def _metric(table: str, check: str, fails: str, kind: str = "physical_row") -> str:
    return (
        f"SELECT '{table}' AS table_name, '{check}' AS check_name, CAST(count(*) AS BIGINT) AS total_evaluated, "
        f"CAST(count(*) FILTER (WHERE {fails}) AS BIGINT) AS fail_count, '{kind}' AS population_kind "
        f"FROM silver_{table}"
    )


def metric_counts(tables: tuple[str, ...] = tuple(RULES), modules: tuple[str, ...] = MODULES, full: bool = True) -> str:
    """Counts behind the metrics as one UNION ALL."""
    parts = []
    for table in tables:
        for module in modules:
            parts.append(_metric(table, module, f"len({module}_codes) > 0"))
            for code, _ in RULES[table][module]:
                parts.append(_metric(table, code, f"list_contains({module}_codes, '{code}')"))
        if full:
            key = KEYS[table]
            parts.append(_metric(table, "quality_check_result", "quality_check_result = 'FAIL'", "table_outcome"))
            parts.append(
                f"SELECT '{table}', 'uniqueness:{table}.{key}.duplicate_keys', CAST(count(DISTINCT {key}) AS BIGINT), "
                f"CAST(count(DISTINCT CASE WHEN duplicated THEN {key} END) AS BIGINT), 'distinct_key' FROM silver_{table}"
            )
    return " UNION ALL ".join(parts)


def metrics(**kwargs) -> str:
    """Complete metric rows as a select."""
    return f"""SELECT table_name, check_name, total_evaluated, total_evaluated - fail_count AS pass_count, fail_count,
  {share('(total_evaluated - fail_count)', 'total_evaluated')} AS pass_pct,
  {share('fail_count', 'total_evaluated')} AS fail_pct, population_kind
FROM ({metric_counts(**kwargs)})"""


_CTES = ",".join(
    [RAW_CUSTOMERS, RAW_ORDERS, RAW_PRODUCTS, CANONICAL, WIDE]
    + [_silver(t) for t in RULES]
    + [GOLD]
)


def query(body: str, extra: str = "") -> str:
    """A select over the raw_, first_, wide_, silver_ and gold_ views; ``extra`` adds more of them."""
    return f"WITH {_CTES}{',' + extra if extra else ''}\n{body}"
