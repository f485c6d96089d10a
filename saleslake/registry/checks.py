"""Queries per reconciliation and profiling operator."""

from __future__ import annotations

from pyspark.sql import functions as F

from saleslake.operators import compare, metrics
from saleslake.plans import checks, gold, staged
from saleslake.registry import oracle
from saleslake.registry.catalog import Catalog, landed, scratch
from saleslake.registry.sources import export_all
from saleslake.sources import lake, testdata as td
from saleslake.sources.contracts import CONTRACTS
from saleslake.sources.ingest import ingest_all
from saleslake.sources.lake import LakeConfig

catalog = Catalog()
query = catalog.query


def _profile(spark, d):
    return compare.profile(**td.raw(spark, d), as_of=td.AS_OF)


_ORPHANS = (
    "SELECT 'orders.orphan_{0}_id', count(*) FROM raw_orders o WHERE o.{0}_id IS NOT NULL AND NOT EXISTS "
    "(SELECT 1 FROM raw_{0}s p WHERE p.{0}_id = o.{0}_id)"
)
_DUPLICATES = (
    "SELECT '{0}.duplicate_keys', count(*) FROM (SELECT {1} FROM raw_{0} WHERE {1} IS NOT NULL GROUP BY 1 HAVING count(*) > 1) "
    "UNION ALL SELECT '{0}.duplicate_rows', count(*) FROM wide_{0} WHERE duplicated"
)
PROFILE_SQL = " UNION ALL ".join(
    [
        "SELECT 'customers.rows' AS check_name, count(*) AS n_rows FROM raw_customers",
        "SELECT 'customers.null_email', count(*) FROM raw_customers WHERE email IS NULL",
        "SELECT 'customers.future_signups', count(*) FROM raw_customers WHERE signup_date > DATE '1997-06-01'",
        "SELECT 'customers.future_and_null_email', count(*) FROM raw_customers "
        "WHERE signup_date > DATE '1997-06-01' AND email IS NULL",
        "SELECT 'customers.future_and_duplicate', count(DISTINCT customer_id) FROM wide_customers "
        "WHERE signup_date > DATE '1997-06-01' AND duplicated",
        "SELECT 'orders.rows', count(*) FROM raw_orders",
        "SELECT 'orders.null_customer_id', count(*) FROM raw_orders WHERE customer_id IS NULL",
        "SELECT 'orders.null_product_id', count(*) FROM raw_orders WHERE product_id IS NULL",
        "SELECT 'products.rows', count(*) FROM raw_products",
        _DUPLICATES.format("customers", "customer_id"),
        _DUPLICATES.format("orders", "order_id"),
        _ORPHANS.format("customer"),
        _ORPHANS.format("product"),
    ]
)


@query("v_profile", oracle.query(PROFILE_SQL))
def _(spark, d):
    return _profile(spark, d).withColumnRenamed("rows", "n_rows")


_ISSUES = ", ".join(f"'{c}'" for c in compare.ISSUE_CHECKS)


@query(
    "v_issue_instances",
    oracle.query(
        f"SELECT CAST(sum(n_rows) AS BIGINT) AS issue_instances FROM ({PROFILE_SQL}) WHERE check_name IN ({_ISSUES})"
    ),
)
def _(spark, d):
    return compare.issue_instances(_profile(spark, d))


def _shown(frame):
    return frame.select("check_name", "expected", "actual", "status")


_STATUS = "CASE WHEN expected IS NOT DISTINCT FROM actual THEN 'PASS' ELSE 'FAIL' END AS status"


_WANTED = ", ".join(f"('{check}', {count})" for check, count in compare.SEED_42_PROFILE.items())


@query(
    "v_source_checks",
    oracle.query(
        f"SELECT *, {_STATUS} FROM (SELECT concat('source.', w.c) AS check_name, CAST(w.n AS VARCHAR) AS expected, "
        f"CAST(p.n_rows AS VARCHAR) AS actual FROM (VALUES {_WANTED}) w(c, n) LEFT JOIN ({PROFILE_SQL} UNION ALL "
        f"SELECT 'issue_instances', CAST(sum(n_rows) AS BIGINT) FROM ({PROFILE_SQL}) WHERE check_name IN ({_ISSUES})) p "
        "ON p.check_name = w.c)"
    ),
)
def _(spark, d):
    return _shown(checks.source_checks(_profile(spark, d), compare.SEED_42_PROFILE))


@query(
    "v_defects_preserved",
    oracle.query(
        "SELECT concat('bronze.', check_name) AS check_name, CAST(n_rows AS VARCHAR) AS expected, "
        f"CAST(n_rows AS VARCHAR) AS actual, 'PASS' AS status FROM ({PROFILE_SQL})"
    ),
)
def _(spark, d):
    place = scratch(spark, "preserved")
    config = LakeConfig(data_path=export_all(spark, d, place), bronze=f"raw_{place[-8:]}", location=place)
    ingest_all(spark, config)
    raw = {t: lake.read_table(spark, config, "bronze", t) for t in CONTRACTS}
    return _shown(checks.preserved(_profile(spark, d), compare.profile(**raw, as_of=td.AS_OF), "bronze"))


_BRONZE_SQL = f"""
SELECT concat('bronze.', check_name) AS check_name, CAST(n_rows AS VARCHAR) AS expected, CAST(n_rows AS VARCHAR) AS actual
FROM ({PROFILE_SQL})
UNION ALL SELECT concat('bronze.', t, '.row_id_unique'), CAST(n AS VARCHAR), CAST(n AS VARCHAR) FROM entity_rows
UNION ALL SELECT concat('bronze.audit.', t, '.row_count'), CAST(n AS VARCHAR), CAST(n AS VARCHAR) FROM entity_rows
UNION ALL SELECT 'bronze.audit.tables', string_agg(t, ',' ORDER BY t), 'customers,orders,products' FROM entity_rows
UNION ALL SELECT concat('bronze.audit.', t, '.status'), 'SUCCESS', 'SUCCESS' FROM entity_rows
UNION ALL SELECT concat('bronze.audit.', t, '.ingested_at_present'), 'true', 'true' FROM entity_rows
UNION ALL SELECT concat('bronze.audit.', t, '.error_message'), NULL, NULL FROM entity_rows
UNION ALL SELECT concat('bronze.', t, '.exists'), 'True', 'True' FROM bronze_tables
UNION ALL SELECT concat('bronze.', t, '.format'), 'parquet', 'parquet' FROM bronze_tables
"""
_ENTITY_ROWS = """
entity_rows AS (SELECT 'customers' AS t, count(*) AS n FROM raw_customers UNION ALL SELECT 'orders', count(*) FROM raw_orders
  UNION ALL SELECT 'products', count(*) FROM raw_products),
bronze_tables AS (SELECT t FROM entity_rows UNION ALL SELECT 'ingest_metadata')"""


@query("v_bronze_checks", oracle.query(f"SELECT *, {_STATUS} FROM ({_BRONZE_SQL})", _ENTITY_ROWS))
def _(spark, d):
    place = scratch(spark, "bronze")
    config = LakeConfig(data_path=export_all(spark, d, place), bronze=f"raw_{place[-8:]}", location=place)
    ingest_all(spark, config)
    return _shown(checks.bronze_checks(spark, config, _profile(spark, d), td.AS_OF))


_SILVER_SQL = f"""
SELECT concat('silver.', t, '.rows') AS check_name, CAST(n AS VARCHAR) AS expected, CAST(n AS VARCHAR) AS actual FROM entity_rows
UNION ALL SELECT concat('silver.', table_name, '.fail_rows'), CAST(fail_count AS VARCHAR), CAST(fail_count AS VARCHAR)
  FROM ({oracle.metric_counts()}) WHERE population_kind = 'table_outcome'
UNION ALL SELECT 'silver.customers.email_fail_rows', CAST(count(*) FILTER (WHERE email IS NULL) AS VARCHAR),
  CAST(count(*) FILTER (WHERE list_contains(completeness_codes, 'completeness:customers.email')) AS VARCHAR) FROM silver_customers
UNION ALL SELECT 'silver.orders.null_fk_not_orphan', CAST(count(*) AS VARCHAR), CAST(count(*) FILTER (WHERE NOT
  list_contains(failed_checks, 'ri:orders.customer_id_orphan')) AS VARCHAR) FROM silver_orders WHERE customer_id IS NULL
UNION ALL SELECT 'silver.orders.customer_id_orphan', CAST(count(*) AS VARCHAR), CAST(count(*) AS VARCHAR)
  FROM wide_orders WHERE customer_id IS NOT NULL AND parent_customer IS NULL
UNION ALL SELECT 'silver.orders.product_id_orphan', CAST(count(*) AS VARCHAR), CAST(count(*) AS VARCHAR)
  FROM wide_orders WHERE product_id IS NOT NULL AND parent_product IS NULL
UNION ALL SELECT 'silver.metrics.orders.completeness', '300', CAST(count(*) FILTER (WHERE len(completeness_codes) > 0) AS VARCHAR)
  FROM silver_orders
UNION ALL SELECT 'silver.metrics.orders.type', '0', CAST(count(*) FILTER (WHERE len(type_codes) > 0) AS VARCHAR) FROM silver_orders
UNION ALL SELECT 'silver.metrics.orders.absent', '0', NULL
"""


@query("v_silver_checks", oracle.query(f"SELECT *, {_STATUS} FROM ({_SILVER_SQL})", _ENTITY_ROWS))
def _(spark, d):
    """On written tables: the raw ones, the flagged ones and their metrics, as after a build."""
    place = scratch(spark, "checks")
    config = LakeConfig(silver=f"flagged_{place[-8:]}", location=place)
    raw = {t: landed(spark, df, f"raw-{t}") for t, df in td.raw(spark, d).items()}
    flagged = {}
    for table in raw:
        frame = td.silver(spark, d, table, raw)
        flagged[table] = spark.table(lake.overwrite_table(spark, frame, config, "silver", table))
    found = metrics.silver_metrics(spark, flagged, td.SPEC)
    measured = spark.table(lake.overwrite_table(spark, found, config, "silver", "quality_metrics"))
    # one expectation that fails on these tables, one that holds, one for a metric that does not exist
    expected = {("orders", "completeness"): 300, ("orders", "type"): 0, ("orders", "absent"): 0}
    return _shown(checks.silver_checks(raw, flagged, measured, expected))


def _gold(spark, d):
    """The flagged orders and the business tables, written once: checks read tables, not their plans."""
    place = scratch(spark, "checks")
    mark = place[-8:]
    config = LakeConfig(silver=f"flagged_{mark}", gold=f"business_{mark}", location=place)
    raw = td.raw(spark, d)
    raw["orders"] = landed(spark, raw["orders"], "orders")  # the key statistics and both kinds of rows are read from it
    for table, frame in (raw | {"orders": td.silver(spark, d, "orders", raw)}).items():
        lake.overwrite_table(spark, frame, config, "silver", table)
    gold.build_gold(spark, config)
    tables = {t: lake.read_table(spark, config, "gold", t) for t in gold.TABLES}
    return lake.read_table(spark, config, "silver", "orders"), tables


_MONEY = "CAST(CAST({} AS DECIMAL(38,2)) AS VARCHAR)"
_ELIGIBLE = f"(SELECT sum(total_amount) FROM silver_orders WHERE {oracle.QUALIFYING})"
_ELIGIBLE_ORDERS = f"(SELECT count(*) FROM silver_orders WHERE {oracle.QUALIFYING})"


def _check(name: str, expected: str, actual: str) -> str:
    return f"SELECT '{name}' AS check_name, {_MONEY.format(expected)} AS expected, {_MONEY.format(actual)} AS actual"


_SALES, _REVENUE = "(SELECT sum({}) FROM gold_sales)", "(SELECT sum({}) FROM gold_revenue)"
_GOLD_SQL = " UNION ALL ".join(
    [
        _check("gold.product_revenue", _ELIGIBLE, _SALES.format("total_revenue")),
        _check("gold.customer_revenue", _SALES.format("total_revenue"), _REVENUE.format("total_revenue")),
        _check("gold.daily_revenue", _ELIGIBLE, "(SELECT sum(total_revenue) FROM gold_daily)"),
        _check("gold.weekly_revenue", _ELIGIBLE, "(SELECT sum(total_revenue) FROM gold_weekly)"),
        _check("gold.segment_revenue", _REVENUE.format("total_revenue"), "(SELECT sum(total_revenue) FROM gold_segments)"),
        _check("gold.product_orders", _ELIGIBLE_ORDERS, _SALES.format("total_orders")),
        _check("gold.customer_orders", _ELIGIBLE_ORDERS, _REVENUE.format("total_orders")),
        _check("gold.segmented_customers", "(SELECT count(*) FROM gold_revenue)", "(SELECT sum(customer_count) FROM gold_segments)"),
        _check("gold.segments", "4", "(SELECT count(DISTINCT segment_type) FROM gold_segments)"),
        _check("gold.known_segments", "4", "(SELECT count(*) FROM gold_segments)"),
    ]
)


@query("v_gold_checks", oracle.query(f"SELECT *, {_STATUS} FROM ({_GOLD_SQL})"))
def _(spark, d):
    return _shown(checks.gold_checks(*_gold(spark, d)))


_CUSTOMERS = "(SELECT count(*) FROM gold_revenue)"
_BUILDING = "(SELECT count(*) FROM gold_revenue WHERE customer_segment = 'BUILDING')"
_SMALL = "(SELECT least(count(*), 10) FROM gold_sales WHERE category = 'SMALL')"
_SERVING_SQL = " UNION ALL ".join(
    [
        "SELECT 'serving.top.at_most_n' AS check_name, 'true' AS expected, 'true' AS actual",
        "SELECT 'serving.top.order', 'true', 'true'",
        "SELECT 'serving.segment_types', 'High-Value,Inactive,One-Time,Repeat', string_agg(segment_type, ',' ORDER BY segment_type) "
        "FROM gold_segments",
        _check("serving.category_values", *["(SELECT count(DISTINCT category) FROM gold_sales)"] * 2),
        _check("serving.distribution.population", _CUSTOMERS, _CUSTOMERS),
        _check("serving.histogram.population", _CUSTOMERS, _CUSTOMERS),
        _check("serving.segments.rows", "4", "(SELECT count(*) FROM gold_segments)"),
        _check("serving.category_before_limit", _SMALL, _SMALL),
        _check(
            "serving.segment_values",
            "4",
            "(SELECT count(DISTINCT customer_segment) FROM gold_revenue WHERE customer_segment <> 'HOUSEHOLD')",
        ),
        _check("serving.segment_slice", _BUILDING, _BUILDING),
    ]
)


@query("v_serving_checks", oracle.query(f"SELECT *, {_STATUS} FROM ({_SERVING_SQL})"))
def _(spark, d):
    return _shown(checks.serving_checks(_gold(spark, d)[1], td.SEGMENTS, "SMALL"))


@query(
    "v_final_result",
    oracle.query(
        "SELECT count(*) AS checks, count(*) FILTER (WHERE status = 'FAIL') AS failures, "
        "count(*) FILTER (WHERE status = 'FAIL') AS critical_failures, "
        "CASE WHEN count(*) FILTER (WHERE status = 'FAIL') = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict "
        f"FROM (SELECT *, {_STATUS} FROM ({_GOLD_SQL}))"
    ),
)
def _(spark, d):
    return checks.final_result(checks.gold_checks(*_gold(spark, d)))


_COPY_COLUMNS = "customer_id, order_date, product_id, quantity, unit_price, total_amount, order_status, payment_date"


@query(
    "v_inexact_copies",
    oracle.query(
        "SELECT order_id, CAST(sum(n) AS BIGINT) AS copies, count(*) AS versions FROM "
        f"(SELECT order_id, {_COPY_COLUMNS}, count(*) AS n FROM raw_orders GROUP BY ALL) GROUP BY 1 HAVING count(*) > 1"
    ),
)
def _(spark, d):
    return compare.inexact_copies(td.orders(spark, d), "order_id", _COPY_COLUMNS.split(", "))


@query(
    "v_overlaps",
    oracle.query(
        "SELECT pair, CAST(count(*) FILTER (WHERE hit) AS BIGINT) AS n_rows FROM ("
        "SELECT unnest(['null_customer+null_product', 'null_customer+duplicate', 'null_product+duplicate']) AS pair, "
        "unnest([customer_id IS NULL AND product_id IS NULL, customer_id IS NULL AND duplicated, "
        "product_id IS NULL AND duplicated]) AS hit FROM wide_orders) GROUP BY 1"
    ),
)
def _(spark, d):
    classes = {
        "null_customer": F.array_contains("failed_checks", "completeness:orders.customer_id"),
        "null_product": F.array_contains("failed_checks", "completeness:orders.product_id"),
        "duplicate": ~F.col("uniqueness_pass"),
    }
    return compare.overlaps(td.silver(spark, d, "orders"), classes).withColumnRenamed("rows", "n_rows")


@query(
    "v_staged_run",
    oracle.query(
        "SELECT split_part(check_name, '.', 1) AS layer, count(*) AS checks, "
        "count(*) FILTER (WHERE status = 'FAIL') AS failures FROM ("
        f"SELECT *, {_STATUS} FROM ({_BRONZE_SQL}) UNION ALL SELECT *, {_STATUS} FROM ({_GOLD_SQL}) "
        f"UNION ALL SELECT *, {_STATUS} FROM ({_SERVING_SQL}) "
        f"UNION ALL SELECT *, {_STATUS} FROM ({_SILVER_SQL}) WHERE check_name NOT LIKE 'silver.metrics%' "
        "UNION ALL SELECT 'source.products.rows', '', '', 'PASS' "
        "UNION ALL SELECT 'source.orders.rows', '', '', 'FAIL' "
        "UNION ALL SELECT concat(l, '.table'), '', '', 'PASS' FROM "
        "(SELECT unnest(['silver', 'silver', 'silver', 'silver', 'gold', 'gold', 'gold', 'gold', 'gold']) AS l, "
        "unnest([1, 2, 3, 4, 1, 2, 3, 4, 5]) AS i, [1, 2] AS two), unnest(two)) GROUP BY 1",
        _ENTITY_ROWS,
    ),
)
def _(spark, d):
    place = scratch(spark, "staged")
    mark = place[-8:]
    config = LakeConfig(
        data_path=export_all(spark, d, place),
        bronze=f"raw_{mark}",
        silver=f"flagged_{mark}",
        gold=f"business_{mark}",
        location=place,
    )
    # one expectation of the sources that holds, one that fails
    profile = {"products.rows": td.products(spark, d).count(), "orders.rows": 0}
    found = staged.run(spark, config, spec=td.SPEC, expected_profile=profile, stop_on_failure=False)
    return found.groupBy(F.split("check_name", r"\.")[0].alias("layer")).agg(
        F.count(F.lit(1)).alias("checks"), F.count_if(F.col("status") == "FAIL").alias("failures")
    )
