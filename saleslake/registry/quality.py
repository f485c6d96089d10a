"""Queries per quality rule and per quality framework operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from saleslake.functions import expressions as E
from saleslake.operators import lookup, metrics, quality, rules
from saleslake.plans import silver
from saleslake.registry import oracle
from saleslake.registry.catalog import Catalog, landed, row_count, scratch
from saleslake.sources import lake, testdata as td
from saleslake.sources.contracts import CONTRACTS
from saleslake.sources.lake import LakeConfig

catalog = Catalog()
query = catalog.query

# Defects the test views do not have, planted per rule on part of the rows; all rows stay.
# code -> column, Spark expression, DuckDB expression (both over the raw view).
_NULL = "CASE WHEN {key} % 13 = 4 THEN TRY_CAST('n/a' AS {kind}) ELSE {column} END"
_NEGATIVE = "CAST(CASE WHEN {key} % 13 = 4 THEN -1 - {column} ELSE {column} END AS {kind})"


def _planted() -> dict[str, tuple[str, str]]:
    """Rule code -> column and expression."""
    planted = {}
    for table, contract in CONTRACTS.items():
        kinds = dict(contract.columns)
        key = f"coalesce({contract.key}, 0)"
        for column in (contract.key, *contract.typed_null_fields()):
            module = rules.COMPLETENESS if column == contract.key else rules.TYPE
            text = _NULL.format(key=key, kind=kinds[column], column=column)
            planted[E.quality_code(module, table, column)] = (column, text)
    negatives = {
        "orders": {"unit_price_non_negative": "unit_price", "total_amount_non_negative": "total_amount"},
        "products": {
            "price_non_negative": "price",
            "cost_non_negative": "cost",
            "reorder_non_negative": "reorder_level",
        },
    }
    for table, columns in negatives.items():
        kinds = dict(CONTRACTS[table].columns)
        for name, column in columns.items():
            text = _NEGATIVE.format(key=CONTRACTS[table].key, kind=kinds[column], column=column)
            planted[E.quality_code(rules.BUSINESS, table, name)] = (column, text)
    planted["type:orders.order_status_domain"] = (
        "order_status",
        "CASE WHEN order_id % 13 = 4 THEN 'Shipped' WHEN order_id % 13 = 5 THEN concat(order_status, ' ') "
        "WHEN order_id % 13 = 6 THEN NULL ELSE order_status END",
    )
    planted["uniqueness:products.product_id"] = (
        "product_id",
        "CASE WHEN product_id % 13 = 4 THEN product_id - 1 ELSE product_id END",
    )
    return planted


PLANTED = _planted()


def _raw_with_defects(spark, d, table: str, code: str) -> dict[str, DataFrame]:
    tables = td.raw(spark, d)
    if code in PLANTED:
        column, text = PLANTED[code]
        tables[table] = tables[table].withColumn(column, F.expr(text))
    return tables


def _rule_sql(table: str, module: str, code: str, condition: str) -> str:
    key = CONTRACTS[table].key
    shown = "row_id" if key == PLANTED.get(code, ("",))[0] and table != "orders" else key
    extra = ""
    source = f"wide_{table}"
    if code in PLANTED:
        column, text = PLANTED[code]
        extra = f"planted AS (SELECT * REPLACE ({text} AS {column}) FROM raw_{table}), " + (
            f"counted AS (SELECT *, {key} IS NOT NULL AND count(*) OVER (PARTITION BY {key}) > 1 AS duplicated FROM planted)"
        )
        source = "counted"
    if code == "completeness:orders.order_id":
        shown = "product_id"
    return oracle.query(
        f"SELECT CAST({shown} AS BIGINT) AS record, count(*) AS n_rows FROM {source} WHERE {condition} GROUP BY 1", extra
    )


def _register_rule(table: str, module: str, code: str, condition: str) -> None:
    key = CONTRACTS[table].key
    shown = key
    if key == PLANTED.get(code, ("",))[0]:
        shown = "product_id" if table == "orders" else "_ingest_row_id"
    name = "rule_" + code.replace(":", "_").replace(".", "_")

    @query(name, _rule_sql(table, module, code, condition))
    def _(spark, d):
        tables = _raw_with_defects(spark, d, table, code)
        flagged = quality.apply_modules(
            tables[table],
            table,
            [module],
            spec=td.SPEC,
            customers=tables["customers"],
            products=tables["products"],
        )
        hit = flagged.where(F.array_contains(quality.CODES_COLUMN[module], code))
        return hit.groupBy(F.col(shown).cast("bigint").alias("record")).agg(row_count("n_rows"))


for _table, _modules in oracle.RULES.items():
    for _module, _rules in _modules.items():
        for _code, _condition in _rules:
            _register_rule(_table, _module, _code, _condition)


# --- framework operators --------------------------------------------------------------------


def _joined(column: str):
    return F.array_join(F.array_sort(column), ",").alias("codes")


@query(
    "q_codes_where",
    oracle.query(
        "SELECT product_id, CASE WHEN stock_quantity < reorder_level THEN 'stock:products.low' ELSE '' END AS codes "
        "FROM raw_products"
    ),
)
def _(spark, d):
    low = E.codes_where([("stock_quantity < reorder_level", E.quality_code("stock", "products", "low"))])
    return td.products(spark, d).select("product_id", F.array_join(low, ",").alias("codes"))


@query(
    "q_null_codes",
    oracle.query(
        "SELECT order_id, array_to_string(list_sort(completeness_codes), ',') AS codes, count(*) AS n_rows "
        "FROM silver_orders GROUP BY 1, 2"
    ),
)
def _(spark, d):
    codes = E.null_codes("orders", CONTRACTS["orders"].required, rules.COMPLETENESS)
    return td.orders(spark, d).select("order_id", codes.alias("c")).groupBy("order_id", _joined("c")).agg(row_count("n_rows"))


@query(
    "q_domain_codes",
    oracle.query(
        "SELECT customer_id, row_id, CASE WHEN customer_segment NOT IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY', 'FURNITURE') "
        "THEN 'type:customers.customer_segment_domain' ELSE '' END AS codes FROM raw_customers"
    ),
)
def _(spark, d):
    codes = E.domain_codes("customers", "customer_segment", td.SEGMENTS, rules.TYPE)
    return td.customers(spark, d).select(
        "customer_id", F.col("_ingest_row_id").alias("row_id"), F.array_join(codes, ",").alias("codes")
    )


@query(
    "q_orphan_codes",
    oracle.query(
        "SELECT customer_id, array_to_string(ri_codes, ',') AS codes, count(*) AS n_rows FROM "
        "(SELECT customer_id, list_filter(ri_codes, lambda x: contains(x, 'customer')) AS ri_codes FROM silver_orders) GROUP BY 1, 2"
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
    codes = E.orphan_codes("orders", "customer_id", rules.CUSTOMER_KEY, rules.RI)
    return joined.groupBy("customer_id", F.array_join(codes, ",").alias("codes")).agg(row_count("n_rows"))


@query(
    "q_duplicate_codes",
    oracle.query(
        "SELECT customer_id, array_to_string(uniqueness_codes, ',') AS codes, count(*) AS n_rows "
        "FROM silver_customers GROUP BY 1, 2"
    ),
)
def _(spark, d):
    flagged = quality.apply_modules(td.customers(spark, d), "customers", [rules.UNIQUENESS])
    return flagged.groupBy("customer_id", _joined("uniqueness_failed_checks")).agg(row_count("n_rows"))


@query(
    "q_accumulate",
    oracle.query(
        "SELECT product_id, array_to_string(list_sort(['business:products.manual'] || business_codes), ',') AS codes, "
        "FALSE AS business_logic_pass FROM silver_products"
    ),
)
def _(spark, d):
    earlier = F.array(F.lit("business:products.manual"))
    df = td.products(spark, d).withColumn("business_logic_failed_checks", earlier)
    for _ in range(2):
        df = quality.apply_modules(df, "products", [rules.BUSINESS], spec=td.SPEC)
    return df.select("product_id", _joined("business_logic_failed_checks"), "business_logic_pass")


@query(
    "q_combine",
    oracle.query(
        "SELECT customer_id, row_id, array_to_string(failed_checks, ',') AS codes, quality_check_result FROM silver_customers"
    ),
)
def _(spark, d):
    df = td.customers(spark, d)
    for module in rules.MODULES:
        df = quality.apply_modules(df, "customers", [module], spec=td.SPEC)
    return quality.combine(df).select(
        "customer_id",
        F.col("_ingest_row_id").alias("row_id"),
        F.array_join("failed_checks", ",").alias("codes"),
        "quality_check_result",
    )


_PASSES = ", ".join(
    f"len({m}_codes) = 0 AS {quality.PASS_COLUMN[m]}" for m in rules.MODULES
)


def _flagged_without_broadcast(spark: SparkSession, d: str) -> DataFrame:
    """The orders flagged as at the scale where no parent is small: every lookup is salted."""
    tables = td.raw(spark, d)
    parents = {t: tables[t] for t in ("customers", "products")}
    return quality.flag(tables["orders"], "orders", spec=td.SPEC, max_broadcast_rows=0, **parents)


def _register_flag(table: str, suffix: str = "") -> None:
    key = CONTRACTS[table].key
    flags = ", ".join(quality.PASS_COLUMN.values())

    @query(
        f"q_flag_{table}{suffix}",
        oracle.query(
            f"SELECT {key}, {flags}, codes, quality_check_result, count(*) AS n_rows FROM (SELECT {key}, {_PASSES}, "
            f"array_to_string(failed_checks, ',') AS codes, quality_check_result FROM silver_{table}) GROUP BY ALL"
        ),
    )
    def _(spark, d):
        flagged = _flagged_without_broadcast(spark, d) if suffix else td.silver(spark, d, table)
        codes = F.array_join("failed_checks", ",").alias("codes")
        keys = [key, *quality.PASS_COLUMN.values(), codes, "quality_check_result"]
        return flagged.groupBy(*keys).agg(row_count("n_rows"))


for _table in CONTRACTS:
    _register_flag(_table)
_register_flag("orders", "_salted")


def _register_module(module: str) -> None:
    @query(f"q_module_{module}", oracle.query(oracle.metrics(modules=(module,), full=False)))
    def _(spark, d):
        return silver.module_metrics(td.raw(spark, d), module, td.SPEC)


for _module in rules.MODULES:
    _register_module(_module)


def _all_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Every metric. The orders view is computed once, and the flags are: each metric's pass reads what was written."""
    raw = td.raw(spark, d)
    raw["orders"] = landed(spark, raw["orders"], "orders")
    flagged = {t: landed(spark, metrics.measured(td.silver(spark, d, t, raw), t, td.SPEC), f"flagged-{t}") for t in raw}
    return metrics.silver_metrics(spark, flagged, td.SPEC)


@query("q_metrics", oracle.query(oracle.metrics()))
def _(spark, d):
    return _all_metrics(spark, d).drop("expected_fail_count")


_EXPECTED = ", ".join(
    f"('{table}', '{check}', {count})" for (table, check), count in metrics.SEED_42_FAILURES.items()
)


@query(
    "q_expected",
    oracle.query(
        "SELECT m.table_name, m.check_name, m.fail_count, CAST(e.n AS BIGINT) AS expected_fail_count "
        f"FROM ({oracle.metric_counts()}) m LEFT JOIN (VALUES {_EXPECTED}) e(t, c, n) "
        "ON m.table_name = e.t AND m.check_name = e.c"
    ),
)
def _(spark, d):
    return _all_metrics(spark, d).select("table_name", "check_name", "fail_count", "expected_fail_count")


_RESULTS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS silver_rows, count(*) FILTER (WHERE quality_check_result = 'FAIL') "
    f"AS fail_rows, count(*) FILTER (WHERE quality_check_result = 'PASS') AS pass_rows FROM silver_{t}"
    for t in CONTRACTS
)


@query("q_table_results", oracle.query(_RESULTS))
def _(spark, d):
    return metrics.table_results(metrics.silver_metrics(spark, td.flagged(spark, d), td.SPEC))


@query("q_silver_build", oracle.query(_RESULTS))
def _(spark, d):
    place = scratch(spark, "silver")
    mark = place[-8:]
    config = LakeConfig(bronze=f"raw_{mark}", silver=f"flagged_{mark}", location=place)
    for table, df in td.raw(spark, d).items():
        lake.overwrite_table(spark, df, config, "bronze", table)
    return silver.build_silver(spark, config, spec=td.SPEC)
