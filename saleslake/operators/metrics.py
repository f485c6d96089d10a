"""Quality metrics: every rule, module, key and table outcome of a flagged table in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from saleslake.functions.expressions import ratio_sql, sql_text
from saleslake.operators.quality import CODES_COLUMN, FAIL, PASS_COLUMN, RESULT
from saleslake.operators.rules import MODULES, UNIQUENESS, QualitySpec, rules_for

# The three denominators a metric can have.
PHYSICAL_ROW = "physical_row"
DISTINCT_KEY = "distinct_key"
TABLE_OUTCOME = "table_outcome"

METRIC_COLUMNS = (
    "table_name",
    "check_name",
    "total_evaluated",
    "pass_count",
    "fail_count",
    "pass_pct",
    "fail_pct",
    "expected_fail_count",
    "population_kind",
)

# Intentional failures of the seed-42 sales data set, per table and check.
SEED_42_FAILURES: dict[tuple[str, str], int] = {
    ("customers", "completeness"): 50,
    ("customers", "completeness:customers.email"): 50,
    ("customers", "completeness:customers.customer_id"): 0,
    ("customers", "uniqueness"): 20,
    ("customers", "uniqueness:customers.customer_id"): 20,
    ("customers", "uniqueness:customers.customer_id.duplicate_keys"): 10,
    ("customers", "type"): 0,
    ("customers", "ri"): 0,
    ("customers", "business"): 30,
    ("customers", "business:customers.signup_not_future"): 30,
    ("customers", "business:customers.lifetime_value_non_negative"): 0,
    ("orders", "completeness"): 300,
    ("orders", "completeness:orders.customer_id"): 100,
    ("orders", "completeness:orders.product_id"): 200,
    ("orders", "completeness:orders.order_id"): 0,
    ("orders", "uniqueness"): 40,
    ("orders", "uniqueness:orders.order_id"): 40,
    ("orders", "uniqueness:orders.order_id.duplicate_keys"): 20,
    ("orders", "type"): 0,
    ("orders", "ri"): 80,
    ("orders", "ri:orders.customer_id_orphan"): 50,
    ("orders", "ri:orders.product_id_orphan"): 30,
    ("orders", "business"): 0,
    ("orders", "business:orders.quantity_positive"): 0,
    ("orders", "business:orders.unit_price_non_negative"): 0,
    ("orders", "business:orders.total_amount_non_negative"): 0,
    ("orders", "business:orders.amount_equals_qty_price"): 0,
    ("orders", "business:orders.completed_has_payment"): 0,
    ("orders", "business:orders.cancelled_without_payment"): 0,
    ("orders", "business:orders.payment_on_or_after_order"): 0,
    ("orders", "business:orders.order_not_before_signup"): 0,
    ("products", "completeness"): 0,
    ("products", "completeness:products.product_id"): 0,
    ("products", "uniqueness"): 0,
    ("products", "uniqueness:products.product_id"): 0,
    ("products", "uniqueness:products.product_id.duplicate_keys"): 0,
    ("products", "type"): 0,
    ("products", "ri"): 0,
    ("products", "business"): 0,
    ("products", "business:products.price_non_negative"): 0,
    ("products", "business:products.cost_non_negative"): 0,
    ("products", "business:products.stock_non_negative"): 0,
    ("products", "business:products.reorder_non_negative"): 0,
}


def measured(flagged: DataFrame, table: str, spec: QualitySpec | None = None) -> DataFrame:
    """All rows of a flagged table with the columns that its metrics read."""
    key = (spec or QualitySpec()).contract(table).key
    return flagged.select(key, *PASS_COLUMN.values(), *CODES_COLUMN.values(), RESULT)


def with_rates(counts: DataFrame) -> DataFrame:
    """Complete (table_name, check_name, total_evaluated, fail_count, population_kind) rows.

    A failure count outside 0..total is an error, not a metric.
    """
    complaint = "concat_ws(' ', 'inconsistent counts for', table_name, check_name)"
    checked = counts.withColumn(
        "fail_count",
        F.expr(
            "CASE WHEN fail_count BETWEEN 0 AND total_evaluated THEN fail_count "
            f"ELSE CAST(raise_error({complaint}) AS bigint) END"
        ),
    )
    passed = "total_evaluated - fail_count"
    return checked.selectExpr(
        "table_name",
        "check_name",
        "total_evaluated",
        f"{passed} AS pass_count",
        "fail_count",
        f"{ratio_sql(passed, 'total_evaluated')} AS pass_pct",
        f"{ratio_sql('fail_count', 'total_evaluated')} AS fail_pct",
        "population_kind",
    )


def _failure_counters(
    table: str, modules: Sequence[str], spec: QualitySpec, outcome: bool
) -> list[tuple[str, str, str]]:
    """check name, population and SQL condition of a failing row."""
    counters = []
    for module in modules:
        counters.append((module, PHYSICAL_ROW, f"NOT {PASS_COLUMN[module]}"))
        for rule in rules_for(table, module, spec):
            has_code = f"array_contains({CODES_COLUMN[module]}, {sql_text(rule.code)})"
            counters.append((rule.code, PHYSICAL_ROW, has_code))
    if outcome:
        counters.append((RESULT, TABLE_OUTCOME, f"{RESULT} = '{FAIL}'"))
    return counters


def row_metrics(
    flagged: DataFrame,
    table: str,
    spec: QualitySpec | None = None,
    *,
    modules: Sequence[str] = MODULES,
    outcome: bool = True,
) -> DataFrame:
    """Module, rule and outcome metrics: one scan, one aggregate, then one row per check."""
    counters = _failure_counters(table, modules, spec or QualitySpec(), outcome)
    wide = flagged.agg(
        F.expr("count(1) AS total"),
        *[F.expr(f"count_if({failing}) AS f{i}") for i, (_, _, failing) in enumerate(counters)],
    )
    entries = ", ".join(
        f"struct({sql_text(table)} AS table_name, {sql_text(check)} AS check_name, total AS total_evaluated, "
        f"f{i} AS fail_count, '{kind}' AS population_kind)"
        for i, (check, kind, _) in enumerate(counters)
    )
    return with_rates(wide.selectExpr(f"inline(array({entries}))"))


def key_metrics(flagged: DataFrame, table: str, spec: QualitySpec | None = None) -> DataFrame:
    """Distinct non-null keys and those of them that are duplicated.

    A row that passes uniqueness has a key of its own, so such rows are only counted: they form one
    group per task, and nothing but the duplicated keys is shuffled.
    """
    key = (spec or QualitySpec()).contract(table).key
    groups = (
        flagged.where(f"{key} IS NOT NULL")
        .groupBy(F.expr(f"CASE WHEN NOT {PASS_COLUMN[UNIQUENESS]} THEN {key} END AS duplicated_key"))
        .agg(F.expr("count(1) AS n"))
    )
    single = "coalesce(sum(CASE WHEN duplicated_key IS NULL THEN n END), 0)"
    counts = groups.agg(
        F.expr(f"{single} + count(duplicated_key) AS total_evaluated"),
        F.expr("count(duplicated_key) AS fail_count"),
    ).selectExpr(
        f"{sql_text(table)} AS table_name",
        f"{sql_text(f'{UNIQUENESS}:{table}.{key}.duplicate_keys')} AS check_name",
        "total_evaluated",
        "fail_count",
        f"'{DISTINCT_KEY}' AS population_kind",
    )
    return with_rates(counts)


def with_expected(
    spark: SparkSession, metrics: DataFrame, expected: Mapping[tuple[str, str], int]
) -> DataFrame:
    """Annotate metrics with the failures one intends; checks without an entry get NULL."""
    rows = [(table, check, count) for (table, check), count in expected.items()]
    wanted = spark.createDataFrame(
        rows, "table_name string, check_name string, expected_fail_count bigint"
    )
    return metrics.join(wanted, ["table_name", "check_name"], "left").select(*METRIC_COLUMNS)


def table_metrics(flagged: DataFrame, table: str, spec: QualitySpec | None = None) -> DataFrame:
    """All metrics of one flagged table."""
    return row_metrics(flagged, table, spec).unionByName(key_metrics(flagged, table, spec))


def silver_metrics(
    spark: SparkSession,
    flagged: Mapping[str, DataFrame],
    spec: QualitySpec | None = None,
    expected: Mapping[tuple[str, str], int] | None = None,
) -> DataFrame:
    """The metrics of all flagged tables as one long frame."""
    frames = [table_metrics(df, table, spec) for table, df in flagged.items()]
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame)
    return with_expected(spark, union, SEED_42_FAILURES if expected is None else expected)


def table_results(metrics: DataFrame) -> DataFrame:
    """Rows, failing and passing rows per table, read off the outcome metric."""
    return metrics.where(F.col("population_kind") == TABLE_OUTCOME).select(
        "table_name",
        F.col("total_evaluated").alias("silver_rows"),
        F.col("fail_count").alias("fail_rows"),
        F.col("pass_count").alias("pass_rows"),
    )
