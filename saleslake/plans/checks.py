"""Reconciliation between the layers. Every check is a row: expected, actual, status, notes, critical."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from saleslake.operators.compare import issue_instances, profile
from saleslake.operators.lookup import orphan_counts
from saleslake.operators.metrics import PHYSICAL_ROW, TABLE_OUTCOME
from saleslake.operators.quality import ALL_CODES, FAIL, PASS, PASS_COLUMN, RESULT
from saleslake.operators.rules import COMPLETENESS, RI
from saleslake.functions.expressions import quality_code, sql_text
from saleslake.plans import serving
from saleslake.plans.gold import SEGMENTS, qualifying
from saleslake.sources import lake
from saleslake.sources.contracts import AUDIT_TABLE, CONTRACTS, ROW_ID
from saleslake.sources.ingest import SUCCESS
from saleslake.sources.lake import LakeConfig

CHECK_SCHEMA = "check_name string, expected string, actual string, status string, notes string, critical boolean"


def _status(expected: Column, actual: Column) -> Column:
    return F.when(expected.eqNullSafe(actual), F.lit(PASS)).otherwise(F.lit(FAIL))


def compared(
    df: DataFrame, check: Column, expected: Column, actual: Column, critical: bool = True, notes: str = ""
) -> DataFrame:
    """One check per row of ``df``; notes say what a reader of a failure has to know."""
    return df.select(
        check.alias("check_name"),
        expected.cast("string").alias("expected"),
        actual.cast("string").alias("actual"),
        _status(expected, actual).alias("status"),
        F.lit(notes).alias("notes"),
        F.lit(critical).alias("critical"),
    )


def known(spark: SparkSession, facts: list[tuple[str, object, object]], critical: bool = True) -> DataFrame:
    """Checks whose two sides are catalog facts already at hand."""
    rows = [
        (name, str(expected), str(actual), PASS if expected == actual else FAIL, "from the catalog", critical)
        for name, expected, actual in facts
    ]
    return spark.createDataFrame(rows, CHECK_SCHEMA)


def from_row(row: DataFrame, checks: list[tuple]) -> DataFrame:
    """Several checks (name, expected, actual[, notes]) over the columns of each row of a frame."""
    entries = [
        F.struct(
            F.lit(name).alias("check_name"),
            expected.cast("string").alias("expected"),
            actual.cast("string").alias("actual"),
            _status(expected, actual).alias("status"),
            F.lit("".join(notes)).alias("notes"),
            F.lit(True).alias("critical"),
        )
        for name, expected, actual, *notes in checks
    ]
    return row.select(F.inline(F.array(*entries)))


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def one_row(*frames: DataFrame) -> DataFrame:
    """The columns of several one-row frames side by side in one row, without joining them."""
    names = [c for df in frames for c in df.columns]
    long = union(
        [
            df.selectExpr(
                "inline(array("
                + ", ".join(f"struct('{c}' AS name, CAST({c} AS decimal(38,2)) AS value)" for c in df.columns)
                + "))"
            )
            for df in frames
        ]
    )
    return long.agg(*[F.expr(f"coalesce(max(CASE WHEN name = '{n}' THEN value END), 0) AS {n}") for n in names])


def final_result(checks: DataFrame) -> DataFrame:
    """One row: number of checks, failures, critical failures and the verdict."""
    failed = F.col("status") != PASS
    counts = checks.agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(failed).alias("failures"),
        F.count_if(failed & F.col("critical")).alias("critical_failures"),
    )
    return counts.withColumn(
        "verdict", F.when(F.col("critical_failures") == 0, F.lit(PASS)).otherwise(F.lit(FAIL))
    )


def preserved(before: DataFrame, after: DataFrame, layer: str) -> DataFrame:
    """Profile entries of two layers must be equal: no defect was lost or invented."""
    pair = before.alias("b").join(after.alias("a"), "check_name", "full")
    name = F.concat(F.lit(f"{layer}."), F.col("check_name"))
    return compared(pair, name, F.col("b.rows"), F.col("a.rows"), notes="no defect is lost or invented on the way")


def source_checks(profiled: DataFrame, expected: Mapping[str, int]) -> DataFrame:
    """The profile of the sources, and its total of issue instances, against known numbers."""
    wanted = profiled.sparkSession.createDataFrame(list(expected.items()), "check_name string, wanted bigint")
    total = issue_instances(profiled).selectExpr("'issue_instances' AS check_name", "issue_instances AS rows")
    pair = wanted.join(profiled.unionByName(total), "check_name", "left")
    return compared(pair, F.concat(F.lit("source."), "check_name"), F.col("wanted"), F.col("rows"))


def row_ids_unique(df: DataFrame, name: str) -> DataFrame:
    """As many row ids as rows; grouped by id, so the distinct count needs no single task."""
    per_id = df.groupBy(ROW_ID).agg(F.count(F.lit(1)).alias("n"))
    row = per_id.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("ids"))
    return from_row(row, [(name, F.col("total"), F.col("ids"))])


def latest_run(audit: DataFrame) -> DataFrame:
    """Audit rows of the run with the latest time."""
    last = audit.agg(F.max_by("ingest_id", "ingested_at").alias("ingest_id"))
    return audit.join(F.broadcast(last), "ingest_id", "left_semi")


def audit_checks(audit: DataFrame, rows: DataFrame) -> DataFrame:
    """The latest run covered every entity, succeeded, and noted the right row counts.

    ``rows`` holds table_name and its counted rows.
    """
    last = latest_run(audit)
    entry = rows.alias("r").join(last.alias("m"), "table_name", "left")
    sides = rows.select("table_name", F.lit("wanted").alias("side")).unionAll(
        last.select("table_name", F.lit("covered"))
    )
    tables = sides.agg(
        *(
            F.concat_ws(",", F.array_sort(F.collect_list(F.when(F.col("side") == side, F.col("table_name"))))).alias(side)
            for side in ("wanted", "covered")
        )
    )
    prefix = F.concat(F.lit("bronze.audit."), F.col("table_name"))
    return union(
        [
            from_row(
                tables,
                [("bronze.audit.tables", F.col("wanted"), F.col("covered"), "the tables of the latest run, each once")],
            ),
            compared(entry, F.concat(prefix, F.lit(".row_count")), F.col("r.rows"), F.col("m.row_count")),
            compared(entry, F.concat(prefix, F.lit(".status")), F.lit(SUCCESS), F.col("m.status")),
            compared(
                entry,
                F.concat(prefix, F.lit(".ingested_at_present")),
                F.lit(True),
                F.col("m.ingested_at").isNotNull(),
            ),
            compared(
                entry,
                F.concat(prefix, F.lit(".error_message")),
                F.lit(None).cast("string"),
                F.col("m.error_message"),
            ),
        ]
    )


def table_checks(spark: SparkSession, config: LakeConfig, layer: str, tables: tuple[str, ...]) -> DataFrame:
    """Existence and format of tables, straight from the catalog."""
    facts = []
    for table in tables:
        info = lake.table_info(spark, config.table(layer, table)).first()
        facts.append((f"{layer}.{table}.exists", True, info["table_exists"]))
        facts.append((f"{layer}.{table}.format", config.table_format, info["table_format"]))
    return known(spark, facts)


def _row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return union(
        [df.agg(F.count(F.lit(1)).alias("rows")).withColumn("table_name", F.lit(t)) for t, df in tables.items()]
    )


def _null_emails(customers: DataFrame) -> DataFrame:
    found = customers.agg(F.count_if(F.col("email").isNull()).alias("null_emails"))
    return found.withColumn("table_name", F.lit("customers"))


def bronze_checks(spark: SparkSession, config: LakeConfig, expected: DataFrame, as_of: date) -> DataFrame:
    """``expected`` is the profile of the sources: everything in it has to be found in the tables."""
    raw = {t: lake.read_table(spark, config, "bronze", t) for t in CONTRACTS}
    audit = lake.read_table(spark, config, "bronze", AUDIT_TABLE)
    return union(
        [
            table_checks(spark, config, "bronze", (*CONTRACTS, AUDIT_TABLE)),
            *[row_ids_unique(df, f"bronze.{t}.row_id_unique") for t, df in raw.items()],
            preserved(expected, profile(**raw, as_of=as_of), "bronze"),
            audit_checks(audit, _row_counts(raw)),
        ]
    )


def metric_checks(spark: SparkSession, metrics: DataFrame, expected: Mapping[tuple[str, str], int]) -> DataFrame:
    """Failure counts one knows in advance; a metric that is missing fails its check."""
    rows = [(t, c, n) for (t, c), n in expected.items()]
    wanted = spark.createDataFrame(rows, "table_name string, check_name string, wanted bigint")
    pair = wanted.join(metrics, ["table_name", "check_name"], "left")
    name = F.concat_ws(".", F.lit("silver.metrics"), "table_name", "check_name")
    return compared(pair, name, F.col("wanted"), F.col("fail_count"))


def silver_checks(
    raw: Mapping[str, DataFrame],
    silver: Mapping[str, DataFrame],
    metrics: DataFrame,
    expected: Mapping[tuple[str, str], int] | None = None,
) -> DataFrame:
    """Rows against the raw layer, flags against the metrics, and NULL keys that are no orphans."""
    code = quality_code(RI, "orders", "customer_id_orphan")
    no_email = quality_code(COMPLETENESS, "customers", "email")
    absent = "customer_id IS NULL"
    # One aggregate per flagged table gives all that is asked of it.
    per_table = union(
        [
            _measures(
                df,
                rows="count(1)",
                fails=f"count_if({RESULT} = '{FAIL}')",
                no_emails=f"count_if(NOT {PASS_COLUMN[COMPLETENESS]} AND array_contains({ALL_CODES}, '{no_email}'))"
                if t == "customers"
                else "0L",
                nulls=f"count_if({absent})" if t == "orders" else "0L",
                not_orphans=f"count_if({absent} AND NOT array_contains({ALL_CODES}, '{code}'))"
                if t == "orders"
                else "0L",
            ).withColumn("table_name", F.lit(t))
            for t, df in silver.items()
        ]
    )
    outcome = metrics.where(F.col("population_kind") == TABLE_OUTCOME).select("table_name", "fail_count")
    entry = (
        _row_counts(raw)
        .withColumnRenamed("rows", "raw_rows")
        .join(_null_emails(raw["customers"]), "table_name", "left")
        .join(per_table, "table_name", "left")
        .join(outcome, "table_name", "left")
    )
    of_customers = F.when(F.col("table_name") == "customers", F.lit("silver.customers.email_fail_rows"))
    of_orders = F.when(F.col("table_name") == "orders", F.lit("silver.orders.null_fk_not_orphan"))
    found = from_row(
        entry,
        [
            (F.format_string("silver.%s.rows", "table_name"), F.col("raw_rows"), F.col("rows")),
            (F.format_string("silver.%s.fail_rows", "table_name"), F.col("fail_count"), F.col("fails")),
            (of_customers, F.col("null_emails"), F.col("no_emails"), "rows without email fail completeness"),
            (of_orders, F.col("nulls"), F.col("not_orphans"), "a missing customer is completeness, no orphan"),
        ],
    )
    frames = [found.where(F.col("check_name").isNotNull())]
    frames.append(orphan_checks(raw, metrics))
    if expected:
        frames.append(metric_checks(metrics.sparkSession, metrics, expected))
    return union(frames)


def orphan_checks(raw: Mapping[str, DataFrame], metrics: DataFrame) -> DataFrame:
    """Orphan metrics against an independent anti join on the raw tables."""
    frames = []
    for column, parent in CONTRACTS["orders"].parents:
        counted = orphan_counts(raw["orders"], column, raw[parent], CONTRACTS[parent].key)
        code = quality_code(RI, "orders", f"{column}_orphan")
        total = counted.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("orphans")).withColumn("check_name", F.lit(code))
        measured = metrics.where((F.col("population_kind") == PHYSICAL_ROW) & (F.col("check_name") == code))
        frames.append(
            compared(
                total.join(measured, "check_name", "left"),
                F.concat(F.lit("silver.orders."), F.lit(f"{column}_orphan")),
                F.col("orphans"),
                F.col("fail_count"),
            )
        )
    return union(frames)


def _measures(df: DataFrame, **measures: str) -> DataFrame:
    """One row of named SQL aggregates."""
    return df.agg(*[F.expr(f"{text} AS {name}") for name, text in measures.items()])


def same_values(row: DataFrame, pairs: list[tuple[str, str, str]]) -> DataFrame:
    """Checks named (name, expected, actual) over the columns (or literals) of a one-row frame."""
    return from_row(row, [(n, F.expr(f"CAST({a} AS decimal(38,2))"), F.expr(f"CAST({b} AS decimal(38,2))")) for n, a, b in pairs])


def gold_checks(orders: DataFrame, gold: Mapping[str, DataFrame]) -> DataFrame:
    """Eligible orders and revenue against the sums of the aggregates, and the segment buckets.

    Every table is read once.
    """
    segments = ", ".join(f"'{s}'" for s, _ in SEGMENTS)
    row = one_row(
        _measures(qualifying(orders), eligible_revenue="sum(total_amount)", eligible_orders="count(1)"),
        _measures(
            gold["sales_by_product"], product_revenue="sum(total_revenue)", product_orders="sum(total_orders)"
        ),
        _measures(
            gold["revenue_by_customer"],
            customer_revenue="sum(total_revenue)",
            customer_orders="sum(total_orders)",
            customers="count(1)",
        ),
        _measures(gold["daily_trends"], daily_revenue="sum(total_revenue)"),
        _measures(gold["weekly_trends"], weekly_revenue="sum(total_revenue)"),
        _measures(
            gold["customer_segmentation"],
            segment_revenue="sum(total_revenue)",
            segmented="sum(customer_count)",
            segments="count(1)",
            known_segments=f"count(DISTINCT CASE WHEN segment_type IN ({segments}) THEN segment_type END)",
        ),
    )
    return same_values(
        row,
        [
            ("gold.product_revenue", "eligible_revenue", "product_revenue"),
            ("gold.customer_revenue", "product_revenue", "customer_revenue"),
            ("gold.daily_revenue", "eligible_revenue", "daily_revenue"),
            ("gold.weekly_revenue", "eligible_revenue", "weekly_revenue"),
            ("gold.segment_revenue", "customer_revenue", "segment_revenue"),
            ("gold.product_orders", "eligible_orders", "product_orders"),
            ("gold.customer_orders", "eligible_orders", "customer_orders"),
            ("gold.segmented_customers", "customers", "segmented"),
            ("gold.segments", str(len(SEGMENTS)), "segments"),
            ("gold.known_segments", str(len(SEGMENTS)), "known_segments"),
        ],
    )


def in_rank_order(top: DataFrame) -> DataFrame:
    """One row: rows of a top-n result and whether they come by revenue descending, id ascending.

    Collects the n rows of the limit, never more.
    """
    placed = top.withColumn("_place", F.monotonically_increasing_id())
    listed = F.sort_array(
        F.collect_list(F.struct("_place", (-F.col("total_revenue")).alias("a"), F.col("product_id").alias("b")))
    )
    keys = F.transform(listed, lambda r: F.struct(r["a"].alias("a"), r["b"].alias("b")))
    return placed.agg(F.count(F.lit(1)).alias("rows"), (keys == F.array_sort(keys)).alias("ordered"))


def serving_checks(gold: Mapping[str, DataFrame], segments: tuple[str, ...], category: str | None) -> DataFrame:
    """Limits, order, populations and filters of the dashboard queries.

    ``category`` is any value of the category drop-down, ``segments`` the closed customer domain.
    """
    sales, customers = gold["sales_by_product"], gold["revenue_by_customer"]
    top = in_rank_order(serving.top_products(sales))
    n = F.lit(serving.TOP)
    frames = [
        from_row(
            top,
            [
                ("serving.top.at_most_n", F.lit(True), F.col("rows") <= n),
                ("serving.top.order", F.lit(True), F.col("ordered")),
            ],
        )
    ]
    chosen = serving.equals_or_any(F.col("category"), category)
    values = ", ".join(sql_text(s) for s in segments)
    row = one_row(
        _measures(
            customers,
            customers="count(1)",
            slice=f"count_if(customer_segment = {sql_text(segments[0])})",
        ),
        _measures(serving.revenue_distribution(customers), distribution="count(1)"),
        _measures(serving.revenue_distribution(customers, segments[0]), sliced="count(1)"),
        _measures(serving.revenue_histogram(customers), binned="sum(customers)"),
        _measures(serving.segment_counts(gold["customer_segmentation"]), segments="count(1)"),
        sales.agg(F.least(F.count_if(chosen), n).alias("in_category")),
        _measures(serving.top_products(sales, category).where(chosen), top_in_category="count(1)"),
        _measures(
            serving.filter_values(customers, "customer_segment"),
            domain_values=f"count_if(customer_segment IN ({values}))",
        ),
    )
    types = serving.segment_counts(gold["customer_segmentation"]).agg(
        F.concat_ws(",", F.array_sort(F.collect_set("segment_type"))).alias("types")
    )
    known_types = ",".join(sorted(s for s, _ in SEGMENTS))
    frames.append(
        from_row(types, [("serving.segment_types", F.lit(known_types), F.col("types"), "the closed list of segments")])
    )
    values = one_row(
        _measures(sales, categories="count(DISTINCT category)"),
        _measures(serving.filter_values(sales, "category"), offered="count(category)"),
    )
    frames.append(same_values(values, [("serving.category_values", "categories", "offered")]))
    frames.append(
        same_values(
            row,
            [
                ("serving.distribution.population", "customers", "distribution"),
                ("serving.histogram.population", "customers", "binned"),
                ("serving.segments.rows", str(len(SEGMENTS)), "segments"),
                ("serving.category_before_limit", "in_category", "top_in_category"),
                ("serving.segment_values", str(len(segments)), "domain_values"),
                ("serving.segment_slice", "slice", "sliced"),
            ],
        )
    )
    return union(frames)
