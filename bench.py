"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores. Every
query starts from the test tables, so its time includes building and flagging the entities. Each is
run once to warm the JVM at the smallest scale beside the data, then timed once; rows are fully
evaluated into Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from saleslake.operators import quality, rules
from saleslake.registry import all_queries
from saleslake.sources import testdata as td

HEADLINE = (
    "q_flag_orders",
    "q_flag_orders_salted",
    "q_flag_customers",
    "q_metrics",
    "q_module_uniqueness",
    "q_module_ri",
    "g_sales_by_product",
    "g_revenue_by_customer",
    "g_daily_trends",
    "g_weekly_trends",
    "g_customer_segmentation",
    "d_top_products",
    "d_revenue_histogram",
    "j_existence",
    "j_existence_salted",
    "w_key_count",
    "w_canonical",
    "u_source_unchanged",
    "v_profile",
    "v_gold_checks",
    "s_ingest_all",
    "q_silver_build",
)


def session(cpus: str) -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="saleslake-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("saleslake-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def evaluate(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def per_metric_baseline(spark: SparkSession, sf_dir: str) -> None:
    """The plan to beat for q_metrics' orders part: one job per rule, as one would write it naively."""
    flagged = td.silver(spark, sf_dir, "orders")
    for rule in rules.all_rules("orders", td.SPEC):
        column = quality.CODES_COLUMN[rule.module]
        flagged.agg(F.count(F.lit(1)), F.count_if(F.array_contains(column, rule.code))).collect()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    small = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    warm = small if os.path.isdir(small) else sf_dir
    catalog = all_queries()
    times = {}
    for name in HEADLINE:
        evaluate(catalog[name](spark, warm))
        start = time.perf_counter()
        evaluate(catalog[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - start, 3)
    start = time.perf_counter()
    per_metric_baseline(spark, sf_dir)
    baseline = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "per_metric_jobs_orders_only_sec": baseline,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
