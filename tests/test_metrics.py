from collections import Counter

import pytest
from pyspark.errors import PySparkException

from saleslake.operators import metrics
from saleslake.plans import silver
from tests.helpers import D, flag_all, raw_fixture


def by_check(frame):
    return {(r["table_name"], r["check_name"]): r for r in frame.collect()}


def test_58_metrics_in_three_populations(spark, fixtures):
    found = by_check(metrics.silver_metrics(spark, flag_all(raw_fixture(spark, fixtures, "raw"))))
    kinds = Counter(r["population_kind"] for r in found.values())
    assert kinds == {"physical_row": 52, "distinct_key": 3, "table_outcome": 3}

    keys = found["orders", "uniqueness:orders.order_id.duplicate_keys"]
    assert (keys["total_evaluated"], keys["fail_count"], keys["fail_pct"]) == (5, 1, D("0.2000"))
    rows = found["orders", "uniqueness:orders.order_id"]
    assert (rows["total_evaluated"], rows["fail_count"]) == (6, 2)
    assert rows["expected_fail_count"] == 40
    outcome = found["customers", "quality_check_result"]
    assert (outcome["pass_count"], outcome["fail_count"], outcome["expected_fail_count"]) == (1, 3, None)


def test_ratios_round_half_to_even(spark):
    counts = spark.createDataFrame(
        [("t", "tie down", 800, 1, "physical_row"), ("t", "tie up", 800, 3, "physical_row"), ("t", "none", 0, 0, "physical_row")],
        "table_name string, check_name string, total_evaluated bigint, fail_count bigint, population_kind string",
    )
    found = {r["check_name"]: (r["fail_pct"], r["pass_pct"]) for r in metrics.with_rates(counts).collect()}
    assert found["tie down"] == (D("0.0012"), D("0.9988"))
    assert found["tie up"] == (D("0.0038"), D("0.9962"))
    assert found["none"] == (D("0.0000"), D("0.0000"))


@pytest.mark.parametrize("failed", [-1, 11])
def test_impossible_counts_are_an_error(spark, failed):
    counts = spark.createDataFrame(
        [("t", "c", 10, failed, "physical_row")],
        "table_name string, check_name string, total_evaluated bigint, fail_count bigint, population_kind string",
    )
    with pytest.raises(PySparkException):
        metrics.with_rates(counts).collect()


def test_empty_tables_have_zero_rates(spark, fixtures):
    raw = {t: df.limit(0) for t, df in raw_fixture(spark, fixtures, "raw").items()}
    found = metrics.silver_metrics(spark, flag_all(raw)).collect()
    assert len(found) == 58
    assert all((r["total_evaluated"], r["pass_pct"], r["fail_pct"]) == (0, D("0"), D("0")) for r in found)


def test_standalone_module(spark, fixtures):
    raw = raw_fixture(spark, fixtures, "raw")
    found = by_check(silver.module_metrics(raw, "ri"))
    assert set(found) == {
        ("customers", "ri"),
        ("orders", "ri"),
        ("orders", "ri:orders.customer_id_orphan"),
        ("orders", "ri:orders.product_id_orphan"),
        ("products", "ri"),
    }
    assert found["orders", "ri"]["fail_count"] == 2


def test_table_results(spark, fixtures):
    measured = metrics.silver_metrics(spark, flag_all(raw_fixture(spark, fixtures, "gold")))
    found = {r["table_name"]: (r["silver_rows"], r["fail_rows"], r["pass_rows"]) for r in metrics.table_results(measured).collect()}
    assert found == {"customers": (13, 3, 10), "orders": (26, 7, 19), "products": (3, 0, 3)}
