"""Exact guards and the order of full results, with planted faults."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from saleslake.errors import QualityError
from saleslake.operators import compare, quality
from saleslake.sources.contracts import ROW_ID
from tests.helpers import customers, good_customer, good_order, orders, products


@pytest.fixture(scope="module")
def rows(spark):
    return orders(spark, *(good_order(k, customer_id=k % 7) for k in range(300))).repartition(5)


def test_equal_layers(rows):
    assert quality.assert_same_rows(rows, rows.orderBy(F.desc("order_id")), "orders", exact_share=1.0) == 300
    assert quality.assert_same_rows(rows.limit(0), rows.limit(0), "orders", exact_share=1.0) == 0


@pytest.mark.parametrize(
    ("change", "words"),
    [
        (lambda r: r.withColumn("quantity", F.when(F.col(ROW_ID) == 7, 2).otherwise(F.col("quantity"))), ["changed", f"{ROW_ID} 7 "]),
        (lambda r: r.where(F.col(ROW_ID) != 9), ["300 rows became 299", f"{ROW_ID} 9 (1 only before"]),
        (lambda r: r.unionAll(r.where(F.col(ROW_ID) == 4)), ["300 rows became 301", f"{ROW_ID} 4 (0 only before, 1 only after)"]),
    ],
)
def test_a_changed_row_is_named(rows, change, words):
    with pytest.raises(QualityError) as error:
        quality.assert_same_rows(rows, change(rows), "orders")
    assert all(w in str(error.value) for w in words)


def test_what_a_blind_digest_misses_the_exact_share_finds(rows, monkeypatch):
    monkeypatch.setattr(quality, "row_digest", lambda columns: F.lit(0).cast("decimal(28,0)"))
    monkeypatch.setattr(quality, "BUCKETS", 1)  # the change stays in its bucket
    changed = rows.withColumn("quantity", F.when(F.col(ROW_ID) == 7, 2).otherwise(F.col("quantity")))
    assert quality.assert_same_rows(rows, changed, "orders") == 300
    with pytest.raises(QualityError, match=f"{ROW_ID} 7 "):
        quality.assert_same_rows(rows, changed, "orders", exact_share=1.0)


def test_only_the_chosen_buckets_are_compared(rows):
    columns = ["order_id", "quantity"]
    changed = rows.withColumn("quantity", F.lit(2))
    buckets = [r[0] for r in rows.where("order_id < 3").select(compare.bucket_of(columns, 64)).collect()]
    found = compare.bucket_difference(rows, changed, columns, 64, buckets)
    expected = rows.where(compare.bucket_of(columns, 64).isin(buckets)).count()
    assert found.agg(F.sum("only_left")).first()[0] == expected >= 3


ORDER = [("a", False), ("b", True)]


def sorted_rows(spark, data):
    return spark.createDataFrame(data, "a string, b int").orderBy("a", F.desc("b"))


def outcome(df):
    return tuple(compare.in_order(df, *ORDER).select("rows", "inversions", "ordered").first())


def test_order_of_a_full_result(spark):
    data = [(a, b) for a in ("x", "y", None, "") for b in (*range(40), None, 3)]
    full = sorted_rows(spark, data)
    assert outcome(full) == (len(data), 0, True)
    assert outcome(full.where("b IS NULL OR b > 35")) == (4 * 5, 0, True)
    assert outcome(sorted_rows(spark, [])) == (0, 0, True)
    swapped = F.when((F.col("a") == "x") & (F.col("b") == 20), 50).otherwise(F.col("b"))
    assert outcome(full.withColumn("b", swapped)) == (len(data), 1, False)
    null_last = F.when(F.col("a") == "y", F.lit(None)).otherwise(F.col("a"))
    assert outcome(full.withColumn("a", null_last))[2] is False


@pytest.mark.parametrize(("parts", "wrong"), [([[1, 2], [], [2, 3], [9]], 0), ([[1, 2], [], [1, 3], [9]], 1), ([[5], [4], [3]], 2)])
def test_order_across_partitions(spark, parts, wrong):
    frame = spark.sparkContext.parallelize(parts, len(parts)).flatMap(lambda p: [(x,) for x in p]).toDF("b int")
    found = compare.in_order(frame, ("b", False)).first()
    assert (found["rows"], found["inversions"], found["ordered"]) == (sum(map(len, parts)), wrong, not wrong)


def test_profile_carries_no_sums_that_only_customers_need(spark):
    """Repeated and NULL keys, missing emails and future dates are told apart; a grouped key has three sums."""
    late = date(2030, 1, 1)
    people = customers(
        spark, good_customer(1), good_customer(1, late), good_customer(2, late, None), good_customer(3, email=None),
        good_customer(None, late, None), good_customer(4, None),
    )
    sold = orders(spark, good_order(1), good_order(1, 9), good_order(2, None, 7), good_order(None, 2, None))
    found = compare.profile(people, sold, products(spark, 100, 100, None), date(2024, 1, 1))
    assert {r["check_name"]: r["rows"] for r in found.collect()} == {
        "customers.rows": 6, "customers.null_email": 3, "customers.future_signups": 3,
        "customers.future_and_null_email": 2, "customers.future_and_duplicate": 1, "customers.duplicate_keys": 1,
        "customers.duplicate_rows": 2, "orders.rows": 4, "orders.null_customer_id": 1, "orders.null_product_id": 1,
        "orders.duplicate_keys": 1, "orders.duplicate_rows": 2, "orders.orphan_customer_id": 1,
        "orders.orphan_product_id": 1, "products.rows": 3,
    }
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    grouped = next(line for line in plan.splitlines() if "Aggregate [kind" in line)
    assert grouped.count("sum(") == 3
