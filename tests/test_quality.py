from datetime import date

import pytest
from pyspark.sql import functions as F

from saleslake.errors import ContractError, QualityError
from saleslake.operators import compare, quality, rules
from saleslake.operators.rules import QualitySpec, all_rules
from saleslake.sources.contracts import CONTRACTS, ROW_ID
from tests.helpers import (
    D, code_counts, customers, failed_orders, fails, flag_all, good_customer, good_order, orders, products, raw_fixture,
)


def test_there_are_37_rules_with_unique_codes():
    codes = [r.code for t in CONTRACTS for r in all_rules(t, QualitySpec())]
    assert len(codes) == 37 == len(set(codes))
    assert "type:products.reorder_level" in codes and "type:orders.payment_date" not in codes


def test_unknown_table_and_module_are_refused(spark):
    with pytest.raises(ContractError):
        rules.rules_for("returns", rules.TYPE, QualitySpec())
    with pytest.raises(ContractError):
        rules.rules_for("orders", "spelling", QualitySpec())


def test_raw_fixture(spark, fixtures):
    flagged = {t: df.collect() for t, df in flag_all(raw_fixture(spark, fixtures, "raw")).items()}
    assert code_counts(flagged["customers"]) == {
        "completeness:customers.email": 1,
        "uniqueness:customers.customer_id": 2,
    }
    assert code_counts(flagged["orders"]) == {
        "completeness:orders.customer_id": 1,
        "completeness:orders.product_id": 1,
        "uniqueness:orders.order_id": 2,
        "ri:orders.customer_id_orphan": 1,
        "ri:orders.product_id_orphan": 1,
    }
    assert [fails(flagged[t]) for t in ("customers", "orders", "products")] == [3, 6, 0]


def test_type_fixture(spark, fixtures):
    flagged = {t: df.collect() for t, df in flag_all(raw_fixture(spark, fixtures, "types")).items()}
    assert [fails(flagged[t]) for t in ("customers", "orders", "products")] == [3, 5, 2]
    found = failed_orders(flagged["orders"])
    assert found == {
        2: ["type:orders.quantity"],
        3: ["type:orders.order_date"],
        4: ["type:orders.unit_price"],
        5: ["type:orders.order_status_domain"],
        7: ["completeness:orders.customer_id"],
    }
    assert code_counts(flagged["customers"]) == {
        "type:customers.customer_segment_domain": 1,
        "type:customers.signup_date": 1,
        "type:customers.lifetime_value": 1,
    }
    assert code_counts(flagged["products"]) == {"type:products.price": 1, "type:products.stock_quantity": 1}


def test_business_fixture(spark, fixtures):
    flagged = {t: df.collect() for t, df in flag_all(raw_fixture(spark, fixtures, "business")).items()}
    found = failed_orders(flagged["orders"])
    assert found == {
        2: ["business:orders.quantity_positive"],
        5: ["business:orders.unit_price_non_negative", "business:orders.total_amount_non_negative"],
        7: ["business:orders.amount_equals_qty_price"],
        8: ["business:orders.completed_has_payment"],
        9: ["business:orders.cancelled_without_payment"],
        13: ["business:orders.payment_on_or_after_order"],
        15: ["business:orders.order_not_before_signup"],
        17: ["type:orders.quantity"],
        18: ["completeness:orders.customer_id"],
        19: ["ri:orders.customer_id_orphan"],
        20: [
            "business:orders.quantity_positive",
            "business:orders.amount_equals_qty_price",
            "business:orders.completed_has_payment",
        ],
        21: ["business:orders.total_amount_non_negative", "business:orders.amount_equals_qty_price"],
    }
    assert code_counts(flagged["customers"]) == {
        "business:customers.signup_not_future": 1,
        "business:customers.lifetime_value_non_negative": 1,
        "type:customers.signup_date": 1,
    }
    assert code_counts(flagged["products"]) == {
        "business:products.price_non_negative": 1,
        "business:products.cost_non_negative": 1,
        "business:products.stock_non_negative": 1,
        "business:products.reorder_non_negative": 1,
    }


@pytest.mark.parametrize("name", ["types", "gold"])
def test_rows_and_source_values_survive(spark, fixtures, name):
    raw = raw_fixture(spark, fixtures, name)
    for table, flagged in flag_all(raw).items():
        assert quality.assert_same_rows(raw[table], flagged, table) == raw[table].count()
        columns = quality.source_columns(raw[table])
        same = compare.difference_counts(raw[table], flagged.select(*columns)).first()
        assert (same["only_left"], same["only_right"]) == (0, 0)


def test_lost_and_changed_rows_are_noticed(spark, fixtures):
    raw = raw_fixture(spark, fixtures, "raw")["orders"]
    with pytest.raises(QualityError, match="became"):
        quality.assert_same_rows(raw, raw.limit(3), "orders")
    with pytest.raises(QualityError, match="changed"):
        quality.assert_same_rows(raw, raw.withColumn("quantity", F.lit(7)), "orders")
    moved = raw.withColumns({"order_date": F.col("payment_date"), "payment_date": F.col("order_date")})
    with pytest.raises(QualityError, match="changed"):
        quality.assert_same_rows(raw, moved, "orders")


def test_empty_string_is_not_null(spark):
    df = customers(spark, (1, "", date(2024, 1, 1), "Premium", D("1.00")), good_customer(2))
    assert code_counts(quality.flag(df, "customers")) == {}


def test_null_keys_are_no_duplicates(spark):
    df = customers(spark, good_customer(None), good_customer(None))
    assert code_counts(quality.flag(df, "customers")) == {"completeness:customers.customer_id": 2}


def test_domains_are_exact_and_skip_null(spark):
    rows = [good_order(i, order_status=s) for i, s in enumerate(["Completed", "Completed ", "completed", "", None])]
    df = orders(spark, *rows)
    flagged = quality.apply_modules(df, "orders", [rules.TYPE])
    hit = flagged.where("NOT type_validation_pass").select("order_id").collect()
    assert sorted(r["order_id"] for r in hit) == [1, 2, 3]


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_duplicate_parents_do_not_multiply_children(spark, limit):
    parents = customers(spark, good_customer(), good_customer(), good_customer())
    children = orders(spark, good_order(1), good_order(2), good_order(3, customer_id=None), good_order(4, customer_id=9))
    flagged = quality.flag(
        children, "orders", customers=parents, products=products(spark, 100, 100, None), max_broadcast_rows=limit
    )
    assert flagged.count() == 4
    assert code_counts(flagged) == {"completeness:orders.customer_id": 1, "ri:orders.customer_id_orphan": 1}


def test_earliest_parent_decides_the_signup(spark):
    early, late = date(2024, 1, 1), date(2025, 1, 1)
    children = orders(spark, good_order(1))
    items = products(spark, 100)
    for first, second, expected in ((early, late, 0), (late, early, 1), (None, late, 0)):
        parents = customers(spark, good_customer(1, first), good_customer(1, second))
        flagged = quality.flag(children, "orders", customers=parents, products=items)
        assert code_counts(flagged).get("business:orders.order_not_before_signup", 0) == expected


def test_amount_tolerance(spark):
    rows = [
        good_order(i, quantity=3, unit_price=D("6.67"), total_amount=D(t))
        for i, t in enumerate(["20.01", "20.02", "20.00", "20.03", "19.99"])
    ]
    flagged = quality.apply_modules(
        orders(spark, *rows), "orders", [rules.BUSINESS], customers=customers(spark, good_customer())
    )
    hit = flagged.where("NOT business_logic_pass").select("order_id").collect()
    assert sorted(r["order_id"] for r in hit) == [3, 4]


def test_applying_a_module_again_adds_nothing(spark, fixtures):
    raw = raw_fixture(spark, fixtures, "business")
    parents = {"customers": raw["customers"], "products": raw["products"]}
    once = quality.flag(raw["orders"], "orders", **parents)
    twice = quality.combine(quality.apply_modules(once, "orders", rules.MODULES, **parents))
    assert code_counts(once) == code_counts(twice)
    assert sorted(once.columns) == sorted(twice.columns)


def test_earlier_codes_are_kept(spark):
    df = customers(spark, good_customer()).withColumn("business_logic_failed_checks", F.array(F.lit("business:x")))
    row = quality.apply_modules(df, "customers", [rules.BUSINESS]).first()
    assert row["business_logic_failed_checks"] == ["business:x"] and row["business_logic_pass"] is False


def test_empty_tables(spark, fixtures):
    raw = {t: df.limit(0) for t, df in raw_fixture(spark, fixtures, "raw").items()}
    assert [df.count() for df in flag_all(raw).values()] == [0, 0, 0]


def test_missing_columns_and_parents_are_refused(spark):
    df = orders(spark, good_order(1))
    with pytest.raises(QualityError):
        quality.flag(df.drop(ROW_ID), "orders", customers=df, products=df)
    with pytest.raises(QualityError):
        quality.apply_modules(df.drop("quantity"), "orders", [rules.TYPE])
    with pytest.raises(QualityError):
        quality.flag(df, "orders")
    with pytest.raises(QualityError):
        quality.combine(df)
