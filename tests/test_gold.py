from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from saleslake.operators.metrics import silver_metrics
from saleslake.operators.quality import QUALITY_COLUMNS
from saleslake.operators.canonical import canonical, canonical_by_rank
from saleslake.plans import checks, gold, serving
from saleslake.sources.contracts import AUDIT_SCHEMA
from tests.helpers import D, flag_all, raw_fixture


@pytest.fixture(scope="module")
def silver(spark, fixtures):
    return flag_all(raw_fixture(spark, fixtures, "gold"))


@pytest.fixture(scope="module")
def tables(silver):
    return gold.gold_frames(silver["orders"], silver["customers"], silver["products"])


def rows(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def test_sales_by_product(tables):
    found = rows(tables["sales_by_product"].orderBy("product_id"), *tables["sales_by_product"].columns)
    assert found == [
        (100, "Test Widget", "Electronics", 12, D("1260.01"), D("105.00")),
        (101, "Test Gadget", "Home", 5, D("2069.99"), D("414.00")),
    ]


def test_revenue_by_customer(tables):
    df = tables["revenue_by_customer"].orderBy("customer_id")
    assert rows(df, "customer_id", "total_orders", "total_revenue", "avg_order_value") == [
        (1, 2, D("1000.00"), D("500.00")),
        (2, 1, D("999.99"), D("999.99")),
        (3, 2, D("20.00"), D("10.00")),
        (4, 0, D("0.00"), None),
        (5, 0, D("0.00"), None),
        (6, 1, D("50.00"), D("50.00")),
        (7, 1, D("100.00"), D("100.00")),
        (8, 1, D("30.00"), D("30.00")),
        (9, 3, D("30.00"), D("10.00")),
        (10, 3, D("90.00"), D("30.00")),
        (11, 1, D("1000.00"), D("1000.00")),
        (12, 2, D("10.01"), D("5.01")),
    ]
    assert all(a == b for a, b in rows(df, "total_revenue", "lifetime_value_actual"))


def test_trends(tables):
    daily = tables["daily_trends"].orderBy("trend_date")
    assert rows(daily, *daily.columns) == [
        (date(2026, 8, 30), 1, D("20.00"), D("20.00")),
        (date(2026, 8, 31), 15, D("3270.00"), D("218.00")),
        (date(2026, 9, 1), 1, D("40.00"), D("40.00")),
    ]
    weekly = tables["weekly_trends"].orderBy("week_start_date")
    assert rows(weekly, *weekly.columns) == [
        (date(2026, 8, 24), 1, D("20.00"), D("20.00")),
        (date(2026, 8, 31), 16, D("3310.00"), D("206.88")),
    ]


def test_segmentation(tables):
    df = tables["customer_segmentation"]
    assert rows(df, "segment_type", "customer_count", "total_revenue", "avg_revenue") == [
        ("Inactive", 2, D("0.00"), D("0.00")),
        ("High-Value", 2, D("2000.00"), D("1000.00")),
        ("Repeat", 4, D("150.01"), D("37.50")),
        ("One-Time", 4, D("1179.99"), D("295.00")),
    ]


def test_money_stays_decimal(tables):
    for df in tables.values():
        types = dict(df.dtypes)
        assert {types[c] for c in types if "revenue" in c or "value" in c} == {"decimal(18,2)"}
        assert {types[c] for c in types if c in ("total_orders", "customer_count")} <= {"bigint"}


def test_no_eligible_orders(silver):
    none = silver["orders"].where("order_status = 'Pending'")
    tables = gold.gold_frames(none, silver["customers"], silver["products"])
    assert [tables[t].count() for t in ("sales_by_product", "daily_trends", "weekly_trends")] == [0, 0, 0]
    found = rows(tables["customer_segmentation"], "segment_type", "customer_count", "avg_revenue", "total_revenue")
    assert found[0] == ("Inactive", 12, D("0.00"), D("0.00"))
    assert found[1:] == [(s, 0, None, D("0.00")) for s in ("High-Value", "Repeat", "One-Time")]


def test_no_customers(silver):
    empty = gold.customer_segmentation(silver["orders"], silver["customers"].limit(0))
    assert [r["customer_count"] for r in empty.collect()] == [0, 0, 0, 0]


def test_canonical_forms_agree(silver):
    columns = ["customer_name", "customer_segment"]
    a = canonical(silver["customers"], "customer_id", columns)
    b = canonical_by_rank(silver["customers"], "customer_id", columns)
    assert sorted(a.collect()) == sorted(b.collect()) and a.count() == 12


def test_checks_hold_and_fail(silver, tables):
    found = checks.gold_checks(silver["orders"], tables)
    assert checks.final_result(found).first()["verdict"] == "PASS"
    broken = {**tables, "daily_trends": tables["daily_trends"].where("trend_date < '2026-09-01'")}
    bad = checks.gold_checks(silver["orders"], broken)
    assert rows(bad.where("status = 'FAIL'"), "check_name") == [("gold.daily_revenue",)]
    assert checks.final_result(bad).first()["verdict"] == "FAIL"
    lenient = checks.final_result(bad.withColumn("critical", F.lit(False))).first()
    assert (lenient["failures"], lenient["verdict"]) == (1, "PASS")


SALES = "product_id int, product_name string, category string, total_orders bigint, total_revenue decimal(18,2)"


def sales(spark, *rows):
    return spark.createDataFrame([(p, f"p{p}", c, 1, D(r)) for p, c, r in rows], SALES)


def test_top_products_breaks_ties_by_id(spark, tables):
    assert rows(serving.top_products(tables["sales_by_product"]), "product_id") == [(101,), (100,)]
    tied = sales(spark, *[(p, "A", "5.00") for p in range(12, 0, -1)])
    assert rows(serving.top_products(tied), "product_id") == [(p,) for p in range(1, 11)]
    assert checks.in_rank_order(serving.top_products(tied)).first().asDict() == {"rows": 10, "ordered": True}
    unordered = tied.orderBy(F.col("product_id").desc())
    assert checks.in_rank_order(unordered).first()["ordered"] is False
    assert serving.top_products(tied.limit(0)).count() == 0


def test_category_filter_acts_before_the_limit(spark):
    df = sales(spark, *[(p, "A", f"{100 - p}.00") for p in range(1, 6)], *[(p, "B", f"{50 - p}.00") for p in range(6, 12)],
               (12, None, "1.00"))
    assert rows(serving.top_products(df, "B"), "product_id") == [(p,) for p in range(6, 12)]
    assert len(rows(serving.top_products(df).where("category = 'B'"), "product_id")) == 5
    for wanted in (None, "A", "B", "O'Brien"):
        by_sql = serving.top_products_sql(df, wanted)
        assert by_sql.collect() == serving.top_products(df, wanted).collect()


def test_filter_values_keep_null_last(spark):
    df = sales(spark, (1, "B", "1.00"), (2, None, "1.00"), (3, "A", "1.00"), (4, "B", "1.00"))
    assert rows(serving.filter_values(df, "category"), "category") == [("A",), ("B",), (None,)]
    counted = serving.value_counts(df, "category", "B").collect()
    assert {r["category"]: r["matching_rows"] for r in counted} == {"A": 0, "B": 2, None: 0}


def test_distribution_and_histogram(tables):
    customers = tables["revenue_by_customer"]
    assert serving.revenue_distribution(customers).count() == 12
    premium = rows(serving.revenue_distribution(customers, "Premium"), "customer_id")
    assert premium == [(1,), (4,), (7,), (10,), (11,)]
    bins = dict(rows(serving.revenue_histogram(customers), "bin_start", "customers"))
    assert bins == {0: 4, 30: 3, 90: 2, 990: 3}
    assert sorted(rows(serving.segment_counts(tables["customer_segmentation"]), "customer_count")) == [(2,), (2,), (4,), (4,)]


def test_serving_checks(tables):
    found = checks.serving_checks(tables, ("Premium", "Standard", "Basic"), "Home")
    assert rows(found.where("status = 'FAIL'"), "check_name") == []


def test_checks_fail_on_a_table_too_many_and_unflagged_emails(spark, silver):
    names = ("customers", "orders", "products", "returns")
    at = datetime(2026, 1, 1)
    frame = spark.createDataFrame([("run", f"{n}.csv", n, 1, at, "SUCCESS", None) for n in names], AUDIT_SCHEMA)
    counted = spark.createDataFrame([(n, 1) for n in names[:3]], "table_name string, rows long")

    def one(found, name):
        return found.where(F.col("check_name") == name).first()

    found = one(checks.audit_checks(frame, counted), "bronze.audit.tables")
    assert (found["status"], found["actual"]) == ("FAIL", "customers,orders,products,returns")
    assert "latest run" in found["notes"]
    good = one(checks.audit_checks(frame.where("table_name <> 'returns'"), counted), "bronze.audit.tables")
    assert good["status"] == "PASS"

    raw = {t: df.drop(*[c for c in df.columns if c in QUALITY_COLUMNS]) for t, df in silver.items()}
    metrics = silver_metrics(spark, silver)
    blind = silver | {"customers": silver["customers"].withColumn("completeness_pass", F.lit(True))}
    name = "silver.customers.email_fail_rows"
    assert one(checks.silver_checks(raw, silver, metrics), name)["status"] == "PASS"
    assert one(checks.silver_checks(raw, blind, metrics), name)["status"] == "FAIL"
