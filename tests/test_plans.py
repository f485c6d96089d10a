"""What the physical plans have to look like."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from saleslake.operators import metrics
from saleslake.operators.canonical import canonical
from saleslake.operators.lookup import duplicated_keys, split_by_bitmap
from saleslake.operators.quality import flag
from saleslake.plans import gold, serving
from saleslake.sources import lake, testdata as td
from saleslake.sources.lake import LakeConfig

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.fixture(scope="module")
def written(spark):
    """Raw and flagged entities as tables."""
    config = LakeConfig(bronze="plan_raw", silver="plan_flagged")
    raw = td.raw(spark, SF)
    for table, df in raw.items():
        lake.overwrite_table(spark, df, config, "bronze", table)
    bronze = {t: lake.read_table(spark, config, "bronze", t) for t in raw}
    parents = {t: bronze[t] for t in ("customers", "products")}
    for table in raw:
        lake.overwrite_table(spark, flag(bronze[table], table, spec=td.SPEC, **parents), config, "silver", table)
    return bronze, {t: lake.read_table(spark, config, "silver", t) for t in raw}


def test_flagging_is_one_scan_without_windows(written):
    bronze, _ = written
    parents = {t: bronze[t] for t in ("customers", "products")}
    text = plan(flag(bronze["orders"], "orders", spec=td.SPEC, **parents))
    assert "Window" not in text and "NestedLoop" not in text and "Cartesian" not in text
    assert text.count("plan_raw/orders") + text.count("plan_raw.db/orders") == 1
    assert "Python" not in text


def test_big_parents_are_not_broadcast(written):
    bronze, _ = written
    parents = {t: bronze[t] for t in ("customers", "products")}
    flagged = flag(bronze["orders"], "orders", spec=td.SPEC, max_broadcast_rows=0, **parents)
    text = plan(flagged)
    assert "_salt" in text
    assert flagged.count() == bronze["orders"].count()
    # the statistics are checkpointed before; the fact is read once for rows whose key may be duplicated, once for others
    assert text.count("plan_raw/orders") + text.count("plan_raw.db/orders") == 2
    assert text.count("_salt#") and text.count(") SortMergeJoin") <= 2 * 4


def test_rows_without_a_duplicated_key_are_not_shuffled(spark, written):
    bronze, _ = written
    orders = bronze["orders"]
    copies = duplicated_keys(orders, "order_id")
    candidates, others = split_by_bitmap(orders, "order_id", copies)
    text = plan(others)
    # the one exchange of rows is that of the bitmap's own keys; the orders meet it by a broadcast join
    assert "BroadcastHashJoin LeftOuter" in text and "SortMergeJoin" not in text and "Python" not in text
    duplicated = copies.agg(F.sum("copies")).first()[0]
    assert duplicated <= candidates.count() <= duplicated + orders.count() // 100
    assert candidates.count() + others.count() == orders.count()


def test_canonical_rows_need_no_sort_aggregate(written):
    bronze, _ = written
    for table, key, attributes in (
        ("customers", "customer_id", ["signup_date"]),
        ("customers", "customer_id", ["customer_name", "signup_date"]),
        ("products", "product_id", ["category"]),
    ):
        text = plan(canonical(bronze[table], key, attributes))
        assert "HashAggregate" in text and "SortAggregate" not in text and "Window" not in text


def test_aggregates_read_only_their_columns(written):
    _, silver = written
    text = plan(gold.daily_trends(silver["orders"]))
    (schema,) = [line for line in text.splitlines() if line.startswith("ReadSchema")]
    assert "product_id" not in schema and "failed_checks" not in schema
    assert "EqualTo(order_status,Completed)" in text and "EqualTo(quality_check_result,PASS)" in text
    assert text.count("Exchange") >= 1 and "Window" not in text


def test_all_totals_scan_the_orders_once(written, spark, monkeypatch):
    _, silver = written
    totals = gold.all_totals(silver["orders"])
    text = plan(totals)
    assert text.count("Scan parquet") == 2  # once in the tree, once in its details
    assert "EqualTo(order_status,Completed)" in text and text.count(") Exchange") <= 2 and "Expand" in text
    for key in ("product_id", "customer_id", "order_date"):
        alone = gold.order_totals(gold.qualifying(silver["orders"], key), key)
        one = gold.totals_of(totals, key)
        assert one.exceptAll(alone).isEmpty() and alone.exceptAll(one).isEmpty() and not one.isEmpty()
    # the whole build asks for the qualifying orders once, and leaves no scratch table
    asked, made = [], gold.qualifying
    monkeypatch.setattr(gold, "qualifying", lambda *args: asked.append(args) or made(*args))
    config = LakeConfig(silver="plan_flagged", gold="plan_business")
    rows = gold.build_gold(spark, config)
    assert len(asked) == 1
    assert {t.name for t in spark.catalog.listTables("plan_business")} == set(rows) == set(gold.TABLES)


def test_top_products_need_no_global_sort(written):
    _, silver = written
    text = plan(serving.top_products(gold.sales_by_product(silver["orders"], silver["products"])))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_category_filter_stands_below_the_top_n(written):
    """It reaches the scan that fetches the texts of canonical rows, but not the one that finds out which rows these are."""
    _, silver = written
    text = plan(serving.top_products(gold.sales_by_product(silver["orders"], silver["products"]), "PROMO"))
    assert text.index("TakeOrderedAndProject") < text.index("Filter")
    assert "PROMO" in text[text.index("Filter") :]
    scans = [line for line in text.splitlines() if line.startswith("PushedFilters")]
    assert sum("PROMO" in line for line in scans) == 1
    assert any("IsNotNull(product_id)" in line and "PROMO" not in line for line in scans)


def test_row_metrics_are_one_aggregate(written):
    _, silver = written
    text = plan(metrics.row_metrics(silver["orders"], "orders", td.SPEC))
    assert text.count("Scan parquet") == 2  # once in the tree, once in its details
    (schema,) = [line for line in text.splitlines() if line.startswith("ReadSchema")]
    assert "unit_price" not in schema and "order_status" not in schema
