"""Work whose size must follow the data: partitions of the orders view, and how often it is computed."""

import time
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from saleslake import registry
from saleslake.operators import lookup
from saleslake.operators.quality import apply_modules, flag
from saleslake.operators.rules import RI
from saleslake.registry.catalog import landed
from saleslake.sources import lake, testdata as td
from saleslake.sources.lake import LakeConfig
from tests import helpers


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Star-schema tables of 600 lines; some lines share an order key and a line number."""
    d = str(tmp_path_factory.mktemp("star"))
    day = datetime(1996, 1, 1)
    rows = {
        "nation": ([(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": (
            [(i, f"C{i}", 0, 1.0, "BUILDING") for i in range(20)],
            "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
        ),
        "part": (
            [(i, f"P{i}", "B", "SMALL", 5, 10.0) for i in range(30)],
            "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
        ),
        "orders": (
            [(i, i % 20, "F", 1.0, day, "1") for i in range(150)],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
            "o_orderpriority string",
        ),
        "lineitem": (
            [(i % 150, i % 30, i // 200 + 1, 2.0, day) for i in range(600)],
            "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_shipdate timestamp",
        ),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{d}/{name}.parquet")
    return d


def test_orders_come_in_partitions_of_bounded_rows(spark, tables, monkeypatch):
    monkeypatch.setattr(lookup, "PARTITION_ROWS", 20)
    orders = td.orders(spark, tables)
    assert orders.rdd.getNumPartitions() == 30
    assert orders.count() == 600


@pytest.mark.parametrize("name", ["j_no_fanout", "j_exact_guard", "u_source_unchanged", "v_silver_checks"])
def test_the_order_view_is_computed_once(spark, tables, name, monkeypatch):
    """The query's result and all passes before it read landed orders: lineitem is in no plan of the result."""
    calls = []
    view = td.orders
    monkeypatch.setitem(td.VIEWS, "orders", lambda *a: calls.append(a) or view(*a))
    monkeypatch.setattr(td, "orders", td.VIEWS["orders"])
    found = registry.all_queries()[name](spark, tables)
    assert not any("lineitem" in path for path in found.inputFiles())
    assert len(calls) == 1
    assert found.count() > 0 or name == "j_exact_guard"


@pytest.mark.parametrize("name", ["q_metrics", "q_expected"])
def test_metrics_read_flags_that_were_written_once(spark, tables, name, monkeypatch):
    """Row and key metrics are two passes; neither computes the orders view or the lookups again."""
    flags, made = [], td.flag
    monkeypatch.setattr(td, "flag", lambda df, table, **k: flags.append(df.inputFiles()) or made(df, table, **k))
    found = registry.all_queries()[name](spark, tables)
    assert not any("lineitem" in path for files in (found.inputFiles(), *flags) for path in files)
    assert len(flags) == 3 and found.count() == 58


def test_gold_checks_flag_landed_orders(spark, tables, monkeypatch):
    seen, made = [], td.flag
    monkeypatch.setattr(td, "flag", lambda df, table, **k: seen.append(df.inputFiles()) or made(df, table, **k))
    assert registry.all_queries()["v_serving_checks"](spark, tables).count() == 10
    assert len(seen) == 1 and not any("lineitem" in path for path in seen[0])


def test_rows_with_a_product_are_not_shuffled_for_it(spark):
    """Products too many to broadcast: rows meet the keys without a product, and flags are those of the plain join."""
    parents = {
        "customers": helpers.customers(spark, helpers.good_customer()),
        "products": helpers.products(spark, None, 100, 100, *range(1, 60)),
    }
    rows = [helpers.good_order(k, product_id=[None, 100, 7, -1, -k][k % 5]) for k in range(40)]
    orders = helpers.orders(spark, *rows, helpers.good_order(7, product_id=-1))
    plain = flag(orders, "orders", **parents)
    bounded = flag(orders, "orders", max_broadcast_rows=0, **parents)
    assert sorted(map(str, bounded.collect())) == sorted(map(str, plain.collect()))
    assert bounded.where("array_contains(failed_checks, 'ri:orders.product_id_orphan')").count() == 17
    text = apply_modules(orders, "orders", [RI], max_broadcast_rows=0, **parents)._jdf.queryExecution().toString()
    assert "_parent_customer_id#" in text and "= _parent_product_id#" not in text


def test_statistics_name_keys_without_a_parent(spark):
    rows = spark.sql("SELECT * FROM VALUES (1L, 7L), (1L, NULL), (2L, 7L), (3L, 8L), (NULL, 9L), (4L, 5L) AS t(a, b)")
    known = spark.sql("SELECT * FROM VALUES (8L), (8L), (NULL), (5L), (1L) AS t(k)")
    found = lookup.key_statistics(rows, ["a", "b"], {"b": known})
    assert (found.total, found.known, found.orphaned) == (6, {"a": 1, "b": 1}, {"b": 2})
    assert sorted(map(tuple, found.orphans("b").collect())) == [(7, 2), (9, 1)]
    assert [tuple(r) for r in found.copies("b").collect()] == [(7, 2)]
    assert [tuple(r) for r in found.copies("a").collect()] == [(1, 2)]
    empty = lookup.key_statistics(rows.limit(0), ["a", "b"], {"b": known})
    assert (empty.total, empty.orphaned) == (0, {"b": 0})


@pytest.mark.parametrize("limit", [0, 3, lookup.MAX_BROADCAST_ROWS])
def test_rows_are_marked_for_several_sets_at_once(spark, limit, monkeypatch):
    monkeypatch.setattr(lookup, "BITMAP_KEYS", 5)
    df = spark.range(300).selectExpr("id AS _ingest_row_id", "nullif(id % 10, 3) AS a", "id % 7 AS b")
    sets = [
        lookup.KeySet("a", "in_a", spark.sql("SELECT explode(array(1L, 2L, 3L)) AS a, 30L AS copies"), 3),
        lookup.KeySet("b", "in_b", spark.sql("SELECT explode(array(0L, 1L, 2L, 3L, 4L, 5L)) AS b, 42L AS copies"), 6),
    ]
    found = lookup.marked(df, sets, 300, max_broadcast_rows=limit)
    assert found.columns == [*df.columns, "in_a", "in_b"] and found.count() == 300
    assert found.where("in_a != (coalesce(a, 0) IN (1, 2)) OR in_b != (b < 6)").count() == 0


def _shuffle_files(spark) -> set[str]:
    """Those of 50,000 keys; the ones of a count are smaller."""
    place = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f.name for d in place for f in Path(d.getPath()).rglob("shuffle_*.data") if f.stat().st_size > 10_000}


def test_what_was_written_leaves_no_shuffle_files(spark):
    setting = spark.conf.get(lake._RELEASE, None)
    df = spark.range(100_000).repartition(4, "id").groupBy((F.col("id") % 50_000).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    before = _shuffle_files(spark)
    assert landed(spark, df, "released").count() == 50_000
    config = LakeConfig(silver="released")
    assert spark.table(lake.stage_table(spark, df, config, "silver", "t")).count() == 50_000
    kept, rows = lookup.cut_lineage(df)
    assert rows == kept.count() == 50_000
    for _ in range(100):  # Spark deletes them in the background
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(lake._RELEASE, None) == setting
    assert df.count() == 50_000  # a frame that was written can be computed again


def test_join_sides_are_not_shuffled_twice(spark):
    """Fewer partitions than the session's are raised by Spark, in a second shuffle if the first one is done."""
    assert lookup.join_partitions(spark, 0) == 8
    assert lookup.join_partitions(spark, 10 * lookup.PARTITION_ROWS + 1) == 11


def test_tables_are_written_with_zstandard(spark):
    name = lake.stage_table(spark, spark.range(10).toDF("a"), LakeConfig(silver="packed"), "silver", "t")
    assert all(".zstd." in path for path in spark.table(name).inputFiles())
    assert spark.table(name).count() == 10


def test_only_what_is_asked_for_is_shuffled(spark):
    """Conditions over the row itself are met before rows are shuffled: their columns stay behind, and flags are the same."""
    parents = {"customers": helpers.customers(spark, helpers.good_customer()), "products": helpers.products(spark, 100)}
    changes = [{}, {"quantity": -1}, {"payment_date": None}, {"order_status": "Lost"}, {"unit_price": None}, {"total_amount": helpers.D("-5")}]
    rows = [helpers.good_order(k % 9, k % 2 + 1, 100 + k % 3, **c) for k, c in enumerate(changes * 3)]
    orders = helpers.orders(spark, *rows)
    plain, bounded = flag(orders, "orders", **parents), flag(orders, "orders", max_broadcast_rows=0, **parents)
    assert bounded.columns == plain.columns
    assert sorted(map(str, bounded.collect())) == sorted(map(str, plain.collect()))
    asked = bounded.select("order_id", "failed_checks")._jdf.queryExecution().executedPlan().toString()
    first, last = (f(i for i, line in enumerate(asked.splitlines()) if "SortMergeJoin" in line) for f in (min, max))
    over = [line for line in asked.splitlines()[: last + 1] if "Project" in line]
    assert first < last and all("_broken#" in line for line in over)
    assert not any(f"{column}#" in line for line in over for column in ("unit_price", "payment_date", "order_status"))
