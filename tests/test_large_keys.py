"""The test views and their SQL with keys beyond 32 bits, and next to the planted orphans."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from saleslake.registry import all_queries, all_sql
from saleslake.sources import testdata as td
from saleslake.sources.contracts import ORDERS
from tests import oracle_compare as oc

SF = "/root/testdata/sf0.001"
SHIFT = 3_000_000_000
KEYS = {
    "customer": ["c_custkey"],
    "orders": ["o_orderkey", "o_custkey"],
    "lineitem": ["l_orderkey", "l_partkey"],
    "part": ["p_partkey"],
}


@pytest.fixture(scope="module")
def shifted(tmp_path_factory):
    """The smallest tables with all keys above 2^31."""
    folder = tmp_path_factory.mktemp("shifted")
    for table in oc.TABLES:
        file, place = f"{SF}/{table}.parquet", folder / f"{table}.parquet"
        if table not in KEYS:
            os.symlink(file, place)
            continue
        moved = ", ".join(f"{key} + {SHIFT} AS {key}" for key in KEYS[table])
        duckdb.sql(f"COPY (SELECT * REPLACE ({moved}) FROM '{file}') TO '{place}' (FORMAT parquet)")
    return str(folder)


def test_long_keys_keep_the_rest_of_a_contract():
    types = dict(ORDERS.with_long_keys().columns)
    assert [types[c] for c in ("order_id", "customer_id", "product_id", "quantity")] == ["BIGINT", "BIGINT", "BIGINT", "INT"]
    assert ORDERS.with_long_keys().typed_null_fields() == ORDERS.typed_null_fields()


def test_orphans_are_no_keys(spark, shifted):
    raw = td.raw(spark, shifted)
    least = raw["orders"].agg(F.min("order_id").alias("m")).first()["m"]
    assert least > 2**31
    for key, parent in (("customer_id", "customers"), ("product_id", "products")):
        orphans = raw["orders"].where(F.col(key) < 0)
        assert not orphans.isEmpty()
        assert raw[parent].where(F.col(key) <= 0).isEmpty()


@pytest.mark.parametrize("name", ["q_flag_orders", "g_sales_by_product", "rule_ri_orders_customer_id_orphan"])
def test_queries_equal_their_sql(spark, shifted, name):
    found = oc.spark_rows(all_queries()[name](spark, shifted))
    assert found[1]
    assert oc.differences(found, oc.duckdb_rows(oc.connect(shifted), all_sql()[name])) is None
