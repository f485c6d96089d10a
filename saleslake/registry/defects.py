"""Queries per defect-planting operator, over the clean test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from saleslake.operators import defects
from saleslake.registry.catalog import Catalog
from saleslake.sources import testdata as td

catalog = Catalog()
query = catalog.query
SEED = 42
NAMESPACE = 90_000_001


def _rank(id_column: str) -> str:
    return f"row_number() OVER (ORDER BY md5(concat('{SEED}:', {id_column})))"


@query(
    "i_null_out",
    f"SELECT c_custkey, CASE WHEN rn <= 50 THEN NULL ELSE c_name END AS c_name FROM (SELECT *, {_rank('c_custkey')} AS rn FROM customer)",
)
def _(spark, d):
    customers = td.table(spark, d, "customer").select("c_custkey", "c_name")
    return defects.null_out(customers, "c_name", 50, id_column="c_custkey", seed=SEED)


@query(
    "i_orphan_out",
    f"SELECT o_orderkey, CASE WHEN rn <= 100 THEN {NAMESPACE} + rn - 1 ELSE o_custkey END AS o_custkey "
    f"FROM (SELECT *, {_rank('o_orderkey')} AS rn FROM orders)",
)
def _(spark, d):
    orders = td.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return defects.orphan_out(orders, "o_custkey", 100, NAMESPACE, id_column="o_orderkey", seed=SEED)


@query(
    "i_copy_rows",
    f"SELECT p_partkey, p_name, CASE WHEN rn <= 20 THEN 2 ELSE 1 END AS copies FROM (SELECT *, {_rank('p_partkey')} AS rn FROM part)",
)
def _(spark, d):
    parts = td.table(spark, d, "part").select("p_partkey", "p_name")
    copied = defects.copy_rows(parts, 20, id_column="p_partkey", seed=SEED)
    return copied.groupBy("p_partkey", "p_name").agg(F.count(F.lit(1)).cast("int").alias("copies"))


@query(
    "i_future_out",
    "SELECT o_orderkey, CASE WHEN rn <= 30 THEN DATE '1997-06-01' + CAST(rn AS INTEGER) ELSE CAST(o_orderdate AS DATE) END "
    f"AS order_date FROM (SELECT *, {_rank('o_orderkey')} AS rn FROM orders)",
)
def _(spark, d):
    orders = td.table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"))
    return defects.future_out(orders, "order_date", 30, td.AS_OF, id_column="o_orderkey", seed=SEED)


def _all_defects(orders: DataFrame) -> DataFrame:
    """NULL customers, orphan customers and future dates on rows that do not overlap."""
    pick = {"id_column": "o_orderkey", "seed": SEED}
    nulls, orphans, future = defects.disjoint_ranges(100, 50, 30)
    orders = defects.null_out(orders, "o_custkey", 100, first=nulls, **pick)
    orders = defects.orphan_out(orders, "o_custkey", 50, NAMESPACE, first=orphans, **pick)
    return defects.future_out(orders, "order_date", 30, td.AS_OF, first=future, **pick)


@query(
    "i_disjoint",
    f"SELECT o_orderkey, CASE WHEN rn <= 100 THEN NULL WHEN rn <= 150 THEN {NAMESPACE} + rn - 101 ELSE o_custkey END AS o_custkey, "
    "CASE WHEN rn BETWEEN 151 AND 180 THEN DATE '1997-06-01' + CAST(rn - 150 AS INTEGER) ELSE CAST(o_orderdate AS DATE) END "
    f"AS order_date FROM (SELECT *, {_rank('o_orderkey')} AS rn FROM orders)",
)
def _(spark, d):
    orders = td.table(spark, d, "orders")
    return _all_defects(
        orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("order_date"))
    )
