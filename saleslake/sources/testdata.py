"""The three entities over the star-schema test tables (customer, orders, lineitem, part, nation).

The test tables are clean, so the views overlay defects: some values become NULL, point to no
parent, break a rule, or appear twice. The remainders below only say which rows carry a defect;
every row of the tables is in the views. Both engines of a comparison can state them.
Keys are longs here and those of planted orphans negative, so that the views hold at any scale.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from saleslake.functions.expressions import MONEY
from saleslake.operators.lookup import join_partitions
from saleslake.operators.quality import flag
from saleslake.operators.rules import QualitySpec
from saleslake.sources.contracts import CONTRACTS, CUSTOMERS, ROW_ID

AS_OF = date(1997, 6, 1)
SEGMENTS = ("BUILDING", "AUTOMOBILE", "MACHINERY", "FURNITURE")

SPEC = QualitySpec(
    contracts={t: c.with_long_keys() for t, c in {**CONTRACTS, "customers": CUSTOMERS.with_domains(customer_segment=SEGMENTS)}.items()},
    as_of=AS_OF,
)


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Its schema is inferred once per path, which saves a job per later read."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    rows = table(spark, sf_dir, "customer").join(nations, F.expr("c_nationkey = n_nationkey"))
    # some customers are there twice
    twice = rows.selectExpr("*", "explode(CASE WHEN c_custkey % 89 = 1 THEN array(0, 1) ELSE array(0) END) AS copy")
    return twice.selectExpr(
        "CAST(c_custkey AS bigint) AS customer_id",
        "c_name AS customer_name",
        "CASE WHEN c_custkey % 97 <> 0 THEN concat(lower(c_name), '@example.com') END AS email",
        "n_name AS country",
        "date_add(DATE'1995-01-01', CAST(c_custkey % 900 AS int)) AS signup_date",
        "c_mktsegment AS customer_segment",
        f"CAST(c_acctbal AS {MONEY}) AS lifetime_value",
        f"c_custkey * 2 + copy AS {ROW_ID}",
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the id is given at the scan, so that a recomputed task gives the same rows the same ids
    lines = table(spark, sf_dir, "lineitem").withColumn(ROW_ID, F.monotonically_increasing_id())
    # both sides of this join grow with the data, so it is a shuffle join at every scale, in partitions of
    # bounded size (the rows are counted from the footers)
    n = join_partitions(spark, table(spark, sf_dir, "lineitem").count())
    lines = lines.repartition(n, "l_orderkey")
    heads = table(spark, sf_dir, "orders").repartition(n, "o_orderkey").hint("merge")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    joined = lines.join(heads, F.expr("l_orderkey = o_orderkey")).join(parts, F.expr("l_partkey = p_partkey"))
    surcharge = f"CAST(CASE WHEN l_orderkey % 113 = 5 THEN '0.02' ELSE '0.00' END AS {MONEY})"
    return joined.selectExpr(
        "CAST(l_orderkey * 10 + l_linenumber AS bigint) AS order_id",
        "CAST(CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 103 = 1 THEN -o_orderkey "
        "ELSE o_custkey END AS bigint) AS customer_id",
        "CAST(o_orderdate AS date) AS order_date",
        "CAST(CASE WHEN l_orderkey % 107 = 2 THEN NULL WHEN l_orderkey % 109 = 3 THEN -l_partkey "
        "ELSE l_partkey END AS bigint) AS product_id",
        "CAST(CASE WHEN l_orderkey % 127 = 6 THEN 0 ELSE l_quantity END AS int) AS quantity",
        f"CAST(p_retailprice AS {MONEY}) AS unit_price",
        f"CAST(CAST(l_quantity AS {MONEY}) * CAST(p_retailprice AS {MONEY}) + {surcharge} AS {MONEY}) AS total_amount",
        "CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'P' THEN 'Pending' WHEN 'O' THEN 'Cancelled' END AS order_status",
        "CASE WHEN o_orderstatus = 'F' AND l_orderkey % 131 <> 7 THEN "
        "CASE WHEN l_orderkey % 137 = 8 THEN date_sub(CAST(o_orderdate AS date), 1) "
        "ELSE CAST(greatest(l_shipdate, o_orderdate) AS date) END "
        "WHEN o_orderstatus = 'O' AND l_orderkey % 139 = 9 THEN CAST(o_orderdate AS date) END AS payment_date",
        ROW_ID,
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = f"CAST(p_retailprice AS {MONEY})"
    return table(spark, sf_dir, "part").selectExpr(
        "CAST(p_partkey AS bigint) AS product_id",
        "p_name AS product_name",
        "p_type AS category",
        f"{price} AS price",
        f"CAST({price} * 0.60 AS {MONEY}) AS cost",
        "CAST(CASE WHEN p_partkey % 41 = 3 THEN -p_size ELSE p_size END AS int) AS stock_quantity",
        "CAST(p_size % 7 AS int) AS reorder_level",
        f"p_partkey AS {ROW_ID}",
    )


VIEWS = {"customers": customers, "orders": orders, "products": products}


def raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: view(spark, sf_dir) for name, view in VIEWS.items()}


def silver(
    spark: SparkSession, sf_dir: str, table_name: str, tables: dict[str, DataFrame] | None = None
) -> DataFrame:
    """One flagged entity."""
    if table_name != "orders":
        df = tables[table_name] if tables else VIEWS[table_name](spark, sf_dir)
        return flag(df, table_name, spec=SPEC)
    tables = tables or raw(spark, sf_dir)
    return flag(
        tables["orders"], "orders", spec=SPEC, customers=tables["customers"], products=tables["products"]
    )


def flagged(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All flagged entities."""
    tables = raw(spark, sf_dir)
    return {t: silver(spark, sf_dir, t, tables) for t in tables}
