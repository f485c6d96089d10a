"""Queries per scalar function."""

from __future__ import annotations

from pyspark.sql import functions as F

from saleslake.functions import expressions as E
from saleslake.operators import quality, rules
from saleslake.registry import oracle
from saleslake.registry.catalog import Catalog, row_count
from saleslake.sources import testdata as td
from saleslake.sources.contracts import ROW_ID
from saleslake.sources.ingest import with_row_id

catalog = Catalog()
query = catalog.query


def _codes(spark, d):
    """Every failed code of every order, one row each."""
    return td.silver(spark, d, "orders").select("order_id", F.explode("failed_checks").alias("code"))


def _local(spark, d):
    """Orders with the codes that need no parent lookup."""
    return quality.apply_modules(td.orders(spark, d), "orders", [rules.COMPLETENESS, rules.TYPE])


_UNNESTED = "(SELECT order_id, unnest(failed_checks) AS code FROM silver_orders)"


@query(
    "f_startswith",
    oracle.query(f"SELECT code, count(*) AS n_rows FROM {_UNNESTED} WHERE starts_with(code, 'ri:') GROUP BY 1"),
)
def _(spark, d):
    return _codes(spark, d).where(F.col("code").startswith("ri:")).groupBy("code").agg(row_count("n_rows"))


@query(
    "f_contains",
    oracle.query(f"SELECT code, count(*) AS n_rows FROM {_UNNESTED} WHERE contains(code, 'orphan') GROUP BY 1"),
)
def _(spark, d):
    return _codes(spark, d).where(F.col("code").contains("orphan")).groupBy("code").agg(row_count("n_rows"))


@query(
    "f_rule_code",
    "SELECT concat(o_orderstatus, ':', 'orders', '.', o_orderpriority) AS code, count(*) AS n_rows FROM orders GROUP BY 1",
)
def _(spark, d):
    """The code that ``quality_code`` builds for each pair that occurs."""
    table = td.table(spark, d, "orders")
    pairs = table.groupBy("o_orderstatus", "o_orderpriority").agg(row_count("n_rows"))
    # a code per rule is built on the driver: three statuses by five priorities are 15 rules
    seen = pairs.select("o_orderstatus", "o_orderpriority").collect()
    codes = [(s, p, E.quality_code(s, "orders", p)) for s, p in seen]
    named = spark.createDataFrame(codes, "o_orderstatus string, o_orderpriority string, code string")
    return pairs.join(F.broadcast(named), ["o_orderstatus", "o_orderpriority"]).select("code", "n_rows")


@query(
    "f_week_start",
    "SELECT CAST(o_orderdate AS DATE) AS order_date, CAST(date_trunc('week', o_orderdate) AS DATE) AS week_start, "
    "count(*) AS n_rows FROM orders GROUP BY 1, 2",
)
def _(spark, d):
    day = F.col("o_orderdate").cast("date")
    keys = [day.alias("order_date"), E.week_start(day).alias("week_start")]
    return td.table(spark, d, "orders").groupBy(*keys).agg(row_count("n_rows"))


@query("f_civil_date", "SELECT event_id, CAST(ts AS DATE) AS event_date FROM events")
def _(spark, d):
    return td.table(spark, d, "events").select("event_id", F.col("ts").cast("date").alias("event_date"))


@query(
    "f_as_of_compare",
    oracle.query("SELECT customer_id, signup_date FROM raw_customers WHERE signup_date > DATE '1997-06-01'"),
)
def _(spark, d):
    return td.customers(spark, d).where(F.col("signup_date") > F.lit(td.AS_OF)).select("customer_id", "signup_date")


@query(
    "f_date_order",
    oracle.query("SELECT order_id, order_date, payment_date FROM raw_orders WHERE payment_date < order_date"),
)
def _(spark, d):
    late = F.col("payment_date") < F.col("order_date")
    return td.orders(spark, d).where(late).select("order_id", "order_date", "payment_date")


@query(
    "f_abs",
    oracle.query(
        "SELECT CAST(abs(total_amount - quantity * unit_price) AS DECIMAL(18,2)) AS deviation, count(*) AS n_rows "
        "FROM raw_orders GROUP BY 1"
    ),
)
def _(spark, d):
    expected = E.line_total(F.col("quantity"), F.col("unit_price"))
    deviation = F.abs(F.col("total_amount") - expected).cast(E.MONEY)
    return td.orders(spark, d).groupBy(deviation.alias("deviation")).agg(row_count("n_rows"))


@query(
    "f_decimal_multiply",
    "SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_quantity AS DECIMAL(9,2)) * "
    "CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(24,4)) AS product FROM lineitem",
)
def _(spark, d):
    product = E.line_total(F.col("l_quantity"), F.col("l_extendedprice").cast(E.MONEY))
    return td.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", product.cast("decimal(24,4)").alias("product")
    )


@query(
    "f_decimal_divide",
    "SELECT o_custkey, " + oracle.average("total", "n") + " AS average FROM (SELECT o_custkey, count(*) AS n, "
    "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total FROM orders GROUP BY 1)",
)
def _(spark, d):
    totals = td.table(spark, d, "orders").groupBy("o_custkey").agg(
        row_count("n"), F.sum(F.col("o_totalprice").cast(E.MONEY)).alias("total")
    )
    return totals.select("o_custkey", E.money_average("total", "n").alias("average"))


@query(
    "f_ratio",
    "SELECT l_suppkey, " + oracle.share("f", "n") + " AS returned FROM (SELECT l_suppkey, count(*) AS n, "
    "count(*) FILTER (WHERE l_returnflag = 'R') AS f FROM lineitem GROUP BY 1)",
)
def _(spark, d):
    counts = td.table(spark, d, "lineitem").groupBy("l_suppkey").agg(
        row_count("n"), F.count_if(F.col("l_returnflag") == "R").alias("f")
    )
    return counts.select("l_suppkey", E.ratio("f", "n").alias("returned"))


@query(
    "f_bin_floor",
    "SELECT CAST(floor(CAST(c_acctbal AS DECIMAL(18,2)) / 30) * 30 AS BIGINT) AS bin_start, count(*) AS n_rows "
    "FROM customer GROUP BY 1",
)
def _(spark, d):
    bins = E.bin_floor(F.col("c_acctbal").cast(E.MONEY), 30)
    return td.table(spark, d, "customer").groupBy(bins.alias("bin_start")).agg(row_count("n_rows"))


@query(
    "f_one_element_array",
    "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'overdrawn' ELSE '' END AS codes FROM customer",
)
def _(spark, d):
    codes = E.codes_where([("c_acctbal < 0", "overdrawn")])
    return td.table(spark, d, "customer").select("c_custkey", F.array_join(codes, ",").alias("codes"))


@query(
    "f_empty_array",
    "SELECT 'array<string>' AS kind, CAST(0 AS BIGINT) AS elements, count(*) AS n_rows FROM customer GROUP BY 1, 2",
)
def _(spark, d):
    empty = td.table(spark, d, "customer").select(E.no_codes().alias("codes"))
    return empty.groupBy(F.expr("typeof(codes)").alias("kind"), F.size("codes").cast("bigint").alias("elements")).agg(
        row_count("n_rows")
    )


@query(
    "f_array_concat",
    oracle.query(
        "SELECT order_id, array_to_string(completeness_codes || type_codes || ['end'], '|') AS codes, "
        "count(*) AS n_rows FROM silver_orders GROUP BY 1, 2"
    ),
)
def _(spark, d):
    codes = F.concat("completeness_failed_checks", "type_failed_checks", F.array(F.lit("end")))
    return _local(spark, d).groupBy("order_id", F.array_join(codes, "|").alias("codes")).agg(row_count("n_rows"))


@query(
    "f_array_distinct",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'F,x' ELSE concat(o_orderstatus, ',x,F') END AS codes FROM orders",
)
def _(spark, d):
    codes = F.array_distinct(F.array(F.col("o_orderstatus"), F.lit("x"), F.lit("F"), F.lit("x")))
    return td.table(spark, d, "orders").select("o_orderkey", F.array_join(codes, ",").alias("codes"))


@query(
    "f_array_size",
    oracle.query("SELECT len(failed_checks) AS codes, count(*) AS n_rows FROM silver_orders GROUP BY 1"),
)
def _(spark, d):
    size = F.size("failed_checks").cast("bigint").alias("codes")
    return td.silver(spark, d, "orders").groupBy(size).agg(row_count("n_rows"))


@query(
    "f_array_contains",
    oracle.query(
        "SELECT list_contains(failed_checks, 'business:orders.order_not_before_signup') AS early, count(*) AS n_rows "
        "FROM silver_orders GROUP BY 1"
    ),
)
def _(spark, d):
    early = F.array_contains("failed_checks", "business:orders.order_not_before_signup")
    return td.silver(spark, d, "orders").groupBy(early.alias("early")).agg(row_count("n_rows"))


@query("f_explode", oracle.query(f"SELECT code, count(*) AS n_rows FROM {_UNNESTED} GROUP BY 1"))
def _(spark, d):
    return _codes(spark, d).groupBy("code").agg(row_count("n_rows"))


@query("f_null_default", oracle.query("SELECT customer_id, coalesce(email, customer_name) AS contact FROM raw_customers"))
def _(spark, d):
    return td.customers(spark, d).select("customer_id", F.coalesce("email", "customer_name").alias("contact"))


@query("f_null_on_equal", "SELECT l_orderkey, l_linenumber, NULLIF(l_discount, 0.0) AS discount FROM lineitem")
def _(spark, d):
    return td.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.nullif("l_discount", F.lit(0.0)).alias("discount")
    )


@query(
    "f_conditional",
    "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 1000 THEN 'low' ELSE 'high' END AS band FROM customer",
)
def _(spark, d):
    balance = F.col("c_acctbal")
    band = F.when(balance < 0, "debt").when(balance < 1000, "low").otherwise("high")
    return td.table(spark, d, "customer").select("c_custkey", band.alias("band"))


@query("f_membership", "SELECT p_partkey, p_type FROM part WHERE p_type IN ('PROMO', 'SMALL')")
def _(spark, d):
    return td.table(spark, d, "part").where(F.col("p_type").isin("PROMO", "SMALL")).select("p_partkey", "p_type")


@query(
    "f_null_safe_equal",
    oracle.query(
        "SELECT (payment_date IS NOT DISTINCT FROM order_date) AS same_day, count(*) AS n_rows FROM raw_orders GROUP BY 1"
    ),
)
def _(spark, d):
    same = F.col("payment_date").eqNullSafe(F.col("order_date"))
    return td.orders(spark, d).groupBy(same.alias("same_day")).agg(row_count("n_rows"))


@query("f_row_id", "SELECT count(*) AS n_rows, count(*) AS ids FROM lineitem")
def _(spark, d):
    per_id = with_row_id(td.table(spark, d, "lineitem")).groupBy(ROW_ID).agg(row_count("n"))
    return per_id.agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("ids"))
