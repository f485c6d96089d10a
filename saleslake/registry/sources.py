"""Queries per source and sink operator. CSV sources are written from the test tables first."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from saleslake.errors import IngestError
from saleslake.plans import checks
from saleslake.registry import oracle
from saleslake.registry.catalog import Catalog, row_count, scratch
from saleslake.sources import ingest, journal, lake, testdata as td
from saleslake.sources.contracts import AUDIT_TABLE, CONTRACTS, CUSTOMERS, ORDERS, PRODUCTS, ROW_ID
from saleslake.sources.fingerprints import compare_fingerprints, fingerprint
from saleslake.sources.lake import LakeConfig

catalog = Catalog()
query = catalog.query
RUN_AT = datetime(2026, 1, 1, 12, tzinfo=timezone.utc)


def export(df: DataFrame, path: str) -> str:
    """Write a frame as CSV in the contract's dialect."""
    df.write.options(header="true", nullValue="", emptyValue="", quote='"', escape='"').csv(path)
    return path


def export_entity(spark: SparkSession, d: str, folder: str, table: str) -> None:
    contract = CONTRACTS[table]
    export(td.VIEWS[table](spark, d).select(*contract.names), f"{folder}/{contract.filename}")


def export_all(spark: SparkSession, d: str, place: str) -> str:
    """All three entities as CSV sources; returns their folder."""
    folder = f"{place}/sources"
    for table in CONTRACTS:
        export_entity(spark, d, folder, table)
    return folder


def lake_with(spark: SparkSession, d: str, purpose: str, *tables: str) -> LakeConfig:
    """An empty lake of its own with the named entities as CSV sources."""
    place = scratch(spark, purpose)
    for table in tables:
        export_entity(spark, d, f"{place}/sources", table)
    return LakeConfig(data_path=f"{place}/sources", bronze=f"raw_{place[-8:]}", location=place)


def _outcome(spark: SparkSession, variant: str, attempt) -> DataFrame:
    """variant, accepted, n_rows of an attempt that returns a frame or raises."""
    try:
        counted = attempt().agg(row_count("n_rows"))
        return counted.select(F.lit(variant).alias("variant"), F.lit(True).alias("accepted"), "n_rows")
    except IngestError:
        return spark.createDataFrame([(variant, False, 0)], "variant string, accepted boolean, n_rows bigint")


def _variants(rows: str, *rejected: str) -> str:
    parts = [f"SELECT '{rows.split()[0]}' AS variant, TRUE AS accepted, count(*) AS n_rows FROM {rows.split()[1]}"]
    parts += [f"SELECT '{name}', FALSE, CAST(0 AS BIGINT)" for name in rejected]
    return oracle.query(" UNION ALL ".join(parts))


@query(
    "s_csv_scan",
    oracle.query(
        "SELECT order_id::INTEGER AS order_id, customer_id::INTEGER AS customer_id, order_date, "
        "product_id::INTEGER AS product_id, CASE WHEN order_status = 'Pending' THEN NULL "
        "ELSE quantity END AS quantity, unit_price, CASE WHEN quantity > 40 THEN NULL ELSE total_amount END AS total_amount, "
        "order_status, CASE WHEN order_status = 'Completed' THEN NULL ELSE payment_date END AS payment_date, "
        "count(*) AS n_rows FROM raw_orders GROUP BY ALL"
    ),
)
def _(spark, d):
    # tokens that do not parse: a word as number, two points in an amount, a date in another format
    text = td.orders(spark, d).select(*[F.col(c).cast("string").alias(c) for c in ORDERS.names])
    broken = text.withColumns(
        {
            "quantity": F.when(F.col("order_status") == "Pending", "xyz").otherwise(F.col("quantity")),
            "total_amount": F.when(F.col("quantity").cast("int") > 40, "12.34.56").otherwise(F.col("total_amount")),
            "payment_date": F.when(F.col("order_status") == "Completed", "13/01/2024").otherwise(F.col("payment_date")),
        }
    )
    path = export(broken, scratch(spark, "scan"))
    return ingest.read_source(spark, path, ORDERS).groupBy(*ORDERS.names).agg(row_count("n_rows"))


@query("s_header_check", _variants("contract raw_products", "reordered", "renamed", "missing", "extra"))
def _(spark, d):
    products = td.products(spark, d).select(*PRODUCTS.names)
    names = list(PRODUCTS.names)
    variants = {
        "contract": products,
        "reordered": products.select(*reversed(names)),
        "renamed": products.withColumnRenamed("cost", "costs"),
        "missing": products.drop("cost"),
        "extra": products.withColumn("margin", F.col("price") - F.col("cost")),
    }
    place = scratch(spark, "headers")
    return checks.union(
        [
            _outcome(spark, n, lambda p=export(df, f"{place}/{n}"): ingest.read_source(spark, p, PRODUCTS))
            for n, df in variants.items()
        ]
    )


@query("s_bom_check", _variants("plain raw_products", "marked"))
def _(spark, d):
    products = td.products(spark, d).select(*PRODUCTS.names)
    variants = {"plain": products, "marked": products.withColumnRenamed("product_id", "\ufeffproduct_id")}
    place = scratch(spark, "marks")
    return checks.union(
        [
            _outcome(spark, n, lambda p=export(df, f"{place}/{n}"): ingest.read_source(spark, p, PRODUCTS))
            for n, df in variants.items()
        ]
    )


@query("s_source_guard", _variants("present raw_products", "missing", "empty"))
def _(spark, d):
    place = scratch(spark, "guard")
    export(td.products(spark, d).select(*PRODUCTS.names), f"{place}/present")
    td.products(spark, d).select("product_name").where(F.col("product_name").isNull()).write.text(f"{place}/empty")
    return checks.union(
        [
            _outcome(spark, n, lambda n=n: ingest.read_source(spark, f"{place}/{n}", PRODUCTS))
            for n in ("present", "missing", "empty")
        ]
    )


def _land(spark: SparkSession, config: LakeConfig, table: str) -> DataFrame:
    ingest.ingest_entity(spark, config, table, ingest_id="run", at=RUN_AT)
    return lake.read_table(spark, config, "bronze", table)


@query("s_header_only", _variants("rows raw_customers", "header_only"))
def _(spark, d):
    full = lake_with(spark, d, "full", "customers")
    place = scratch(spark, "header-only")
    nobody = td.customers(spark, d).select(*CUSTOMERS.names).where(F.col("customer_id") < 0)
    export(nobody.coalesce(1), f"{place}/sources/{CUSTOMERS.filename}")
    empty = LakeConfig(data_path=f"{place}/sources", bronze=f"raw_{place[-8:]}", location=place)
    return _outcome(spark, "rows", lambda: _land(spark, full, "customers")).unionByName(
        _outcome(spark, "header_only", lambda: _land(spark, empty, "customers"))
    )


@query(
    "s_preflight",
    oracle.query(
        "SELECT 'before' AS moment, 0 AS tables, CAST(0 AS BIGINT) AS n_rows UNION ALL "
        "SELECT 'after', 4, (SELECT count(*) FROM raw_customers) + (SELECT count(*) FROM raw_orders) "
        "+ (SELECT count(*) FROM raw_products)"
    ),
)
def _(spark, d):
    config = lake_with(spark, d, "preflight", "customers", "products")
    lake.ensure_schema(spark, config, "bronze")

    def tables() -> int:
        return len(spark.catalog.listTables(config.schema_name("bronze")))

    try:
        ingest.ingest_all(spark, config)
    except IngestError:
        pass
    before = tables()
    export_entity(spark, d, config.data_path, "orders")
    landed = ingest.ingest_all(spark, config)
    rows = [("before", before, 0), ("after", tables(), sum(t.rows for t in landed))]
    return spark.createDataFrame(rows, "moment string, tables int, n_rows bigint")


@query("s_row_id", oracle.query("SELECT count(*) AS n_rows, count(*) AS ids FROM raw_orders"))
def _(spark, d):
    orders = ingest.with_row_id(td.orders(spark, d).drop(ROW_ID))
    per_id = orders.groupBy(ROW_ID).agg(row_count("n"))
    return per_id.agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("ids"))


@query(
    "s_table_sink",
    oracle.query("SELECT product_id, product_name, category, price FROM raw_products"),
)
def _(spark, d):
    config = lake_with(spark, d, "sink")
    products = td.products(spark, d)
    lake.overwrite_table(spark, products.drop("price"), config, "bronze", "products")
    name = lake.overwrite_table(spark, products, config, "bronze", "products")
    return spark.table(name).select("product_id", "product_name", "category", "price")


@query("s_write_reconcile", oracle.query("SELECT count(*) AS rows_read, count(*) AS rows_written FROM raw_orders"))
def _(spark, d):
    config = lake_with(spark, d, "reconcile", "orders")
    landed = ingest.ingest_entity(spark, config, "orders")
    written = lake.read_table(spark, config, "bronze", "orders")
    return written.agg(F.lit(landed.rows).cast("bigint").alias("rows_read"), row_count("rows_written"))


@query(
    "s_swap_recovery",
    oracle.query(
        "SELECT 'finished' AS swap, category, count(*) AS n_rows FROM raw_products WHERE price > 1500 GROUP BY 2 "
        "UNION ALL SELECT 'undone', category, count(*) FROM raw_products GROUP BY 2"
    ),
)
def _(spark, d):
    """Swaps that end after half of their renames: one is finished, one is undone, by the next run."""
    products, found = td.products(spark, d), []
    for name in ("finished", "undone"):
        config = lake_with(spark, d, f"swap-{name}")
        table = lake.overwrite_table(spark, products, config, "bronze", "products")
        new = lake.stage_table(spark, products.where("price > 1500"), config, "bronze", "products")
        step = journal.Step(table, new, f"{table}__old", True)
        journal.Journal(spark, config.schema_name("bronze")).begin("lost", [step])
        journal.rename(spark, table, step.old)
        if name == "undone":  # the staged table is lost too
            lake.drop_tables(spark, [new])
        ended = lake.recover(spark, config, "bronze")["lost"]
        rows = lake.read_table(spark, config, "bronze", "products").groupBy("category").agg(row_count("n_rows"))
        found.append(rows.select(F.lit(ended).alias("swap"), "category", "n_rows"))
    return checks.union(found)


def _audit(spark: SparkSession, config: LakeConfig) -> DataFrame:
    return lake.read_table(spark, config, "bronze", AUDIT_TABLE)


@query(
    "s_audit_success",
    oracle.query(
        "SELECT 'run' AS ingest_id, 'products' AS table_name, count(*) AS row_count, 'SUCCESS' AS status, "
        "DATE '2026-01-01' AS ingested_on, TRUE AS without_error FROM raw_products"
    ),
)
def _(spark, d):
    config = lake_with(spark, d, "audit", "products")
    _land(spark, config, "products")
    return _audit(spark, config).select(
        "ingest_id",
        "table_name",
        "row_count",
        "status",
        F.col("ingested_at").cast("date").alias("ingested_on"),
        F.col("error_message").isNull().alias("without_error"),
    )


@query(
    "s_audit_failed",
    oracle.query(
        "SELECT 'SUCCESS' AS status, count(*) AS row_count, FALSE AS with_error FROM raw_products "
        "UNION ALL SELECT 'FAILED', CAST(0 AS BIGINT), TRUE"
    ),
)
def _(spark, d):
    config = lake_with(spark, d, "failed", "products")
    _land(spark, config, "products")
    try:
        _land(spark, config, "customers")
    except IngestError:
        pass
    return _audit(spark, config).select("status", "row_count", F.col("error_message").isNotNull().alias("with_error"))


@query(
    "s_ingest_entity",
    oracle.query(
        "SELECT customer_id::INTEGER AS customer_id, customer_name, email, country, signup_date, customer_segment, lifetime_value FROM raw_customers"
    ),
)
def _(spark, d):
    return _land(spark, lake_with(spark, d, "entity", "customers"), "customers").select(*CUSTOMERS.names)


@query(
    "s_ingest_all",
    oracle.query(
        "SELECT 'customers' AS table_name, count(*) AS row_count, 'SUCCESS' AS status, CAST(1 AS BIGINT) AS runs FROM raw_customers "
        "UNION ALL SELECT 'orders', count(*), 'SUCCESS', 1 FROM raw_orders "
        "UNION ALL SELECT 'products', count(*), 'SUCCESS', 1 FROM raw_products"
    ),
)
def _(spark, d):
    config = lake_with(spark, d, "all", *CONTRACTS)
    ingest.ingest_all(spark, config)
    audit = _audit(spark, config)
    runs = audit.agg(F.count_distinct("ingest_id").alias("runs")).first()["runs"]
    return audit.select("table_name", "row_count", "status", F.lit(runs).cast("bigint").alias("runs"))


@query("s_table_scan", oracle.query("SELECT category, count(*) AS n_rows FROM raw_products GROUP BY 1"))
def _(spark, d):
    config = lake_with(spark, d, "tables")
    lake.overwrite_table(spark, td.products(spark, d), config, "silver", "products")
    return lake.read_table(spark, config, "silver", "products").groupBy("category").agg(row_count("n_rows"))


@query(
    "s_schema_ddl",
    oracle.query("SELECT TRUE AS existed, count(*) AS n_rows FROM raw_products"),
)
def _(spark, d):
    config = lake_with(spark, d, "ddl")
    for _ in range(2):
        name = lake.ensure_schema(spark, config, "bronze")
    lake.overwrite_table(spark, td.products(spark, d), config, "bronze", "products")
    rows = lake.read_table(spark, config, "bronze", "products").agg(row_count("n_rows"))
    return rows.select(F.lit(spark.catalog.databaseExists(name)).alias("existed"), "n_rows")


@query(
    "s_relation",
    oracle.query(
        "SELECT s.segment, CAST(count(c.customer_id) AS BIGINT) AS customers FROM "
        "(VALUES ('BUILDING'), ('AUTOMOBILE'), ('MACHINERY'), ('FURNITURE'), ('PREMIUM')) s(segment) "
        "LEFT JOIN raw_customers c ON c.customer_segment = s.segment GROUP BY 1"
    ),
)
def _(spark, d):
    domain = lake.relation(spark, [(s,) for s in (*td.SEGMENTS, "PREMIUM")], "segment string")
    counts = td.customers(spark, d).groupBy(F.col("customer_segment").alias("segment")).agg(row_count("n"))
    return domain.join(counts, "segment", "left").select("segment", F.coalesce("n", F.lit(0)).alias("customers"))


@query(
    "s_table_info",
    oracle.query(
        "SELECT 'products' AS entity, TRUE AS table_exists, 'parquet' AS table_format, count(*) AS n_rows FROM raw_products "
        "UNION ALL SELECT 'absent', FALSE, NULL, 0"
    ),
)
def _(spark, d):
    config = lake_with(spark, d, "info")
    name = lake.overwrite_table(spark, td.products(spark, d), config, "bronze", "products")
    rows = {"products": spark.table(name).count(), "absent": 0}
    return checks.union(
        [
            lake.table_info(spark, config.table("bronze", t)).select(
                F.lit(t).alias("entity"), "table_exists", "table_format", F.lit(n).cast("bigint").alias("n_rows")
            )
            for t, n in rows.items()
        ]
    )


@query(
    "s_fingerprint",
    "SELECT 'size_bytes' AS what, CAST(sum(strlen(p_name) + 1) AS BIGINT) AS value FROM part "
    "UNION ALL SELECT 'lines', count(*) FROM part UNION ALL SELECT 'same: copy', 1 "
    "UNION ALL SELECT 'same: reordered', 0 UNION ALL SELECT 'same: carriage returns', 0 "
    "UNION ALL SELECT 'same: changed', 0 UNION ALL SELECT 'same: shorter', 0",
)
def _(spark, d):
    """Files with the part names: a copy, one with its lines in another order, one with other line ends, one
    with a changed byte, one without one line. The parts of a variant are compared by number."""
    names = td.table(spark, d, "part").select("p_partkey", F.col("p_name").alias("value"))
    dealt = names.repartition(4, "p_partkey")
    folder = scratch(spark, "fingerprint")
    one = F.col("p_partkey") == names.agg(F.min("p_partkey")).first()[0]
    mark = F.expr("overlay(value PLACING '#' FROM 1 FOR 1)")
    in_order = dealt.sortWithinPartitions("p_partkey")
    variants = {
        "first": (in_order, "\n"),
        "copy": (in_order, "\n"),
        "reordered": (dealt.sortWithinPartitions(F.desc("p_partkey")), "\n"),
        "carriage returns": (in_order, "\r"),
        "changed": (in_order.withColumn("value", F.when(one, mark).otherwise(F.col("value"))), "\n"),
        "shorter": (in_order.where(~one), "\n"),
    }
    number = F.regexp_extract("file_name", r"^part-(\d+)", 1)
    found = {}
    for name, (frame, end) in variants.items():
        place = f"{folder}/{name.replace(' ', '-')}"
        frame.select("value").write.option("lineSep", end).text(place)
        found[name] = fingerprint(spark, place).withColumn("file_name", number)
    first = found.pop("first")
    totals = first.agg(*(F.sum(c).alias(c) for c in ("size_bytes", "lines")))
    values = "inline(array(struct('size_bytes' AS what, size_bytes AS value), struct('lines' AS what, lines AS value)))"
    rows = [totals.selectExpr(values)]
    for name, other in found.items():
        same = F.min(F.col("same").cast("int")).cast("bigint").alias("value")
        compared = compare_fingerprints(first, other).agg(same)
        rows.append(compared.select(F.lit(f"same: {name}").alias("what"), "value"))
    return checks.union(rows)
