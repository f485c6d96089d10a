"""Entity contracts: what a source file must look like, declared without touching Spark data.

A contract is pure data. Everything else (schemas, the type rules, the ingest guards) is derived
from it, so a field is described exactly once.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

from saleslake.errors import ContractError

ROW_ID = "_ingest_row_id"

_SPARK_TYPES = {
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "STRING": T.StringType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "DECIMAL(18,2)": T.DecimalType(18, 2),
}

# Types whose text form can fail to parse and then lands as NULL.
PARSED_TYPES = ("INT", "BIGINT", "DATE", "DECIMAL(18,2)")


def spark_type(name: str) -> T.DataType:
    """The Spark type of a declared type name; unknown names are an error."""
    if name not in _SPARK_TYPES:
        raise ContractError(f"type {name!r} is not one of {sorted(_SPARK_TYPES)}")
    return _SPARK_TYPES[name]


@dataclass(frozen=True)
class EntityContract:
    """One source entity: ordered typed columns plus who owns which kind of defect."""

    table: str
    filename: str
    columns: tuple[tuple[str, str], ...]
    key: str
    required: tuple[str, ...]
    optional: tuple[str, ...] = ()
    domains: tuple[tuple[str, tuple[str, ...]], ...] = ()
    parents: tuple[tuple[str, str], ...] = ()
    names: tuple[str, ...] = field(init=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "names", tuple(name for name, _ in self.columns))

    def schema(self) -> T.StructType:
        """Every source column is nullable: defects have to be able to land."""
        return T.StructType([T.StructField(n, spark_type(t), True) for n, t in self.columns])

    def typed_null_fields(self) -> tuple[str, ...]:
        """Parsed columns whose NULL belongs to the type module: not required, not optional."""
        return tuple(
            n
            for n, t in self.columns
            if t in PARSED_TYPES and n not in self.required and n not in self.optional
        )

    def with_domains(self, **domains: tuple[str, ...]) -> "EntityContract":
        """The same contract with other closed value lists."""
        return replace(self, domains=tuple(domains.items()))

    def with_long_keys(self) -> "EntityContract":
        """The same contract with 64-bit keys, for sources whose ids are beyond 2^31."""
        keys = {self.key, *(name for name, _ in self.parents)}
        return replace(self, columns=tuple((n, "BIGINT" if n in keys else t) for n, t in self.columns))


# Column names, types, order, file names and closed domains of the three entities.
CUSTOMERS = EntityContract(
    table="customers",
    filename="customers.csv",
    columns=(
        ("customer_id", "INT"),
        ("customer_name", "STRING"),
        ("email", "STRING"),
        ("country", "STRING"),
        ("signup_date", "DATE"),
        ("customer_segment", "STRING"),
        ("lifetime_value", "DECIMAL(18,2)"),
    ),
    key="customer_id",
    required=("email", "customer_id"),
    domains=(("customer_segment", ("Premium", "Standard", "Basic")),),
)
ORDERS = EntityContract(
    table="orders",
    filename="orders.csv",
    columns=(
        ("order_id", "INT"),
        ("customer_id", "INT"),
        ("order_date", "DATE"),
        ("product_id", "INT"),
        ("quantity", "INT"),
        ("unit_price", "DECIMAL(18,2)"),
        ("total_amount", "DECIMAL(18,2)"),
        ("order_status", "STRING"),
        ("payment_date", "DATE"),
    ),
    key="order_id",
    required=("customer_id", "product_id", "order_id"),
    optional=("payment_date",),
    domains=(("order_status", ("Pending", "Completed", "Cancelled")),),
    parents=(("customer_id", "customers"), ("product_id", "products")),
)
PRODUCTS = EntityContract(
    table="products",
    filename="products.csv",
    columns=(
        ("product_id", "INT"),
        ("product_name", "STRING"),
        ("category", "STRING"),
        ("price", "DECIMAL(18,2)"),
        ("cost", "DECIMAL(18,2)"),
        ("stock_quantity", "INT"),
        ("reorder_level", "INT"),
    ),
    key="product_id",
    required=("product_id",),
)
CONTRACTS = {c.table: c for c in (CUSTOMERS, ORDERS, PRODUCTS)}

AUDIT_TABLE = "ingest_metadata"
AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("ingest_id", T.StringType(), False),
        T.StructField("source_file", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("row_count", T.LongType(), False),
        T.StructField("ingested_at", T.TimestampType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("error_message", T.StringType(), True),
    ]
)

# The CSV dialect. A token that does not parse becomes NULL and its row stays.
# enforceSchema=false makes Spark compare the header of every part file with the schema as well.
CSV_DIALECT = {
    "header": "true",
    "mode": "PERMISSIVE",
    "dateFormat": "yyyy-MM-dd",
    "nullValue": "",
    "emptyValue": "",
    "encoding": "UTF-8",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "multiLine": "false",
    "inferSchema": "false",
    "enforceSchema": "false",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def contract_for(table: str) -> EntityContract:
    if table not in CONTRACTS:
        raise ContractError(f"no contract for table {table!r}; known: {sorted(CONTRACTS)}")
    return CONTRACTS[table]
