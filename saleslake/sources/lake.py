"""Tables of the lake: names, schemas, full-refresh writes and introspection."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from saleslake.sources import journal
from saleslake.sources.journal import table_exists

LAYERS = ("bronze", "silver", "gold")
#: Between the name of a table and the mark of a write that is not checked yet.
STAGED = "__staged_"


@dataclass(frozen=True)
class LakeConfig:
    """Where sources and layers live.

    ``location`` is only needed when the schemas must not use the default warehouse; it has to be
    a path all executors share.
    """

    data_path: str = ""
    catalog: str | None = None
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    table_format: str = "parquet"
    location: str | None = None

    def schema_name(self, layer: str) -> str:
        name = {"bronze": self.bronze, "silver": self.silver, "gold": self.gold}[layer]
        return f"{self.catalog}.{name}" if self.catalog else name

    def table(self, layer: str, table: str) -> str:
        return f"{self.schema_name(layer)}.{table}"

    def source(self, filename: str) -> str:
        return f"{self.data_path.rstrip('/')}/{filename}"


#: The setting by which Spark deletes the shuffle files of an execution when it ends.
_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Frames made and written inside leave no shuffle files: what was written is read instead, so nothing asks for them again."""
    before = spark.conf.get(_RELEASE, None)
    spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.unset(_RELEASE) if before is None else spark.conf.set(_RELEASE, before)


def ensure_schema(spark: SparkSession, config: LakeConfig, layer: str) -> str:
    """Create the layer's schema when it is missing; returns its name."""
    name = config.schema_name(layer)
    if config.location:
        spark.sql(
            "CREATE SCHEMA IF NOT EXISTS IDENTIFIER(:name) LOCATION :place",
            args={"name": name, "place": f"{config.location.rstrip('/')}/{layer}"},
        )
    else:
        spark.sql("CREATE SCHEMA IF NOT EXISTS IDENTIFIER(:name)", args={"name": name})
    return name


def stage_table(
    spark: SparkSession, df: DataFrame, config: LakeConfig, layer: str, table: str, by: str | None = None
) -> str:
    """Write ``df`` beside the table under a name of its own, for checks before ``swap``; ``by``: a partition column."""
    ensure_schema(spark, config, layer)
    name = f"{config.table(layer, table)}{STAGED}{uuid.uuid4().hex[:12]}"
    writer = df.write.mode("errorifexists").format(config.table_format)
    if config.table_format == "parquet":
        writer = writer.option("compression", "zstd")
    with released(spark):
        (writer.partitionBy(by) if by else writer).saveAsTable(name)
    return name


def drop_tables(spark: SparkSession, names: list[str]) -> None:
    for name in names:
        journal.drop(spark, name)


def swap(spark: SparkSession, staged: Mapping[str, str]) -> None:
    """Put staged tables in place of tables (qualified name -> staged name), all or none; see ``journal``."""
    journal.commit(spark, staged)


def recover(spark: SparkSession, config: LakeConfig, *layers: str) -> dict[str, str]:
    """End the swaps that a lost driver left half done; every refresh of a layer begins with this."""
    found = {}
    for layer in layers or LAYERS:
        found |= journal.recover(spark, config.schema_name(layer))
    return found


def leftovers(spark: SparkSession, config: LakeConfig, layer: str) -> list[str]:
    """Staged tables that a driver lost before its swap left behind. While another run writes, they may be its own."""
    schema = config.schema_name(layer)
    if not spark.catalog.databaseExists(schema):
        return []
    return [f"{schema}.{t.name}" for t in spark.catalog.listTables(schema) if STAGED in t.name]


def overwrite_table(
    spark: SparkSession, df: DataFrame, config: LakeConfig, layer: str, table: str
) -> str:
    """Full refresh of one table, schema included; returns the qualified name."""
    recover(spark, config, layer)
    name = config.table(layer, table)
    swap(spark, {name: stage_table(spark, df, config, layer, table)})
    return name


def append_table(
    spark: SparkSession, df: DataFrame, config: LakeConfig, layer: str, table: str
) -> str:
    ensure_schema(spark, config, layer)
    name = config.table(layer, table)
    df.write.mode("append").format(config.table_format).saveAsTable(name)
    return name


def read_table(spark: SparkSession, config: LakeConfig, layer: str, table: str) -> DataFrame:
    return spark.table(config.table(layer, table))


def relation(spark: SparkSession, rows: list[tuple], schema: StructType | str) -> DataFrame:
    """A small typed in-memory relation (literal domains, audit rows, empty frames)."""
    return spark.createDataFrame(rows, schema)


def table_info(spark: SparkSession, name: str) -> DataFrame:
    """One row: table_name, table_exists, table_format."""
    if not table_exists(spark, name):
        return spark.createDataFrame(
            [(name, False, None)], "table_name string, table_exists boolean, table_format string"
        )
    described = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:name)", args={"name": name})
    return described.where(F.col("col_name") == "Provider").select(
        F.lit(name).alias("table_name"),
        F.lit(True).alias("table_exists"),
        F.lower("data_type").alias("table_format"),
    )
