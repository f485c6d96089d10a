"""The catalogue of runnable queries and the SQL their results are compared with."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from saleslake.operators.lookup import checkpoint_folder
from saleslake.sources.lake import released

#: Rows of a file that ``landed`` writes. A split counts each file as 4 MB at least, so that a task reads some 30 files and
#: groups about a million rows, however large the table is.
FILE_ROWS = 32_768

Run = Callable[[SparkSession, str], DataFrame]


class Catalog:
    def __init__(self) -> None:
        self.runs: dict[str, Run] = {}
        self.sql: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None) -> Callable[[Run], Run]:
        """Register the decorated function under ``name``."""

        def register(run: Run) -> Run:
            if name in self.runs:
                raise ValueError(f"query {name} is registered twice")
            self.runs[name] = run
            if sql is not None:
                self.sql[name] = sql
            return run

        return register


def scratch(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the cluster's shared checkpoint folder."""
    return f"{checkpoint_folder(spark).rstrip('/')}/saleslake-{purpose}-{uuid.uuid4().hex}"


def landed(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once below the checkpoint folder and read back: what reads it again does not join it again."""
    place = scratch(spark, purpose)
    with released(spark):
        df.write.option("compression", "zstd").option("maxRecordsPerFile", FILE_ROWS).parquet(place)
    return spark.read.schema(df.schema).parquet(place)


def row_count(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)
