"""Helpers shared by the operators of this subpackage: words, row identity, written intermediates."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A word is a run of other characters than these six white-space characters.
SPACE = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"\x20\x09-\x0D"
NO_ID = -(2**63)


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; without it, one inside the warehouse is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def written(df: DataFrame, purpose: str, *by: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder, in a folder per value of ``by``, and read back.

    This cuts the lineage: whatever executor is lost later, the rows are read again and not computed
    again. The files stay in ``<shared folder>/saleslake-llm/<application>`` until that is removed.
    """
    spark = df.sparkSession
    run = spark.sparkContext.applicationId
    path = f"{shared_folder(spark)}/saleslake-llm/{run}/{purpose}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_written(spark: SparkSession) -> None:
    """Delete what ``written`` left for this application; frames that still read it become unusable."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(
        f"{shared_folder(spark)}/saleslake-llm/{spark.sparkContext.applicationId}"
    )
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def words(text: Column) -> Column:
    """The array of words of a text; NULL has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE_CLASS}]+"), "")


def with_row_identity(df: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` as bytes, and (``rid``, ``th``), which only rows equal in both share.

    Joins back to the documents use (rid, th), so that a NULL or repeated doc_id mixes no texts.
    """
    return df.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *identity(),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )


def boxed(df: DataFrame, *extra: Column) -> DataFrame:
    """All columns of ``df`` as one struct ``_row``, so that no name can clash, beside ``extra``."""
    return df.select(F.struct("*").alias("_row"), *extra)


def identity(doc_id: str = "doc_id", text: str = "text") -> tuple[Column, Column]:
    """(rid, th) of a row, see with_row_identity."""
    return (
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("rid"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("th"),
    )
