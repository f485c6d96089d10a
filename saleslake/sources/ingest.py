"""Landing CSV sources as raw tables: guards, permissive typed scan, row ids, audit rows."""

from __future__ import annotations

import csv
import logging
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from itertools import chain, islice

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from saleslake.errors import IngestError
from saleslake.sources import lake
from saleslake.sources.contracts import (
    AUDIT_SCHEMA,
    AUDIT_TABLE,
    CONTRACTS,
    CSV_DIALECT,
    ROW_ID,
    EntityContract,
    contract_for,
)
from saleslake.sources.lake import LakeConfig

LOG = logging.getLogger(__name__)

SUCCESS = "SUCCESS"
FAILED = "FAILED"
ERROR_TEXT_LIMIT = 2000
BOM = b"\xef\xbb\xbf"
#: Part files whose headers are read at a time, and faulty ones that an error names.
READERS, NAMED = 64, 3


@dataclass(frozen=True)
class Landed:
    table: str
    source: str
    target: str
    rows: int
    ingest_id: str
    ingested_at: datetime


def source_files(spark: SparkSession, path: str) -> DataFrame:
    """path and length of the file(s) behind a source; lists metadata only, reads no bytes."""
    try:
        return spark.read.format("binaryFile").load(path).select("path", "length")
    except AnalysisException as error:
        raise IngestError(f"source {path} was not found or cannot be listed") from error


def check_source(spark: SparkSession, path: str) -> Iterator[str]:
    """The non-empty files of a source, in order and a few at a time; it must have one."""
    found = source_files(spark, path).where("length > 0").select("path").orderBy("path")
    paths = (row["path"] for row in found.toLocalIterator())
    first = next(paths, None)
    if first is None:
        raise IngestError(f"source {path} is empty; an empty table will not be written")
    return chain([first], paths)


def first_line(spark: SparkSession, file: str) -> bytes:
    """The first line of a file on any file system Spark can read, decompressed, undecoded."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(file)
    stream = place.getFileSystem(conf).open(place)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
        raw = codec.createInputStream(stream) if codec else stream
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(raw, "ISO-8859-1")).readLine()
    finally:
        stream.close()
    return (line or "").encode("latin-1")


def header_names(line: bytes) -> list[str]:
    """The names of a header line; a byte-order mark stays in front of the first name."""
    text = line.decode("utf-8", errors="replace")
    return next(csv.reader([text], delimiter=CSV_DIALECT["sep"], quotechar=CSV_DIALECT["quote"]), [])


def check_headers(spark: SparkSession, path: str, contract: EntityContract) -> None:
    """Every part file must have the contract's header, and none a byte-order mark.

    Only headers are read, READERS files at a time; what is kept of them are the first NAMED faults.
    """
    files = check_source(spark, path)
    problems: list[str] = []
    with ThreadPoolExecutor(READERS) as pool:
        while (some := list(islice(files, READERS))) and len(problems) < NAMED:
            for file, line in zip(some, pool.map(lambda f: first_line(spark, f), some), strict=True):
                try:
                    check_header(header_names(line), contract, file)
                except IngestError as error:
                    problems.append(str(error))
    if problems:
        raise IngestError("; ".join(problems[:NAMED]))


def check_header(names: list[str], contract: EntityContract, path: str) -> None:
    """Names and their order have to equal the contract; the error lists the difference."""
    if any("\ufeff" in name for name in names):
        raise IngestError(f"the header of {path} starts with a byte-order mark (BOM)")
    expected = list(contract.names)
    if list(names) == expected:
        return
    missing = [n for n in expected if n not in names]
    extra = [n for n in names if n not in expected]
    raise IngestError(
        f"header mismatch for {contract.table} in {path}: expected {expected}, found {names}; "
        f"Missing: {missing}; Extra: {extra}"
    )


def read_source(spark: SparkSession, path: str, contract: EntityContract) -> DataFrame:
    """The guarded scan: header checked, then every row with the declared types."""
    check_headers(spark, path, contract)
    return scan_csv(spark, path, contract)


def scan_csv(spark: SparkSession, path: str, contract: EntityContract) -> DataFrame:
    return spark.read.schema(contract.schema()).options(**CSV_DIALECT).csv(path)


def with_row_id(df: DataFrame) -> DataFrame:
    """Physical-row identity: unique within one write, meaningless across writes."""
    if ROW_ID in df.columns:
        raise IngestError(f"the source already has a column {ROW_ID}; lineage is not overwritten")
    return df.withColumn(ROW_ID, F.monotonically_increasing_id())


def preflight(spark: SparkSession, config: LakeConfig) -> None:
    """Check all sources before any table is touched; all problems are reported together."""
    problems = []
    for contract in CONTRACTS.values():
        path = config.source(contract.filename)
        try:
            check_headers(spark, path, contract)
        except IngestError as error:
            problems.append(str(error))
    if problems:
        raise IngestError("no table was written; " + " | ".join(problems))


def audit(
    spark: SparkSession,
    config: LakeConfig,
    *,
    ingest_id: str,
    source: str,
    table: str,
    rows: int,
    at: datetime,
    status: str,
    error: str | None = None,
) -> None:
    """Append one row to the audit table."""
    row = (ingest_id, source, table, rows, at, status, error)
    lake.append_table(
        spark, lake.relation(spark, [row], AUDIT_SCHEMA), config, "bronze", AUDIT_TABLE
    )


def error_text(error: Exception) -> str:
    return f"{type(error).__name__}: {error}"[:ERROR_TEXT_LIMIT]


def _stage(
    spark: SparkSession, config: LakeConfig, table: str, ingest_id: str, at: datetime, checked: bool
) -> tuple[str, Landed]:
    """Land one source under a staging name and reconcile it; the data is scanned once, by the write.

    The row count comes from an observation on that write. Any failure leaves an audit row, no
    staged table, and is raised as an IngestError.
    """
    contract = contract_for(table)
    source = config.source(contract.filename)
    rows, staged = 0, None
    try:
        raw = (scan_csv if checked else read_source)(spark, source, contract)
        if raw.isEmpty():
            raise IngestError(f"source {source} has a header but 0 data rows")
        seen = Observation(f"ingest_{table}")
        observed = with_row_id(raw).observe(seen, F.count(F.lit(1)).alias("rows"))
        staged = lake.stage_table(spark, observed, config, "bronze", table)
        read = seen.get["rows"]
        rows = spark.table(staged).count()
        if rows != read:
            raise IngestError(f"{staged} holds {rows} rows but {read} were read")
    except Exception as error:
        if staged:
            lake.drop_tables(spark, [staged])
        _audit_failure(spark, config, ingest_id, source, table, rows, at, error)
        if isinstance(error, IngestError):
            raise
        raise IngestError(f"{table} could not be landed from {source}: {error_text(error)}") from error
    return staged, Landed(table, source, config.table("bronze", table), rows, ingest_id, at)


def _audit_failure(spark, config, ingest_id, source, table, rows, at, error) -> None:
    try:
        audit(spark, config, ingest_id=ingest_id, source=source, table=table, rows=rows, at=at,
              status=FAILED, error=error_text(error))
    except Exception:  # the original problem matters more than its audit row
        LOG.exception("no audit row for the failed ingest of %s", table)


def _land(
    spark: SparkSession, config: LakeConfig, tables, ingest_id: str | None, at: datetime | None, checked: bool = False
) -> list[Landed]:
    """Stage all tables, then swap them in together; the old tables stay until all are checked.

    checked: the headers of the sources were read just before.
    """
    lake.recover(spark, config, "bronze")
    ingest_id = ingest_id or str(uuid.uuid4())
    at = at or datetime.now(timezone.utc)
    staged: dict[str, str] = {}
    landed = []
    try:
        for table in tables:
            name, one = _stage(spark, config, table, ingest_id, at, checked)
            staged[one.target] = name
            landed.append(one)
        try:
            lake.swap(spark, staged)
        except Exception as error:
            for one in landed:
                _audit_failure(spark, config, ingest_id, one.source, one.table, one.rows, at, error)
            raise IngestError(f"staged tables could not replace the old ones: {error_text(error)}") from error
    except IngestError:
        lake.drop_tables(spark, list(staged.values()))
        raise
    for one in landed:
        audit(spark, config, ingest_id=ingest_id, source=one.source, table=one.table, rows=one.rows, at=at,
              status=SUCCESS)
    return landed


def ingest_entity(
    spark: SparkSession,
    config: LakeConfig,
    table: str,
    *,
    ingest_id: str | None = None,
    at: datetime | None = None,
) -> Landed:
    """Land one source as a full refresh. A failure before the swap leaves the old table as it was."""
    (landed,) = _land(spark, config, [table], ingest_id, at)
    return landed


def ingest_all(
    spark: SparkSession,
    config: LakeConfig,
    *,
    ingest_id: str | None = None,
    at: datetime | None = None,
) -> list[Landed]:
    """Preflight everything, stage all entities under one run id, then swap all of them in."""
    preflight(spark, config)
    return _land(spark, config, list(CONTRACTS), ingest_id, at, checked=True)
