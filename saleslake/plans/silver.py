"""Building the flagged layer from the raw one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from saleslake.operators.lookup import MAX_BROADCAST_ROWS
from saleslake.operators.metrics import row_metrics, silver_metrics, table_results
from saleslake.operators.quality import apply_modules, assert_same_rows, flag
from saleslake.operators.rules import QualitySpec
from saleslake.sources import lake
from saleslake.sources.contracts import CONTRACTS, contract_for
from saleslake.sources.lake import LakeConfig

METRICS_TABLE = "quality_metrics"


def raw_tables(spark: SparkSession, config: LakeConfig) -> dict[str, DataFrame]:
    return {t: lake.read_table(spark, config, "bronze", t) for t in CONTRACTS}


def silver_frames(
    raw: Mapping[str, DataFrame],
    spec: QualitySpec | None = None,
    tables: Sequence[str] | None = None,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> dict[str, DataFrame]:
    """Flagged frames. Parents are the raw tables, duplicates and bad rows included."""
    parents = {t: raw[t] for t in ("customers", "products")}
    return {
        t: flag(raw[t], t, spec=spec, max_broadcast_rows=max_broadcast_rows, **parents)
        for t in tables or CONTRACTS
    }


def module_metrics(
    raw: Mapping[str, DataFrame],
    module: str,
    spec: QualitySpec | None = None,
    tables: Sequence[str] | None = None,
) -> DataFrame:
    """Stand-alone check of one module on the raw layer: metrics only, nothing is written."""
    frames = []
    for table in tables or CONTRACTS:
        contract_for(table)
        flagged = apply_modules(
            raw[table], table, [module], spec=spec, customers=raw["customers"], products=raw["products"]
        )
        frames.append(row_metrics(flagged, table, spec, modules=[module], outcome=False))
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame)
    return union


def build_silver(
    spark: SparkSession,
    config: LakeConfig,
    *,
    spec: QualitySpec | None = None,
    tables: Sequence[str] | None = None,
    expected: Mapping[tuple[str, str], int] | None = None,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    exact_share: float = 0.0,
) -> DataFrame:
    """Full refresh of the flagged tables and their metrics; returns the result per table.

    Each flagged table is written once, under a staging name. Row and value checks and all metrics read
    the staged tables, so nothing is evaluated from the raw layer a second time; only if all checks pass
    do they replace the old tables, together. ``exact_share``: see ``assert_same_rows``.
    """
    lake.recover(spark, config, "bronze", "silver")
    raw = raw_tables(spark, config)
    staged: dict[str, str] = {}
    try:
        for table, frame in silver_frames(raw, spec, tables, max_broadcast_rows).items():
            name = lake.stage_table(spark, frame, config, "silver", table)
            staged[config.table("silver", table)] = name
            assert_same_rows(raw[table], spark.table(name), f"silver {table}", exact_share)
        written = {t: spark.table(staged[config.table("silver", t)]) for t in tables or CONTRACTS}
        at = datetime.now(timezone.utc)
        metrics = silver_metrics(spark, written, spec, expected).withColumn("computed_at", F.lit(at))
        # 19 to 20 rows per table: one file is right, whatever the size of the data
        name = lake.stage_table(spark, metrics.coalesce(1), config, "silver", METRICS_TABLE)
        staged[config.table("silver", METRICS_TABLE)] = name
        lake.swap(spark, staged)
    except Exception:
        lake.drop_tables(spark, list(staged.values()))
        raise
    return table_results(spark.table(config.table("silver", METRICS_TABLE)))
