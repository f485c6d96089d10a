import uuid
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from saleslake.errors import ContractError, IngestError, QualityError, SaleslakeError
from saleslake.plans import gold, silver, staged
from saleslake.sources import ingest, lake
from saleslake.sources.contracts import AUDIT_TABLE, CONTRACTS, CUSTOMERS, ORDERS, ROW_ID, contract_for, spark_type
from saleslake.sources.lake import LakeConfig


@pytest.fixture
def config(fixtures):
    mark = uuid.uuid4().hex[:8]
    return LakeConfig(f"{fixtures}/raw", bronze=f"b_{mark}", silver=f"s_{mark}", gold=f"g_{mark}")


def audit_rows(spark, config):
    return lake.read_table(spark, config, "bronze", AUDIT_TABLE).orderBy("table_name").collect()


def test_contract_types():
    assert [f.nullable for f in ORDERS.schema()] == [True] * 9
    assert ORDERS.schema()["total_amount"].dataType.simpleString() == "decimal(18,2)"
    with pytest.raises(ContractError):
        spark_type("DOUBLE")
    with pytest.raises(ContractError):
        contract_for("returns")


def test_ingest_all_lands_every_row_and_audits(spark, config):
    at = datetime(2026, 8, 31, 12, tzinfo=timezone.utc)
    landed = ingest.ingest_all(spark, config, at=at)
    assert [(x.table, x.rows) for x in landed] == [("customers", 4), ("orders", 6), ("products", 2)]
    assert len({x.ingest_id for x in landed}) == 1
    orders = lake.read_table(spark, config, "bronze", "orders")
    assert orders.columns == [*ORDERS.names, ROW_ID]
    assert orders.select(ROW_ID).distinct().count() == 6
    assert orders.where("customer_id IS NULL").count() == 1
    audit = audit_rows(spark, config)
    assert [(r["table_name"], r["row_count"], r["status"], r["error_message"]) for r in audit] == [
        ("customers", 4, "SUCCESS", None),
        ("orders", 6, "SUCCESS", None),
        ("products", 2, "SUCCESS", None),
    ]
    assert audit[0]["ingested_at"] == at.replace(tzinfo=None)


def test_rerun_replaces_entities_and_appends_audit(spark, config):
    for _ in range(2):
        ingest.ingest_entity(spark, config, "customers")
    assert lake.read_table(spark, config, "bronze", "customers").count() == 4
    audit = audit_rows(spark, config)
    assert len(audit) == 2 and len({r["ingest_id"] for r in audit}) == 2


@pytest.mark.parametrize(
    "folder, words",
    [("bad_header", ["Missing", "customer_id", "Extra", "name"]), ("header_only", ["0 data rows"])],
)
def test_bad_sources_fail_and_are_audited(spark, fixtures, config, folder, words):
    bad = LakeConfig(f"{fixtures}/{folder}", bronze=config.bronze)
    with pytest.raises(IngestError) as error:
        ingest.ingest_entity(spark, bad, "customers")
    assert all(w in str(error.value) for w in words)
    (row,) = audit_rows(spark, config)
    assert (row["status"], row["row_count"]) == ("FAILED", 0) and words[0] in row["error_message"]
    assert not lake.table_exists(spark, config.table("bronze", "customers"))


def test_a_failed_run_keeps_the_old_table(spark, fixtures, config):
    ingest.ingest_entity(spark, config, "customers")
    with pytest.raises(IngestError):
        ingest.ingest_entity(spark, LakeConfig(f"{fixtures}/header_only", bronze=config.bronze), "customers")
    assert lake.read_table(spark, config, "bronze", "customers").count() == 4


def test_missing_and_empty_sources(spark, tmp_path):
    with pytest.raises(IngestError, match="not found"):
        ingest.read_source(spark, str(tmp_path / "none.csv"), CUSTOMERS)
    (tmp_path / "empty.csv").write_bytes(b"")
    with pytest.raises(IngestError, match="empty"):
        ingest.read_source(spark, str(tmp_path / "empty.csv"), CUSTOMERS)


def test_byte_order_mark(spark, tmp_path):
    text = ",".join(CUSTOMERS.names) + "\n1,A,a@x,DE,2024-01-01,Basic,1.00\n"
    (tmp_path / "with space.csv").write_bytes(b"\xef\xbb\xbf" + text.encode())
    with pytest.raises(IngestError, match="BOM"):
        ingest.read_source(spark, str(tmp_path / "with space.csv"), CUSTOMERS)


def test_error_text_is_cut():
    assert len(ingest.error_text(ValueError("x" * 5000))) == ingest.ERROR_TEXT_LIMIT


def test_preflight_reports_all_problems_and_writes_nothing(spark, fixtures, config):
    bad = LakeConfig(f"{fixtures}/bad_header", bronze=config.bronze)
    with pytest.raises(IngestError) as error:
        ingest.ingest_all(spark, bad)
    text = str(error.value)
    assert "header mismatch" in text and "orders.csv" in text and "products.csv" in text
    assert not spark.catalog.databaseExists(config.bronze)


def test_permissive_tokens(spark, tmp_path):
    lines = [
        ",".join(CUSTOMERS.names),
        '1," padded ",a@x,"Korea, Republic of",2024-02-30,Basic,10.005',
        "x1,B,,DE,2024-02-29,Basic,1e2",
        "3,C,c@x,DE,01/02/2024,Basic,12.34.56",
        '4,"say ""hi""",d@x',
    ]
    path = tmp_path / "customers.csv"
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    rows = ingest.read_source(spark, str(path), CUSTOMERS).collect()
    assert len(rows) == 4
    assert [r["customer_id"] for r in rows] == [1, None, 3, 4]
    assert [r["customer_name"] for r in rows] == [" padded ", "B", "C", 'say "hi"']
    assert rows[0]["country"] == "Korea, Republic of" and rows[1]["email"] is None
    assert [str(r["signup_date"]) for r in rows] == ["None", "2024-02-29", "None", "None"]
    assert [str(r["lifetime_value"]) for r in rows] == ["10.01", "100.00", "None", "None"]


def test_row_id_is_never_overwritten(spark):
    with pytest.raises(IngestError):
        ingest.with_row_id(spark.range(1).withColumn(ROW_ID, F.lit(1)))


@pytest.mark.parametrize(
    "later",
    [
        b"customer_id,order_id,order_date,product_id,quantity,unit_price,total_amount,order_status,payment_date\n",
        b"\xef\xbb\xbforder_id,customer_id,order_date,product_id,quantity,unit_price,total_amount,order_status,payment_date\n",
        b"order_id\n" + b"1\n" * 5_000,
    ],
)
def test_a_bad_later_part_leaves_all_old_tables(spark, fixtures, config, tmp_path, later):
    ingest.ingest_all(spark, config)
    names = ("customers", "orders", "products")
    before = {t: sorted(map(str, lake.read_table(spark, config, "bronze", t).collect())) for t in names}
    for t in names:
        part = tmp_path / f"{t}.csv"
        part.mkdir()
        with open(config.source(f"{t}.csv"), "rb") as file:
            (part / "part-0.csv").write_bytes(file.read())
    (tmp_path / "orders.csv" / "part-1.csv").write_bytes(later)
    parts = LakeConfig(str(tmp_path), bronze=config.bronze, silver=config.silver, gold=config.gold)
    with pytest.raises(IngestError, match="orders"):
        ingest.ingest_all(spark, parts)
    with pytest.raises(IngestError):
        ingest.ingest_entity(spark, parts, "orders")
    after = {t: sorted(map(str, lake.read_table(spark, config, "bronze", t).collect())) for t in names}
    assert after == before
    tables = {t.name for t in spark.catalog.listTables(config.bronze)}
    assert not any("__" in t for t in tables)


def test_a_failed_guard_leaves_the_old_silver_table(spark, config, monkeypatch):
    ingest.ingest_all(spark, config)
    silver.build_silver(spark, config)
    before = sorted(map(str, lake.read_table(spark, config, "silver", "orders").collect()))

    def broken(raw, new, what, exact_share):
        raise QualityError(what)

    monkeypatch.setattr(silver, "assert_same_rows", broken)
    with pytest.raises(QualityError):
        silver.build_silver(spark, config)
    assert sorted(map(str, lake.read_table(spark, config, "silver", "orders").collect())) == before
    assert not any("__" in t.name for t in spark.catalog.listTables(config.silver))


def test_layers_end_to_end(spark, fixtures, config):
    full = LakeConfig(f"{fixtures}/gold", bronze=config.bronze, silver=config.silver, gold=config.gold)
    expected = {("orders", "uniqueness:orders.order_id"): 2, ("orders", "type"): 0, ("customers", "completeness"): 1}
    numbers = {"orders.rows": 26, "customers.duplicate_rows": 2, "orders.orphan_product_id": 1, "issue_instances": 7}
    found = staged.run(spark, full, expected=expected, expected_profile=numbers)
    failed = found.where("status = 'FAIL'").select("check_name", "expected", "actual").collect()
    assert failed == []
    assert found.count() > 60
    assert lake.read_table(spark, full, "silver", "quality_metrics").count() == 58
    assert lake.read_table(spark, full, "gold", "sales_by_product").count() == 2

    raw = silver.raw_tables(spark, full)
    results = {r["table_name"]: r["fail_rows"] for r in silver.build_silver(spark, full).collect()}
    assert results == {"customers": 3, "orders": 7, "products": 0} and raw["orders"].count() == 26
    assert gold.build_gold(spark, full) == {
        "sales_by_product": 2, "revenue_by_customer": 12, "daily_trends": 3, "weekly_trends": 2,
        "customer_segmentation": 4,
    }


def test_a_run_profiles_its_sources_once(spark, fixtures, config, monkeypatch):
    scanned = []
    scan = staged.scan_csv
    monkeypatch.setattr(staged, "scan_csv", lambda *a: scanned.append(a[2].table) or scan(*a))
    full = LakeConfig(f"{fixtures}/gold", bronze=config.bronze)
    numbers = {"orders.rows": 26, "customers.duplicate_rows": 2}
    found = staged.run(spark, full, stages=("source", "bronze"), expected_profile=numbers)
    assert scanned == ["customers", "orders", "products"]
    assert found.where("status = 'FAIL'").count() == 0
    both = found.where("check_name IN ('source.orders.rows', 'bronze.orders.rows')").collect()
    assert [(r["expected"], r["actual"]) for r in both] == [("26", "26")] * 2
    assert staged.run(spark, full, stages=("bronze",)).where("status = 'FAIL'").count() == 0
    assert len(scanned) == 6


def test_critical_failures_stop_the_run(spark, fixtures, config):
    with pytest.raises(QualityError, match="silver"):
        staged.run(spark, config, stages=("bronze", "silver", "gold"), expected={("orders", "type"): 5})
    assert not spark.catalog.databaseExists(config.gold)
    with pytest.raises(SaleslakeError):
        staged.run(spark, config, stages=("platinum",))


def test_contracts_cover_the_entities():
    assert list(CONTRACTS) == ["customers", "orders", "products"]
