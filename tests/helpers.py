from __future__ import annotations

from collections import Counter
from datetime import date
from decimal import Decimal

from saleslake.operators.quality import flag
from saleslake.operators.rules import QualitySpec
from saleslake.sources.contracts import CONTRACTS, ROW_ID
from saleslake.sources.ingest import read_source, with_row_id

D = Decimal


def raw_fixture(spark, fixtures, name):
    """The three entities of a fixture folder as raw frames."""
    return {
        t: with_row_id(read_source(spark, f"{fixtures}/{name}/{c.filename}", c)) for t, c in CONTRACTS.items()
    }


def flag_all(raw, spec=None, **options):
    parents = {t: raw[t] for t in ("customers", "products")}
    return {t: flag(raw[t], t, spec=spec or QualitySpec(), **parents, **options) for t in raw}


def _rows(flagged):
    return flagged if isinstance(flagged, list) else flagged.collect()


def code_counts(flagged):
    """code -> rows that carry it; takes a frame or its collected rows."""
    return dict(Counter(code for r in _rows(flagged) for code in r["failed_checks"]))


def fails(flagged):
    return sum(r["quality_check_result"] == "FAIL" for r in _rows(flagged))


def failed_orders(rows):
    """order id -> codes of the failing orders."""
    return {r["order_id"]: r["failed_checks"] for r in rows if r["failed_checks"]}


def customers(spark, *rows):
    """Rows of (id, email, signup, segment, value); the row id is the position."""
    schema = CONTRACTS["customers"].schema().add(ROW_ID, "long")
    full = [(r[0], "n", r[1], "c", r[2], r[3], r[4], i) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, schema)


def orders(spark, *rows):
    """Rows in contract order; the row id is the position."""
    schema = CONTRACTS["orders"].schema().add(ROW_ID, "long")
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], schema)


def products(spark, *ids):
    schema = CONTRACTS["products"].schema().add(ROW_ID, "long")
    return spark.createDataFrame([(p, "p", "c", D("1.00"), D("1.00"), 1, 1, i) for i, p in enumerate(ids)], schema)


def good_order(order_id, customer_id=1, product_id=100, **changes):
    row = {
        "order_id": order_id,
        "customer_id": customer_id,
        "order_date": date(2024, 6, 1),
        "product_id": product_id,
        "quantity": 1,
        "unit_price": D("10.00"),
        "total_amount": D("10.00"),
        "order_status": "Completed",
        "payment_date": date(2024, 6, 2),
    }
    row.update(changes)
    return tuple(row[c] for c in CONTRACTS["orders"].names)


def good_customer(customer_id=1, signup=date(2024, 1, 1), email="a@example.com"):
    return (customer_id, email, signup, "Premium", D("1.00"))
