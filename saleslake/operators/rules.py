"""The row rules, as one declarative list per table.

A rule is a code and a SQL condition that is true for a violation. Each kind of failure has one
owner: a NULL key is completeness, another NULL typed value is type, a non-null key without
parent is referential integrity, and business rules skip rows whose operands are NULL.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from saleslake.errors import ContractError
from saleslake.functions.expressions import MONEY, orphan, outside, quality_code
from saleslake.sources.contracts import CONTRACTS, EntityContract

COMPLETENESS = "completeness"
UNIQUENESS = "uniqueness"
TYPE = "type"
RI = "ri"
BUSINESS = "business"
MODULES = (COMPLETENESS, UNIQUENESS, TYPE, RI, BUSINESS)

# The as-of day of the business rules and the tolerance of the amount rule.
AS_OF = date(2026, 8, 31)
TOLERANCE = "0.01"

# Helper columns that the lookups of the quality module add before the rules are evaluated.
DUPLICATED = "_duplicated"
CUSTOMER_KEY = "_parent_customer_id"
CUSTOMER_SIGNUP = "_parent_signup_date"
PRODUCT_KEY = "_parent_product_id"
PARENT_KEYS = {"customer_id": CUSTOMER_KEY, "product_id": PRODUCT_KEY}


@dataclass(frozen=True)
class QualitySpec:
    """Contracts and the as-of day one quality run works with."""

    contracts: dict[str, EntityContract] = field(default_factory=lambda: dict(CONTRACTS))
    as_of: date = AS_OF

    def contract(self, table: str) -> EntityContract:
        if table not in self.contracts:
            raise ContractError(f"no quality rules for table {table!r}")
        return self.contracts[table]


@dataclass(frozen=True)
class Rule:
    """A named violation: a SQL condition over the row; NULL means not violated."""

    module: str
    table: str
    name: str
    violated: str
    columns: tuple[str, ...]

    @property
    def code(self) -> str:
        return quality_code(self.module, self.table, self.name)


def _business(table: str, as_of: date) -> list[tuple[str, str, tuple[str, ...]]]:
    """name, condition, source columns; comparisons with NULL operands do not fire."""
    if table == "customers":
        return [
            ("signup_not_future", f"signup_date > DATE'{as_of}'", ("signup_date",)),
            ("lifetime_value_non_negative", "lifetime_value < 0", ("lifetime_value",)),
        ]
    if table == "products":
        return [
            ("price_non_negative", "price < 0", ("price",)),
            ("cost_non_negative", "cost < 0", ("cost",)),
            ("stock_non_negative", "stock_quantity < 0", ("stock_quantity",)),
            ("reorder_non_negative", "reorder_level < 0", ("reorder_level",)),
        ]
    paid = ("order_status", "payment_date")
    return [
        ("quantity_positive", "quantity <= 0", ("quantity",)),
        ("unit_price_non_negative", "unit_price < 0", ("unit_price",)),
        ("total_amount_non_negative", "total_amount < 0", ("total_amount",)),
        (
            "amount_equals_qty_price",
            f"abs(total_amount - CAST(quantity AS {MONEY}) * unit_price) > {TOLERANCE}",
            ("quantity", "unit_price", "total_amount"),
        ),
        ("completed_has_payment", "order_status = 'Completed' AND payment_date IS NULL", paid),
        ("cancelled_without_payment", "order_status = 'Cancelled' AND payment_date IS NOT NULL", paid),
        ("payment_on_or_after_order", "payment_date < order_date", ("payment_date", "order_date")),
        ("order_not_before_signup", f"order_date < {CUSTOMER_SIGNUP}", ("customer_id", "order_date")),
    ]


def rules_for(table: str, module: str, spec: QualitySpec) -> list[Rule]:
    """The rules of one module on one table, in the order their codes are reported."""
    contract = spec.contract(table)
    if module == COMPLETENESS:
        return [Rule(module, table, c, f"{c} IS NULL", (c,)) for c in contract.required]
    if module == UNIQUENESS:
        key = contract.key
        return [Rule(module, table, key, DUPLICATED, (key,))]
    if module == TYPE:
        domains = [
            Rule(module, table, f"{c}_domain", outside(c, allowed), (c,))
            for c, allowed in contract.domains
        ]
        nulls = [Rule(module, table, c, f"{c} IS NULL", (c,)) for c in contract.typed_null_fields()]
        return domains + nulls
    if module == RI:
        return [
            Rule(module, table, f"{c}_orphan", orphan(c, PARENT_KEYS[c]), (c,))
            for c, _ in contract.parents
        ]
    if module == BUSINESS:
        return [
            Rule(module, table, name, violated, columns)
            for name, violated, columns in _business(table, spec.as_of)
        ]
    raise ContractError(f"unknown quality module {module!r}")


def all_rules(table: str, spec: QualitySpec) -> list[Rule]:
    return [rule for module in MODULES for rule in rules_for(table, module, spec)]
