"""Flagging rows: five modules that accumulate codes on the row and never drop or change one."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from saleslake.errors import QualityError
from saleslake.functions.expressions import NO_CODES_SQL, any_sql, codes_sql, row_digest
from saleslake.operators import compare, rules as R
from saleslake.operators.canonical import canonical
from saleslake.operators.lookup import MAX_BROADCAST_ROWS, KeySet, key_statistics, lookup, marked
from saleslake.operators.rules import MODULES, QualitySpec, rules_for
from saleslake.sources.contracts import ROW_ID

#: Buckets of rows whose digests are compared, and rows that an error names.
BUCKETS, NAMED = 4096, 3

# The quality columns of a flagged table.
PASS_COLUMN = {
    R.COMPLETENESS: "completeness_pass",
    R.UNIQUENESS: "uniqueness_pass",
    R.TYPE: "type_validation_pass",
    R.RI: "referential_integrity_pass",
    R.BUSINESS: "business_logic_pass",
}
CODES_COLUMN = {
    R.COMPLETENESS: "completeness_failed_checks",
    R.UNIQUENESS: "uniqueness_failed_checks",
    R.TYPE: "type_failed_checks",
    R.RI: "referential_integrity_failed_checks",
    R.BUSINESS: "business_logic_failed_checks",
}
ALL_CODES = "failed_checks"
RESULT = "quality_check_result"
PASS = "PASS"
FAIL = "FAIL"
_ORPHAN = "_orphan"
_BROKEN = "_broken"
#: Columns that joins add; conditions without one need only the row itself.
_HELPERS = (R.DUPLICATED, R.CUSTOMER_KEY, R.CUSTOMER_SIGNUP, R.PRODUCT_KEY)
QUALITY_COLUMNS = (*PASS_COLUMN.values(), *CODES_COLUMN.values(), ALL_CODES, RESULT)


def source_columns(df: DataFrame) -> list[str]:
    """Everything that is not a quality attribute: source columns and the row id."""
    return [c for c in df.columns if c not in QUALITY_COLUMNS]


def require_columns(df: DataFrame, columns: Sequence[str], purpose: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise QualityError(f"{purpose} needs columns {missing}; present: {df.columns}")


def require_row_id(df: DataFrame) -> None:
    require_columns(df, [ROW_ID], "quality flagging (row identity)")


def customer_parents(customers: DataFrame) -> DataFrame:
    """One row per known customer id with the signup date of its earliest row."""
    first = canonical(customers, "customer_id", ["signup_date"])
    return first.select(
        F.col("customer_id").alias(R.CUSTOMER_KEY), F.col("signup_date").alias(R.CUSTOMER_SIGNUP)
    )


def product_parents(products: DataFrame) -> DataFrame:
    """The known product ids."""
    known = products.where(F.col("product_id").isNotNull())
    return known.select(F.col("product_id").alias(R.PRODUCT_KEY)).distinct()


def _with_helpers(
    df: DataFrame,
    table: str,
    modules: Sequence[str],
    spec: QualitySpec,
    customers: DataFrame | None,
    products: DataFrame | None,
    max_broadcast_rows: int,
    own: Sequence[str] = (),
) -> DataFrame:
    """Add the helper columns the modules read. Customers are joined once for both RI and business.

    ``own`` are conditions over the row itself. Where rows are shuffled, the bits of ``_BROKEN`` say before that which of them
    hold, so that the columns they read travel only if they are asked for.

    All that the joins need to know of the keys is taken from ``df`` in one pass, before any of them. Of products only
    their existence counts: where they are too many to broadcast, rows meet the keys without a product.
    """
    limit = {"max_broadcast_rows": max_broadcast_rows}
    parents: list[tuple[str, DataFrame, str, int]] = []
    existing: dict[str, DataFrame] = {}
    if table == "orders" and (R.RI in modules or R.BUSINESS in modules):
        if customers is None:
            raise QualityError("flagging orders needs all raw customers rows")
        known = customer_parents(customers)
        parents.append(("customer_id", known, R.CUSTOMER_KEY, customers.count()))
    if table == "orders" and R.RI in modules:
        if products is None:
            raise QualityError("referential integrity of orders needs all raw products rows")
        rows = products.count()
        if rows > max_broadcast_rows and df.schema["product_id"].dataType == products.schema["product_id"].dataType:
            existing["product_id"] = products.select("product_id")
        else:
            parents.append(("product_id", product_parents(products), R.PRODUCT_KEY, rows))

    keys = [key for key, _, _, rows in parents if rows > max_broadcast_rows] + list(existing)
    if R.UNIQUENESS in modules:
        keys.append(spec.contract(table).key)
    statistics = key_statistics(df, keys, existing) if keys else None
    sets = []
    if R.UNIQUENESS in modules:
        key = spec.contract(table).key
        sets.append(KeySet(key, R.DUPLICATED, statistics.copies(key), statistics.known[key]))
    for key in existing:
        sets.append(KeySet(key, _ORPHAN, statistics.orphans(key), statistics.orphaned[key]))
    if own and any(rows > max_broadcast_rows for rows in [*(p[3] for p in parents), *(s.known for s in sets)]):
        bits = " | ".join(f"CASE WHEN {condition} THEN {1 << i}L ELSE 0L END" for i, condition in enumerate(own))
        df = df.withColumn(_BROKEN, F.expr(bits))
    if sets:
        df = marked(df, sets, statistics.total, **limit)
    for key in existing:
        df = df.withColumn(R.PARENT_KEYS[key], F.when(~F.col(_ORPHAN), F.col(key)))
    for key, known, parent_key, rows in parents:
        seen = {"counts": statistics.copies(key), "total": statistics.total} if key in keys else {}
        df = lookup(df, known, key, parent_key, other_rows=rows, **limit, **seen)
    return df


def apply_modules(
    df: DataFrame,
    table: str,
    modules: Sequence[str],
    *,
    spec: QualitySpec | None = None,
    customers: DataFrame | None = None,
    products: DataFrame | None = None,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Every input row plus the code array and pass flag of each module.

    A module that was applied before keeps its codes: new ones are merged in, none is replaced.
    """
    spec = spec or QualitySpec()
    require_row_id(df)
    ruleset = {m: rules_for(table, m, spec) for m in modules}
    for module, rules in ruleset.items():
        require_columns(df, [c for r in rules for c in r.columns], f"{module} on {table}")

    kept = list(df.columns)
    own = [r.violated for rules in ruleset.values() for r in rules if not any(h in r.violated for h in _HELPERS)][:62]
    wide = _with_helpers(df, table, modules, spec, customers, products, max_broadcast_rows, own)
    if _BROKEN in wide.columns:
        known = {condition: f"{_BROKEN} & {1 << i}L <> 0L" for i, condition in enumerate(own)}
        ruleset = {m: [replace(r, violated=known.get(r.violated, r.violated)) for r in rules] for m, rules in ruleset.items()}
    added: dict[str, str] = {}
    for module, rules in ruleset.items():
        codes, ok = CODES_COLUMN[module], PASS_COLUMN[module]
        found = codes_sql([(rule.violated, rule.code) for rule in rules])
        if codes in kept:
            added[codes] = f"array_distinct(concat(coalesce({codes}, {NO_CODES_SQL}), {found}))"
            added[ok] = f"size({added[codes]}) = 0"
        else:
            added[codes] = found
            added[ok] = f"NOT {any_sql([rule.violated for rule in rules])}"
    untouched = [f"`{c}`" for c in kept if c not in added]
    return wide.selectExpr(*untouched, *[f"{value} AS {name}" for name, value in added.items()])


def combine(df: DataFrame) -> DataFrame:
    """All codes in module order and the verdict: FAIL exactly when there is a code."""
    require_row_id(df)
    require_columns(df, list(CODES_COLUMN.values()), "combining quality modules")
    failed = any_sql([f"NOT {PASS_COLUMN[m]}" for m in MODULES])
    codes = ", ".join(f"coalesce({CODES_COLUMN[m]}, {NO_CODES_SQL})" for m in MODULES)
    return df.selectExpr(
        *[f"`{c}`" for c in df.columns if c not in (ALL_CODES, RESULT)],
        f"CASE WHEN {failed} THEN array_distinct(concat({codes})) ELSE {NO_CODES_SQL} END AS {ALL_CODES}",
        f"CASE WHEN {failed} THEN '{FAIL}' ELSE '{PASS}' END AS {RESULT}",
    )


def flag(
    df: DataFrame,
    table: str,
    *,
    spec: QualitySpec | None = None,
    customers: DataFrame | None = None,
    products: DataFrame | None = None,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """All five modules and the verdict."""
    flagged = apply_modules(
        df,
        table,
        MODULES,
        spec=spec,
        customers=customers,
        products=products,
        max_broadcast_rows=max_broadcast_rows,
    )
    return combine(flagged)


def count_and_digest(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows and an order-insensitive digest of some columns: equal multisets give equal rows."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(row_digest(columns)), F.lit(0)).cast("decimal(38,0)").alias("digest"),
    )


def assert_same_rows(before: DataFrame, after: DataFrame, what: str, exact_share: float = 0.0) -> int:
    """Row count and source values of two layers must agree; returns the row count.

    Each side is read once for a digest per bucket of rows (``row_digest``). The rows of buckets that differ
    are compared exactly, and the error names some of them. Beyond that, ``exact_share`` of the buckets
    that agree are compared exactly too (1.0: all rows), for changes that a digest could miss.
    """
    columns = source_columns(before)
    require_columns(after, columns, what)
    sides = (compare.bucket_digests(df, columns, row_digest(columns), BUCKETS) for df in (before, after))
    found = compare.differing_buckets(*sides).first()
    chosen = found["buckets"] or list(range(round(BUCKETS * exact_share)))
    rows = f"{found['rows_left']} rows became {found['rows_right']}"
    if chosen:
        changed = compare.bucket_difference(before, after, columns, BUCKETS, chosen).limit(NAMED).collect()
        if changed:
            lost = found["rows_left"] != found["rows_right"]
            named = "; ".join(_named(r) for r in changed)
            raise QualityError(f"{what}: {rows if lost else 'source values changed'}, for example {named}")
    if found["buckets"]:  # the exact comparison has the last word
        raise QualityError(f"{what}: {rows}, and digests differ where rows do not; a layer changed while it was read")
    return found["rows_left"]


def _named(row) -> str:
    """A row of a difference by its row id, or by its first column (the key) where it has none."""
    values = row.asDict()
    name = ROW_ID if ROW_ID in values else row.__fields__[0]
    return f"{name} {values[name]} ({values['only_left']} only before, {values['only_right']} only after)"
