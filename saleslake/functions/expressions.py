"""Column expressions shared by the operators. All of them stay JVM-side."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"
RATIO = "decimal(7,4)"
CODES = "array<string>"


def quality_code(module: str, table: str, rule: str) -> str:
    return f"{module}:{table}.{rule}"


def no_codes() -> Column:
    """A typed empty array; a bare array() would be array<void>."""
    return F.array().cast(CODES)


def truth(condition: Column) -> Column:
    """A condition that is never NULL: unknown counts as not violated."""
    return F.coalesce(condition, F.lit(False))


def sql_text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


NO_CODES_SQL = f"CAST(array() AS {CODES})"


def any_sql(conditions: Sequence[str]) -> str:
    """True when one of the conditions holds; never NULL."""
    parts = " OR ".join(f"({c})" for c in conditions)
    return f"coalesce({parts}, false)" if parts else "false"


def codes_sql(pairs: Sequence[tuple[str, str]]) -> str:
    """SQL of the codes whose condition holds, in the given order.

    Rows without any violation, nearly all of them, skip the array work.
    """
    single = [f"CASE WHEN {c} THEN array({sql_text(code)}) ELSE {NO_CODES_SQL} END" for c, code in pairs]
    if len(single) < 2:
        return single[0] if single else NO_CODES_SQL
    some = any_sql([c for c, _ in pairs])
    return f"CASE WHEN {some} THEN concat({', '.join(single)}) ELSE {NO_CODES_SQL} END"


def codes_where(pairs: Sequence[tuple[str, str]]) -> Column:
    """The codes whose SQL condition holds; a condition that is NULL does not hold."""
    return F.expr(codes_sql(pairs))


def merge_codes(*arrays: Column) -> Column:
    """Union of code arrays: order kept, duplicates and NULL arrays dropped."""
    return F.array_distinct(F.concat(*[F.coalesce(a, no_codes()) for a in arrays]))


def null_codes(table: str, fields: Sequence[str], module: str) -> Column:
    """One code per NULL field. The empty string is a value, not NULL."""
    return codes_where([(f"{f} IS NULL", quality_code(module, table, f)) for f in fields])


def outside(column: str, allowed: Sequence[str]) -> str:
    """Condition: non-null and not in a short literal list; exact match, nothing trimmed or folded."""
    return f"{column} IS NOT NULL AND {column} NOT IN ({', '.join(map(sql_text, allowed))})"


def domain_codes(table: str, column: str, allowed: Sequence[str], module: str) -> Column:
    return codes_where([(outside(column, allowed), quality_code(module, table, f"{column}_domain"))])


def orphan(column: str, parent_key: str) -> str:
    """Condition: a non-null foreign key for which the lookup found no parent."""
    return f"{column} IS NOT NULL AND {parent_key} IS NULL"


def orphan_codes(table: str, column: str, parent_key: str, module: str) -> Column:
    return codes_where([(orphan(column, parent_key), quality_code(module, table, f"{column}_orphan"))])


def money_average(total: str, count: str) -> Column:
    """Total over count, exact, half-up to cents; NULL for a count of zero."""
    return F.expr(f"CAST(CAST({total} AS {MONEY}) / CAST(nullif({count}, 0) AS {MONEY}) AS {MONEY})")


def ratio_sql(part: str, whole: str) -> str:
    """Share as DECIMAL(7,4), ties to even; an empty population gives 0.0000."""
    share = f"CAST({part} AS decimal(20,0)) / CAST(nullif({whole}, 0) AS decimal(20,0))"
    return f"CAST(coalesce(bround({share}, 4), 0) AS {RATIO})"


def ratio(part: str, whole: str) -> Column:
    return F.expr(ratio_sql(part, whole))


def line_total(quantity: Column, price: Column) -> Column:
    """Exact decimal product of an integer quantity and a price."""
    return quantity.cast(MONEY) * price


def week_start(day: Column) -> Column:
    """The Monday of the week of a civil date."""
    return F.date_trunc("WEEK", day).cast("date")


def bin_floor(value: Column, width: int) -> Column:
    """Lower edge of the bin of the given width."""
    return (F.floor(value / F.lit(width)) * F.lit(width)).cast("bigint")


def equals_or_any(column: Column, wanted: Any) -> Column:
    """Optional filter: everything for None, else null-safe equality."""
    return F.lit(True) if wanted is None else column.eqNullSafe(F.lit(wanted))


def row_digest(columns: Sequence[str]) -> Column:
    """64-bit digest of a row as DECIMAL(28,0): a sum of it is DECIMAL(38,0), which 1e18 equal rows
    cannot overflow.

    The hash skips NULLs, so which columns are NULL is hashed as well. Equal digests of two tables are
    strong evidence, not proof; ``operators.compare`` has the exact comparison.
    """
    nulls = F.array(*[F.col(c).isNull() for c in columns])
    return F.xxhash64(*columns, nulls).cast("decimal(28,0)")
