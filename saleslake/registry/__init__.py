"""All registered queries. Prefixes: s sources, p projections, j joins, a aggregates, w windows,
t sorts, u set operations, f functions, rule rules, q quality, g aggregates tables, d dashboard,
v reconciliation, i planted defects."""

from __future__ import annotations


def _catalogs():
    from saleslake.registry import checks, defects, quality, relational, scalars, serving, sources

    modules = (sources, relational, scalars, quality, serving, checks, defects)
    return [module.catalog for module in modules]


def all_queries():
    return {name: run for c in _catalogs() for name, run in c.runs.items()}


def all_sql():
    return {name: text for c in _catalogs() for name, text in c.sql.items()}
