"""Queries over the test tables, each with its SQL counterpart where it has one."""

from catalogue import enrichment, graphs, growing, learning, predicates, profiles, quality, selection, tables, texts

MODULES = [tables, predicates, quality, enrichment, profiles, texts, graphs, learning, selection, growing]


def queries():
    """All queries by name."""
    return {name: fn for module in MODULES for name, fn in module.entries.queries.items()}


def oracle_sql():
    """SQL by query name."""
    return {name: sql for module in MODULES for name, sql in module.entries.sql.items()}
