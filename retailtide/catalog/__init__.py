"""The registered queries: each report and operator over the driver's tables, with its SQL."""

from __future__ import annotations

from retailtide.catalog import changes, logs, sales, streams, tables

_GROUPS = (sales, logs, changes, tables, streams)


def queries() -> dict:
    return {name: query for group in _GROUPS for name, query in group.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for group in _GROUPS for name, sql in group.ORACLE.items()}
