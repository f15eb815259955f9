"""All registered queries and their SQL counterparts."""

from __future__ import annotations

from vecferry.plans import catalog, filters, loads, rows, search, streams

FLAGSHIP = "migrate_customer"
_PARTS = (catalog, rows, filters, loads, search, streams)


def queries() -> dict:
    return {name: query for part in _PARTS for name, query in part.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
