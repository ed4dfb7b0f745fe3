"""The traffic queries over the given tables, and their SQL twins."""

from __future__ import annotations

from . import ingestion, space, streams, tables, writes

MODULES = (tables, ingestion, space, streams, writes)


def queries() -> dict:
    return {name: fn for m in MODULES for name, fn in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
