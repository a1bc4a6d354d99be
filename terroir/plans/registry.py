"""All queries of the library's own operators, and their SQL."""

from __future__ import annotations

from terroir.plans import analysis, evidence, files, names, scalars, streams, trends

MODULES = (analysis, scalars, names, evidence, trends, files, streams)


def queries() -> dict:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
