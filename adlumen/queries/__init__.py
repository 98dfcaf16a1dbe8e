"""Registered queries with the SQL that must give the same rows."""

from __future__ import annotations

from adlumen.queries import quality, ranking, reports, segments, storage, streams, versions
from adlumen.queries.common import decimal_round

_MODULES = (reports, ranking, segments, quality, storage, streams, versions)


def all_queries() -> dict:
    return {name: q for m in _MODULES for name, q in m.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: decimal_round(sql) for m in _MODULES for name, sql in m.SQL.items()}
