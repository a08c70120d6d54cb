"""Registered queries and their DuckDB equivalents."""

from __future__ import annotations

from tickloom.suite import evaluation, indicators, intraday, labels, preparation, storage, tables

_PARTS = [tables, storage, preparation, indicators, intraday, labels, evaluation]


def queries():
    return {name: fn for part in _PARTS for name, (fn, _) in part.QUERIES.items()}


def oracle_sql():
    return {
        name: sql for part in _PARTS for name, (_, sql) in part.QUERIES.items() if sql is not None
    }
