"""Registered queries: one Spark callable per operator, with its DuckDB SQL.

``queries()`` maps a key to ``fn(spark, sf_dir) -> DataFrame``;
``oracle_sql()`` maps the same key to the SQL that states the expected
result over the driver tables (entity views in front).  Keys without SQL are
checked on row counts only.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tierline.oracle import with_entities

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}

MODULES = ["core", "scans", "landing", "transforms", "quality", "runlog",
           "queue", "publish", "flows"]


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"query {name} registered twice")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


def _load() -> None:
    for m in MODULES:
        importlib.import_module(f"tierline.checks.{m}")


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: with_entities(v) for k, v in _SQL.items()}
