"""Query catalog: every implemented operator as ``(spark, sf_dir) ->
DataFrame`` plus, where SQL can express it, the equivalent DuckDB SQL over
the driver tables.  The SQL shares the view definitions in ``CTES``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fareflow.plans.quote_view import MODEL_SOURCE_SQL, QUOTE_SQL, REQUOTED_SQL

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}

# Shared oracle views, in dependency order.
CTES: dict[str, str] = {
    "q": QUOTE_SQL,
    "rq": REQUOTED_SQL,
    "m": MODEL_SOURCE_SQL,
}


def add_cte(name: str, sql: str) -> None:
    CTES[name] = sql


def register(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


def with_views(sql: str) -> str:
    body = sql.strip()
    ctes = ",\n".join(f"{k} AS (\n{v.strip()}\n)" for k, v in CTES.items())
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def _load_all() -> None:
    # importing the modules registers their queries
    from fareflow.plans import (queries_core, queries_explore, queries_joins,  # noqa: F401
                                queries_io, queries_misc, queries_ml, queries_models,
                                queries_nested, queries_reports, queries_scalar)


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: with_views(v) for k, v in _SQL.items()}
