"""Registry of queries and their SQL checks.

A query declares its output once, e.g. ``"user_id:l sku score:d2"``. The same declaration
casts and rounds the Spark result and wraps the SQL text, so both sides agree on names
and types: l bigint, d double (6 digits), dN double (N digits), b boolean, s text.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.testdata import Tables
from .sql_views import VIEWS


@dataclass(frozen=True)
class Query:
    ids: tuple[str, ...]
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def _fields(out: str):
    for item in out.split():
        name, _, kind = item.partition(":")
        yield name, kind or "s"


def _spark_column(name, kind):
    c = F.col(name)
    if kind == "l":
        c = c.cast("long")
    elif kind[0] == "d":
        c = F.round(c.cast("double"), int(kind[1:] or 6)) + F.lit(0.0)
    elif kind == "b":
        c = c.cast("boolean")
    else:
        c = c.cast("string")
    return c.alias(name)


def _sql_column(name, kind):
    if kind == "l":
        e = f"CAST({name} AS BIGINT)"
    elif kind[0] == "d":
        e = f"round(CAST({name} AS DOUBLE), {int(kind[1:] or 6)}) + 0.0"
    elif kind == "b":
        e = f"CAST({name} AS BOOLEAN)"
    else:
        e = f"CAST({name} AS VARCHAR)"
    return f"{e} AS {name}"


def with_views(sql: str, local: str = "") -> str:
    """Prefix the views (and their dependencies) that a statement mentions."""
    needed: list[str] = []

    def visit(text):
        for name, body in VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(body)
                if name not in needed:
                    needed.append(name)

    visit(sql + " " + local)
    parts = [f"{n} AS ({VIEWS[n].strip()})" for n in needed]
    if local:
        parts.append(local.strip().rstrip(","))
    keyword = "WITH RECURSIVE " if "_walk AS (" in local else "WITH "
    return (keyword + ",\n".join(parts) + "\n" if parts else "") + sql


_TABLES: dict[tuple[str, str], Tables] = {}


def tables_for(spark: SparkSession, path: str) -> Tables:
    """One Tables object per application and directory, so frames common to several queries are built once."""
    key = (spark.sparkContext.applicationId, path)
    if key not in _TABLES:
        for old in _TABLES.values():
            for frame in old.__dict__.values():
                if isinstance(frame, DataFrame) and frame.is_cached and frame.sparkSession is spark:
                    frame.unpersist()
        _TABLES.clear()
        _TABLES[key] = Tables(spark, path)
    return _TABLES[key]


def forget(spark: SparkSession) -> None:
    """Drop shared frames and their cached blocks (used between measurements)."""
    _TABLES.clear()
    spark.catalog.clearCache()


def once(fn):
    """Build a shared frame once per Tables object, so its plan is analysed once."""
    key = f"_once_{fn.__module__}.{fn.__name__}"

    def get(t: Tables):
        if key not in t.__dict__:
            t.__dict__[key] = fn(t)
        return t.__dict__[key]

    get.__name__ = fn.__name__
    return get


def query(ids: str, out: str, sql: str | None = None, local: str = "", name: str | None = None):
    """Register ``fn(t: Tables) -> DataFrame`` under the lower-case first id and its name."""

    def add(fn):
        idlist = tuple(ids.split())
        key = name or f"{idlist[0].lower()}_{fn.__name__}"
        fields = list(_fields(out))

        def run(spark: SparkSession, path: str) -> DataFrame:
            return fn(tables_for(spark, path)).select(*[_spark_column(n, k) for n, k in fields])

        text = None
        if sql is not None:
            cols = ", ".join(_sql_column(n, k) for n, k in fields)
            text = with_views(f"SELECT {cols} FROM (\n{sql.strip()}\n) q", local)
        assert key not in QUERIES, key
        QUERIES[key] = Query(idlist, run, text)
        return fn

    return add
