"""Collects the registered queries with their SQL counterparts."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ticketloom.catalogue.ctes import CTES
from ticketloom.sources.sample_views import Views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
_SHARED: dict[tuple[str, str], Views] = {}


def _views(spark: SparkSession, folder: str) -> Views:
    """One set of views per application and folder, so that fitted models are shared between queries."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _SHARED:
        _SHARED[key] = Views(spark, folder)
    return _SHARED[key]


def _needed(body: str) -> list[str]:
    """Common table expressions a statement uses, dependencies first."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in order and re.search(rf"\b{name}\b", text):
                visit(CTES[name])
                order.append(name)

    visit(body)
    return order


def expand(body: str) -> str:
    body = body.strip()
    parts = [f"{name} AS ({CTES[name].strip()})" for name in _needed(body)]
    if body.upper().startswith("WITH "):
        recursive, rest = "", body[5:]
        if rest.upper().startswith("RECURSIVE "):
            recursive, rest = "RECURSIVE ", rest[10:]
        return f"WITH {recursive}" + ",\n".join([*parts, rest])
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def query(name: str, sql: str | None = None):
    """Register ``fn(views)`` under ``name``."""

    def register(fn: Callable[[Views], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(_views(spark, folder))
        if sql is not None:
            ORACLES[name] = expand(sql)
        return fn

    return register
