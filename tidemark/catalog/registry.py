"""Named queries and their SQL."""

from __future__ import annotations

import importlib
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.catalog.fixtures import FIXTURES, PLANNED, TABLES

MODULES = ("jobs", "versions", "snapshots", "lookups", "work", "classes", "histories", "storage", "stored", "declared")
_PLACEHOLDER = re.compile(r"\{(\w+)\}")


class Inputs:
    """Test tables and fixtures as attributes, read when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._known: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES and name not in FIXTURES:
            raise AttributeError(name)
        if name not in self._known:
            self._known[name] = self._load(name)
        return self._known[name]

    def _load(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        text = PLANNED.get(name) or FIXTURES[name]
        return self.spark.sql(text, **{n: getattr(self, n) for n in _PLACEHOLDER.findall(text)})


_FUNCTIONS: dict[str, Callable[[Inputs], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of ``Inputs`` under its name, with its SQL over the same inputs."""

    def register(function: Callable[[Inputs], DataFrame]):
        name = function.__name__
        _FUNCTIONS[name] = function
        if sql is not None:
            _SQL[name] = sql
        return function

    return register


def _with_fixtures(sql: str) -> str:
    """The SQL behind the fixtures it names, innermost first."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in FIXTURES and name not in ordered:
            for inner in _PLACEHOLDER.findall(FIXTURES[name]):
                visit(inner)
            ordered.append(name)

    for word in re.findall(r"\w+", sql):
        visit(word)
    parts = [f"{n} AS ({_PLACEHOLDER.sub(r'\1', FIXTURES[n]).strip()})" for n in ordered]
    body = sql.strip()
    if not parts:
        return body
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body


def _load_all() -> None:
    for module in MODULES:
        importlib.import_module(f"tidemark.catalog.{module}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()

    def bind(function):
        return lambda spark, folder: function(Inputs(spark, folder))

    return {name: bind(function) for name, function in _FUNCTIONS.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {name: _with_fixtures(sql) for name, sql in _SQL.items()}
