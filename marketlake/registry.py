"""Named table functions: ``fn(spark, **arguments) -> DataFrame``."""

from __future__ import annotations

import importlib
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from .sources.paths import quoted

TableFunction = Callable[..., DataFrame | None]
_functions: dict[str, TableFunction] = {}


def table_function(name: str) -> Callable[[TableFunction], TableFunction]:
    """Register the decorated function under ``name``."""

    def register(fn: TableFunction) -> TableFunction:
        if name in _functions:
            raise ValueError(f"table function {name!r} is already registered")
        _functions[name] = fn
        return fn

    return register


def load(module: str) -> list[str]:
    """Import a module for the functions it registers; returns all known names."""
    importlib.import_module(module)
    return names()


def names() -> list[str]:
    return sorted(_functions)


def call(spark: SparkSession, name: str, **arguments: Any) -> DataFrame:
    """Run a table function. None counts as an empty frame; anything else is an error."""
    if name not in _functions:
        raise KeyError(f"no table function {name!r}; known: {names()}")
    result = _functions[name](spark, **arguments)
    if result is None:
        return spark.createDataFrame([], "struct<>")
    if not isinstance(result, DataFrame):
        raise TypeError(f"{name} returned {type(result).__name__}, not a DataFrame")
    return result


def sql_function(spark: SparkSession, name: str, arguments: Mapping[str, str], columns: Mapping[str, str], query: str) -> None:
    """Make ``select * from name(...)`` run ``query``, with typed arguments by place or by name.

    ``arguments`` and ``columns`` give names and types; a type may be followed by ``default`` and a value. The query
    names its arguments as ``name.argument`` where a column has the same name. It becomes part of the plan of
    the query that calls it, so filters and columns reach its scans, and an argument may itself be a table's column
    in a lateral join. The function lasts as long as the session; one of the same name is replaced.
    """
    typed = lambda pairs: ", ".join(f"{quoted(n)} {kind}" for n, kind in pairs.items())
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {quoted(name)}({typed(arguments)}) RETURNS TABLE ({typed(columns)}) RETURN {query}")
