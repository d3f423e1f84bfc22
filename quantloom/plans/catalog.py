"""Registry of the engine's queries on the stand-in tables, each beside its DuckDB SQL.

Columns are listed once for both engines: ``~x`` is a double rounded to 6 places, ``#x`` a long,
``%x`` text, a bare name stays as it is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _column(spec: str) -> Column:
    c = F.col(spec.lstrip("~#%"))
    if spec[0] == "~":
        return (F.round(c.cast("double"), 6) + F.lit(0.0)).alias(spec[1:])
    if spec[0] == "#":
        return c.cast("long").alias(spec[1:])
    if spec[0] == "%":
        return c.cast("string").alias(spec[1:])
    return c


def _sql_column(spec: str) -> str:
    c = spec.lstrip("~#%")
    if spec[0] == "~":
        return f"round({c}::DOUBLE, 6) + 0.0 AS {c}"
    if spec[0] == "#":
        return f"{c}::BIGINT AS {c}"
    if spec[0] == "%":
        return f"{c}::VARCHAR AS {c}"
    return c


def query(name: str, columns: str, sql: str | None = None, with_: str = "", tail: str = ""):
    """Register a query; ``with_`` are common table expressions that ``sql`` uses, ``tail`` an order and limit."""
    specs = columns.split()

    def register(f: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: f(spark, sf_dir).select(*map(_column, specs))
        if sql is not None:
            ORACLES[name] = (f"WITH {with_} " if with_ else "") + f"SELECT {', '.join(map(_sql_column, specs))} FROM ({sql}) AS found {tail}"
        return f

    return register


def div(a: str, b: str) -> str:
    return f"(({a})::DOUBLE / nullif(({b})::DOUBLE, 0))"


def pos(a: str, b: str) -> str:
    return f"(CASE WHEN ({b})::DOUBLE > 0 THEN ({a})::DOUBLE / ({b})::DOUBLE END)"


def grow(a: str, b: str) -> str:
    return f"((({a})::DOUBLE - ({b})::DOUBLE) / nullif(abs(({b})::DOUBLE), 0))"


def mean2(a: str, b: str) -> str:
    return f"(CASE WHEN {a} IS NULL THEN ({b})::DOUBLE WHEN {b} IS NULL THEN ({a})::DOUBLE ELSE (({a})::DOUBLE + ({b})::DOUBLE) / 2 END)"


def either(a: str, b: str) -> str:
    """0 falls through like NULL."""
    return f"(CASE WHEN {a} IS NOT NULL AND {a} <> 0 THEN {a} ELSE {b} END)"
