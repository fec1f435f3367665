"""Queries over the driver tables, each beside an independent SQL statement.

A query's result columns are declared once, as 'name:type' words, and both
sides are projected through that declaration: d = date as ISO text, n = double
rounded to six places, f = double cut to four places, i = whole number, b = boolean, s (default) = text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _columns(spec: str) -> list[tuple[str, str]]:
    return [tuple((word + ":s").split(":")[:2]) for word in spec.split()]


def project(df: DataFrame, spec: str) -> DataFrame:
    made = {"d": lambda c: F.date_format(c, "yyyy-MM-dd"),
            "n": lambda c: F.round(c.cast("double"), 6) + F.lit(0.0),
            "f": lambda c: F.floor(c.cast("double") * 10000) / 10000 + F.lit(0.0),
            "i": lambda c: c.cast("bigint"), "b": lambda c: c.cast("boolean"),
            "s": lambda c: c.cast("string")}
    return df.select(*[made[kind](F.col(name)).alias(name) for name, kind in _columns(spec)])


def project_sql(spec: str) -> str:
    made = {"d": "strftime(CAST({0} AS DATE), '%Y-%m-%d')",
            "n": "round(CAST({0} AS DOUBLE), 6) + 0.0",
            "f": "floor(CAST({0} AS DOUBLE) * 10000) / 10000 + 0.0", "i": "CAST({0} AS BIGINT)", "b": "CAST({0} AS BOOLEAN)", "s": "CAST({0} AS VARCHAR)"}
    return ", ".join(made[kind].format(f'"{name}"') + f' AS "{name}"' for name, kind in _columns(spec))


def query(name: str, spec: str, *ctes: str, recursive: bool = False):
    """Register a query; `ctes` are its SQL common tables, the last one `result`."""
    def wrap(build):
        QUERIES[name] = lambda spark, sf: project(build(spark, sf), spec)
        if ctes:
            kind = "WITH RECURSIVE" if recursive else "WITH"
            ORACLES[name] = f"{kind} {', '.join(ctes)} SELECT {project_sql(spec)} FROM result"
        return build
    return wrap
