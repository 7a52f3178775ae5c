"""Query registry: each name maps to a Spark builder and, where SQL can express
it on the whole tables, the equivalent DuckDB statement used as oracle.

Both sides round DOUBLE outputs to 9 decimals (input data carries at most
7 decimals, so exact values never sit on a rounding boundary) (and turn -0.0 into 0.0) and
return integers as BIGINT, so results compare exactly across engines.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 9
SCALE = 10.0**DIGITS  # both engines: round(x * SCALE) / SCALE, half away from zero


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doubles: list[str] = field(default_factory=list)
    ids: str = ""


REGISTRY: dict[str, Query] = {}


def finish(df: DataFrame) -> DataFrame:
    """Round DOUBLE columns, widen integer columns to BIGINT."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double") * F.lit(SCALE), 0) / F.lit(SCALE) + F.lit(0.0)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        cols.append(c.alias(f.name))
    return df.select(*cols)


_NUM = re.compile(r"(?<![\w.])(\d+\.\d+(?:[eE][+-]?\d+)?|\d+[eE][+-]?\d+)(?![\w.])")


def double_literals(sql: str) -> str:
    """Decimal literals outside quotes become DOUBLE, as PySpark float literals
    are; otherwise DuckDB does exact DECIMAL arithmetic and ties break apart."""
    parts = re.split(r"('(?:[^']|'')*')", sql)
    return "".join(p if i % 2 else _NUM.sub(r"CAST(\1 AS DOUBLE)", p) for i, p in enumerate(parts))


def rounded_sql(sql: str, doubles: list[str]) -> str:
    sql = double_literals(sql)
    if not doubles:
        return sql
    repl = ", ".join(f"round(CAST({c} AS DOUBLE) * {SCALE!r}) / {SCALE!r} + 0.0 AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({repl}) FROM ({sql}) AS q"


def query(name: str, sql: str | None = None, doubles: list[str] | None = None, ids: str = ""):
    """Register ``fn(spark, sf_dir) -> DataFrame``; ``doubles`` names the DOUBLE
    output columns the SQL side rounds; ``ids`` lists SURVEY operator ids."""

    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        def build(spark: SparkSession, sf: str) -> DataFrame:
            return finish(fn(spark, sf))

        build.__name__ = fn.__name__
        build.__doc__ = fn.__doc__
        REGISTRY[name] = Query(name, build, rounded_sql(sql, doubles or []) if sql else None, doubles or [], ids)
        return fn

    return deco
