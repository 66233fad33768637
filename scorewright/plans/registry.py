"""Registry of named queries: a Spark builder and (if SQL-expressible) a DuckDB twin.

Results leave the registry with every double rounded to ``DIGITS`` places on both
sides (float sums are order dependent across engines); ``doubles`` names those
columns for the SQL side and a test checks it against the Spark schema.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doubles: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, doubles=()):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, tuple(doubles))
        return fn
    return deco


def round_doubles(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
        else F.col(f.name) for f in df.schema.fields])


def spark_callable(q: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return round_doubles(q.build(spark, sf_dir))
    run.__name__ = q.name
    return run


def oracle_text(q: Query) -> str | None:
    if q.sql is None:
        return None
    if not q.doubles:
        return q.sql
    repl = ", ".join(f'round("{c}", {DIGITS}) + 0.0 AS "{c}"' for c in q.doubles)
    return f"SELECT * REPLACE ({repl}) FROM (\n{q.sql}\n) AS oracle_q"
