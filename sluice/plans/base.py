"""How queries are registered: a function and, where SQL can say the same, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r4(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded, integers as long, dates as text, so that engines agree; negative zero becomes zero."""
    kinds = {"double": lambda c: F.round(c, digits) + F.lit(0.0), "float": lambda c: F.round(c.cast("double"), digits) + F.lit(0.0), "int": lambda c: c.cast("long"), "date": lambda c: c.cast("string")}
    return df.select(*(kinds.get(t, lambda c: c)(F.col(f"`{n}`")).alias(n) for n, t in df.dtypes))


def col_date(c: str | Column) -> Column:
    return F.col(c).cast("date") if isinstance(c, str) else c.cast("date")
