"""Registration of queries with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


class Tables:
    """Column-pruned access to the tables of one directory: ``t.orders``."""

    def __init__(self, spark: SparkSession, directory: str):
        self._spark, self._directory = spark, directory

    def __getattr__(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._directory}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register ``build(tables) -> DataFrame`` under a name."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, directory: build(Tables(spark, directory))
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def rounded(df: DataFrame, digits: int = 6, *columns: str) -> DataFrame:
    """Doubles rounded, so that the order of addition does not show."""
    names = columns or [n for n, kind in df.dtypes if kind == "double"]
    return df.withColumns({n: F.round(n, digits) for n in names})


def text_of(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def sql_number_text(c: str) -> str:
    return f"CASE WHEN {c} = floor({c}) THEN CAST(CAST({c} AS BIGINT) AS VARCHAR) ELSE CAST({c} AS VARCHAR) END"


def sql_differ(a: str, b: str, numeric: bool = True) -> str:
    show = sql_number_text if numeric else (lambda c: c)
    return f"CASE WHEN {a} <> {b} THEN {show(a)} || ' ≠ ' || {show(b)} END"
