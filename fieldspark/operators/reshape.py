"""Pivoting, unpivoting and splitting lists to rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.functions.text import squish_to_null


def pivot_stats(
    df: DataFrame,
    keys: Sequence[str],
    names_from: str,
    levels: Sequence[str],
    stats: Mapping[str, Column],
) -> DataFrame:
    """One column per statistic and level, named ``<statistic>_<level>``.

    ``levels`` is fixed by the caller, so no pass over the data is spent on finding it. A key
    without rows at a level gets missing values there.
    """
    wide = (
        df.groupBy(*keys)
        .pivot(names_from, list(levels))
        .agg(*[c.alias(name) for name, c in stats.items()])
    )
    # with one statistic Spark names the columns by level alone
    def made(level: str, name: str) -> str:
        return level if len(stats) == 1 else f"{level}_{name}"

    return wide.select(
        *keys, *[F.col(f"`{made(lv, name)}`").alias(f"{name}_{lv}") for name in stats for lv in levels]
    )


def to_long(df: DataFrame, keys: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    """One row per key and value column; missing values keep their row."""
    return df.unpivot(list(keys), list(values), name, value)


def split_to_rows(df: DataFrame, column: str, sep: str = ",") -> DataFrame:
    """One row per squished, non-blank entry of a delimited text; no entry, no row.

    Narrow and stateless, so it runs on a stream as well.
    """
    rest = [c for c in df.columns if c != column]
    return (
        df.select(*rest, F.explode(F.split(F.col(column), sep, -1)).alias(column))
        .withColumn(column, squish_to_null(column))
        .where(F.col(column).isNotNull())
        .select(*df.columns)
    )
