"""Long grids (time, latitude, longitude, value): subsets, strides and time chunks.

Land grids as Parquet partitioned by year; the predicates here are plain ranges on columns, so
they prune partitions and row groups.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.fixed_values import REVISABLE_DAYS
from fieldspark.functions.nulls import as_column


def last_settled_day(as_of: date, days: int = REVISABLE_DAYS) -> date:
    """The newest day that is no longer revised."""
    return as_of - timedelta(days=days)


def grid_subset(
    df: DataFrame,
    box: Mapping[str, tuple[float, float]],
    time: str | None = None,
    first: date | None = None,
    last: date | None = None,
    fields: Sequence[str] | None = None,
    year_column: str | None = None,
) -> DataFrame:
    """Rows inside a closed box and between two days (both included), with chosen fields.

    ``year_column`` names the column a landed grid is partitioned by; the days then prune
    partitions as well as row groups.
    """
    for axis, (lo, hi) in box.items():
        df = df.where(F.col(axis).between(lo, hi))
    if first is not None:
        df = df.where(F.col(time) >= F.lit(first))
    if last is not None:
        df = df.where(F.col(time) < F.lit(last + timedelta(days=1)))
    if year_column is not None and first is not None:
        df = df.where(F.col(year_column) >= first.year)
    if year_column is not None and last is not None:
        df = df.where(F.col(year_column) <= last.year)
    return df if fields is None else df.select(*fields)


def cell_index(value: Column | str, origin: float | Column, step: float) -> Column:
    origin = origin if isinstance(origin, Column) else F.lit(origin)
    return F.round((as_column(value) - origin) / F.lit(step)).cast("bigint")


def grid_stride(df: DataFrame, axes: Mapping[str, tuple[Column, int]]) -> DataFrame:
    """Every n-th cell along each axis; ``axes`` maps a name to (cell index from 0, n)."""
    for index, n in axes.values():
        if n > 1:
            df = df.where(F.pmod(index, F.lit(n)) == 0)
    return df


@dataclass(frozen=True)
class Tiling:
    """How the cells of an axis are numbered (``origin`` is cell 0) and the stride that a landed grid is laid out for."""

    origin: float
    step: float
    stride: int


def tiled_stride(df: DataFrame, strides: Mapping[str, tuple[float, int]], tiles: Mapping[str, Tiling]) -> DataFrame:
    """``grid_stride`` of a grid that ``write_grid`` landed with the same ``tiles``: from a first value on every n-th cell of an axis.

    A stride that divides the layout's is a choice of residues, and a pushed filter on them; any other one is also tested cell by cell.
    """
    for axis, (first, n) in strides.items():
        laid, start = tiles[axis].stride, round((first - tiles[axis].origin) / tiles[axis].step)
        wanted = [r for r in range(laid) if (r - start) % gcd(n, laid) == 0]
        if len(wanted) < laid:
            residue = F.col(f"{axis}_residue")
            df = df.where(residue == wanted[0] if len(wanted) == 1 else residue.isin(wanted))
        if laid % n:
            df = df.where(F.pmod(F.col(f"{axis}_cell") - start, F.lit(n)) == 0)
    return df


def day_index(time: Column | str, first: date) -> Column:
    return F.datediff(F.to_date(as_column(time)), F.lit(first)).cast("bigint")


def month_chunks(df: DataFrame, first: str, last: str) -> DataFrame:
    """One row per month step between two date columns: ``chunk_start`` and ``chunk_end``.

    Chunks start at ``first`` and every month after; the last one ends at ``last``.
    """
    starts = F.sequence(F.col(first), F.col(last), F.expr("interval 1 month"))
    return df.select("*", F.posexplode(starts).alias("__i", "chunk_start")).select(
        *df.columns,
        "chunk_start",
        F.least(
            F.date_sub(F.add_months(F.col(first), F.col("__i") + 1), 1), F.col(last)
        ).alias("chunk_end"),
    )
