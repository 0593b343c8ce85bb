"""Writing results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.functions.nulls import nulls_last
from fieldspark.operators.grid import Tiling, cell_index


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", sort_by: Sequence[str] = ()) -> None:
    """``sort_by`` orders the whole report, missing values last; its files are in that order."""
    if sort_by:
        df = df.orderBy(*nulls_last(*sort_by))
    df.write.mode(mode).option("header", True).csv(path)


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite", sort_by: Sequence[str] = ()
) -> None:
    if sort_by:
        df = df.orderBy(*nulls_last(*sort_by))
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_grid(
    df: DataFrame, path: str, time: str = "time", mode: str = "overwrite", tiles: Mapping[str, Tiling] | None = None, row_group_bytes: int | None = None
) -> None:
    """A grid as Parquet by year.

    Days are spread over the tasks of a year, so no task writes a whole year and each day's rows
    sit together for row-group pruning. With ``tiles`` (axis to ``Tiling``) the cells of each axis are numbered in ``<axis>_cell`` and the rows
    of a file come residue by residue (``<axis>_residue``), day by day within one: every n-th cell then is one stretch of a file, and a
    reader of ``tiled_stride`` skips the row groups and pages of all others.
    """
    by_year = df.withColumn("year", F.year(time))
    for axis, tiling in (tiles or {}).items():
        by_year = by_year.withColumn(f"{axis}_cell", cell_index(axis, tiling.origin, tiling.step))
        by_year = by_year.withColumn(f"{axis}_residue", F.pmod(f"{axis}_cell", F.lit(tiling.stride)).cast("int"))
    residues = [f"{axis}_residue" for axis in tiles or {}]
    writer = by_year.repartition("year", F.to_date(time)).sortWithinPartitions("year", *residues, time).write.mode(mode).partitionBy("year")
    (writer.option("parquet.block.size", row_group_bytes) if row_group_bytes else writer).parquet(path)
