"""Temperature anomalies: regional means, climatology, aligned year series, fine grid."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.fixed_values import (
    BASELINE_YEARS,
    CONTINUATION_YEAR,
    FAINT_YEARS,
    FINE_GRID_START,
    FINE_GRID_STRIDE,
    HIGHLIGHT_YEAR,
    LAST_FULL_YEAR,
    REGION_BOX,
    SERIES_FIRST_DOY,
)
from fieldspark.functions.nulls import level_rank, mean
from fieldspark.operators.grid import Tiling, cell_index, day_index, grid_stride, grid_subset, last_settled_day, tiled_stride
from fieldspark.operators.quality import require_years


def daily_regional_mean(
    grid: DataFrame,
    box: Mapping[str, tuple[float, float]] = REGION_BOX,
    time: str = "time",
    value: str = "anom",
    first: date | None = None,
    last: date | None = None,
    years: Sequence[int] = (),
    year_column: str | None = None,
) -> DataFrame:
    """Mean of the grid cells in a box per day: date, year, doy, anom_mean.

    ``years`` lists years that must have data; the result fails when it runs if one has none.
    ``year_column`` names the grid's partition column: later filters on ``year`` then prune
    partitions.
    """
    kept = [time, value, *([year_column] if year_column else [])]
    inside = grid_subset(grid, box, time, first, last, kept, year_column)
    keys = [F.to_date(time).alias("date")] + ([F.col(year_column).alias("year")] if year_column else [])
    daily = inside.groupBy(*keys).agg(mean(value).alias("anom_mean")).select(
        "date",
        F.col("year").cast("int").alias("year") if year_column else F.year("date").alias("year"),
        F.dayofyear("date").alias("doy"),
        "anom_mean",
    )
    return require_years(daily, "year", years) if years else daily


def of_years(daily: DataFrame, years: Sequence[int]) -> DataFrame:
    """Days of some years. The range of days they span is said as well: it reaches the scan."""
    span = (F.col("date") >= F.lit(date(min(years), 1, 1))) & (
        F.col("date") < F.lit(date(max(years) + 1, 1, 1))
    )
    return daily.where(F.col("year").isin(list(years)) & span)


def climatology(daily: DataFrame, years: Sequence[int] = tuple(BASELINE_YEARS)) -> DataFrame:
    """Mean by day of year over the baseline years."""
    return of_years(daily, years).groupBy("doy").agg(mean("anom_mean").alias("anom_mean"))


def climatology_excluding(daily: DataFrame, year: int = LAST_FULL_YEAR, doy_max: int = 360) -> DataFrame:
    """The older baseline: all years but one, up to a day of year."""
    kept = (F.col("year") != year) & (F.col("doy") <= doy_max)
    return daily.where(kept).groupBy("doy").agg(mean("anom_mean").alias("anom_mean"))


def baseline_label(years: Sequence[int]) -> str:
    return f"Mean ({min(years)}–{max(years)})"


def aligned_series(
    daily: DataFrame,
    faint: Sequence[int] = tuple(FAINT_YEARS),
    highlight: int = HIGHLIGHT_YEAR,
    last_full: int = LAST_FULL_YEAR,
    continuation: int = CONTINUATION_YEAR,
    baseline: Sequence[int] = tuple(BASELINE_YEARS),
    doy_min: int = SERIES_FIRST_DOY,
) -> DataFrame:
    """Year lines and climatology on one axis, the continuation year shifted to its right.

    Columns: line, line_rank (legend order), year (missing for the mean), doy, anom_mean,
    mean_ext and xplot. The climatology comes twice where the continuation year runs: in place,
    and shifted beside it (``mean_ext``). Day 366 is left out of the unshifted lines.

    A day goes to its own line and, in a baseline year, to the mean; both are then one aggregate
    over ``daily``. The extent of the continuation year is a one-value subquery.
    """
    mean_line = baseline_label(baseline)
    shown = [highlight, *faint, last_full, continuation]
    year = F.col("year")
    own = F.when(year.isin(shown), F.struct(year.cast("int").alias("year"), year.cast("string").alias("line")))
    average = F.when(
        year.isin(list(baseline)), F.struct(F.lit(None).cast("int").alias("year"), F.lit(mean_line).alias("line"))
    )
    lines = (
        of_years(daily, sorted({*shown, *baseline}))
        .select("doy", "anom_mean", F.explode(F.array(own, average)).alias("to"))
        .where(F.col("to").isNotNull())
        .groupBy(F.col("to.line").alias("line"), F.col("to.year").alias("year"), "doy")
        .agg(mean("anom_mean").alias("anom_mean"))
    )
    last_doy = of_years(daily, [continuation]).agg(F.max("doy")).scalar()
    is_mean, is_next = F.col("line") == mean_line, F.col("line") == str(continuation)
    twice = F.when(is_mean, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    placed = lines.select("*", F.explode(twice).alias("mean_ext")).withColumn("__last", last_doy)
    shifted = is_next | F.col("mean_ext")
    keep = F.when(shifted, F.col("doy") <= F.col("__last")).otherwise(
        F.col("doy").between(doy_min, 365)
    )
    order = [mean_line, str(highlight), *[str(y) for y in faint], str(last_full), str(continuation)]
    return placed.where(keep).select(
        "line",
        level_rank("line", order).alias("line_rank"),
        "year",
        "doy",
        "anom_mean",
        "mean_ext",
        F.when(shifted, F.col("doy") + 365).otherwise(F.col("doy")).alias("xplot"),
    )


def tidy_fine_grid(
    grid: DataFrame,
    as_of: date,
    box: Mapping[str, tuple[float, float]] = REGION_BOX,
    stride: tuple[int, int, int] = FINE_GRID_STRIDE,
    step: float = 0.01,
    first: date = date.fromisoformat(FINE_GRID_START),
    year_column: str | None = None,
    tiles: Mapping[str, Tiling] | None = None,
) -> DataFrame:
    """Strided subset of the fine grid under tidy names, up to the last settled day.

    ``year_column`` names the grid's partition column, so that years out of range are not read. ``tiles`` is how the grid was landed,
    if by stride (``write_grid``); then the cells between are not read either.
    """
    fields = ["time", "latitude", "longitude", "sstAnom", "mask", *([year_column] if year_column else [])]
    if tiles:
        fields += [f"{axis}_{kind}" for axis in tiles for kind in ("cell", "residue")]
    inside = grid_subset(grid, box, "time", first, last_settled_day(as_of), fields, year_column)
    n_t, n_lat, n_lon = stride
    steps = {"latitude": n_lat, "longitude": n_lon}
    strided = grid_stride(
        tiled_stride(inside, {axis: (box[axis][0], steps[axis]) for axis in tiles}, tiles) if tiles else inside,
        {
            "time": (day_index("time", first), n_t),
            **{axis: (cell_index(axis, box[axis][0], step), n) for axis, n in steps.items() if axis not in (tiles or {})},
        },
    )
    return strided.select(
        F.to_date("time").alias("date"),
        F.col("latitude").alias("lat_dd"),
        F.col("longitude").alias("long_dd"),
        F.col("sstAnom").alias("sst_anom_c"),
        "mask",
    )
