"""Table statistics: box summaries, histograms, the growth fit and its quality."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.fixed_values import GROWTH_START, HISTOGRAM_BINS
from fieldspark.functions.models import growth
from fieldspark.functions.nulls import finite, present, ratio
from fieldspark.operators.joins import join_suffix
from fieldspark.operators.ordered import quantiles_of_counts, value_counts


#: Values of c in a grid after the first.
NODES = 16


def box_summary(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Five-number summary per key with whiskers at 1.5 times the quartile distance.

    Missing, NaN and infinite values are left out; a key without others has no row.
    """
    keys = list(keys)
    counts = value_counts(df, keys, value)
    quartiles = quantiles_of_counts(counts, keys, value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    fences = quartiles.withColumn("__reach", 1.5 * (F.col("q3") - F.col("q1")))
    inside = F.col(value).between(F.col("q1") - F.col("__reach"), F.col("q3") + F.col("__reach"))
    # the quartiles travel with the counts, so they are not worked out a second time for the result
    return (
        join_suffix(counts, fences, keys)
        .groupBy(*keys)
        .agg(
            *[F.max(c).alias(c) for c in quartiles.columns if c not in keys],
            F.min(F.when(inside, F.col(value))).alias("lower_whisker"),
            F.max(F.when(inside, F.col(value))).alias("upper_whisker"),
            F.coalesce(F.sum(F.when(~inside, F.col("__n"))), F.lit(0)).alias("n_outliers"),
        )
    )


def histogram(df: DataFrame, value: str, by: Sequence[str], bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Counts in equal-width bins over the range of the whole table, split by ``by``.

    The range is a one-value subquery, so there is no join; the largest value falls into the
    last bin. Missing, NaN and infinite values are left out.
    """
    there = df.where(finite(value).isNotNull())
    ends = there.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    lo, hi = ends["lo"], ends["hi"]
    place = F.coalesce(F.floor(ratio(F.col(value) - lo, hi - lo) * bins), F.lit(0))
    binned = there.withColumn("bin", F.least(place, F.lit(bins - 1)).cast("int"))
    width = (hi - lo) / bins
    return (
        binned.groupBy(*by, "bin")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bin_start", lo + F.col("bin") * width)
        .withColumn("bin_end", lo + (F.col("bin") + 1) * width)
    )


def fit_growth(
    df: DataFrame,
    x: str,
    y: str,
    start: tuple[float, float, float] = GROWTH_START,
    steepest: float = 30.0,
    strict: bool = True,
) -> DataFrame:
    """Least-squares fit of ``y = a + b * exp(c * x)`` by variable projection.

    For a given c the curve is linear in a and b, so six sums tell how well it can be. One aggregate works them out for a whole grid
    of c, and the best c lies where the slope of the residuals changes its sign, which a polynomial through the grid's slopes locates. Three grids, each
    within the best cell of the one before, take four jobs together with the one that looks at the range. c is looked for up to ``steepest``
    over half the range of x, and at the c of ``start``.

    The model sees a row only through x, so rows are first reduced to count, mean and centred sum of squares of y
    per distinct x; missing, NaN and infinite values are left out. Returns one row: a, b, c, n, rss, passes, converged.
    It has converged if the residuals fall on one side of the c found and rise on the other, inside the range; if not there is
    an error, or without ``strict`` a warning.
    """
    rows = df.where(finite(x).isNotNull() & finite(y).isNotNull()).select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    shift, low, high = rows.agg(F.avg("y"), F.min("x"), F.max("x")).first()
    if shift is None:
        raise ValueError("no complete (x, y) rows to fit")
    middle, half = (low + high) / 2, (high - low) / 2 or 1.0
    # around the overall mean, so that a large offset of y costs no digits
    miss = F.col("y") - F.lit(shift)
    points = (
        rows.groupBy("x")
        .agg(F.count(F.lit(1)).alias("m"), F.avg(miss).alias("mean"), (F.var_pop(miss) * F.count(F.lit(1))).alias("m2"))
        .select(((F.col("x") - middle) / half).alias("z"), "m", "mean", "m2")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    first = float(np.clip(start[2] * half, -steepest, steepest))
    grid = np.unique(np.append(np.sinh(np.linspace(-4.5, 4.5, 60)) * steepest / np.sinh(4.5), first))
    try:
        found = _projected(points, grid)
        best = int(np.argmin(found["rss"]))
        inside = 0 < best < len(grid) - 1
        left, right = grid[max(best - 1, 0)], grid[min(best + 1, len(grid) - 1)]
        for passes in (3, 4):
            grid = (0.5 - 0.5 * np.cos(np.pi * (np.arange(NODES) + 0.5) / NODES)) * (right - left) + left
            found = _projected(points, grid)
            best = int(np.argmin(found["rss"]))
            k, reach = _sign_change(grid, found["slope"], best), (right - left) * 1e-3
            left, right = k - reach, k + reach
    finally:
        points.unpersist()

    alpha, beta, rss = (float(_through(grid, found[c])(k)) for c in ("alpha", "beta", "rss"))
    turns = found["slope"][0] < 0 < found["slope"][-1]
    converged = bool(inside and np.isfinite([k, alpha, beta, rss]).all() and k != 0 and beta != 0 and turns)
    if not converged:
        if strict:
            raise ArithmeticError("the growth fit did not converge")
        warnings.warn("the growth fit did not converge", stacklevel=2)
    # alpha + beta * (exp(k * z) - 1) / k in terms of x
    c = k / half
    b = beta / k * float(np.exp(-c * middle)) if k else 0.0
    a = alpha - beta / k + shift if k else alpha + shift
    return df.sparkSession.createDataFrame(
        [(a, b, c, int(found["n"][best]), max(rss, 0.0), passes, converged)],
        "a double, b double, c double, n bigint, rss double, passes int, converged boolean",
    )


def _projected(points: DataFrame, grid: np.ndarray) -> dict[str, np.ndarray]:
    """For each k of a grid the best line in ``u = (exp(k z) - 1) / k``: its coefficients, residuals, and their slope with k. One aggregate."""
    k, z, m, mean = (F.col(c) for c in ("k", "z", "m", "mean"))
    grown = F.expm1(k * z)
    u = F.when(F.abs(k) < 1e-9, z).otherwise(grown / k)
    v = F.when(F.abs(k) < 1e-4, z * z / 2 + k * z * z * z / 3).otherwise((z * (grown + 1) - grown / k) / k)
    tried = points.select("*", F.posexplode(F.array(*[F.lit(float(g)) for g in grid])).alias("i", "k")).select("i", "m", "m2", "mean", u.alias("u"), v.alias("v"))
    u, v = F.col("u"), F.col("v")
    sums = {
        "n": m, "y": m * mean, "yy": F.col("m2") + m * mean * mean, "u": m * u, "uu": m * u * u, "uy": m * u * mean,
        "v": m * v, "uv": m * u * v, "vy": m * v * mean,
    }
    found = sorted(tried.groupBy("i").agg(*[F.sum(x).alias(c) for c, x in sums.items()]).collect())
    s = {c: np.array([float(r[c]) for r in found]) for c in sums}
    with np.errstate(all="ignore"):
        spread = s["uu"] - s["u"] ** 2 / s["n"]
        beta = np.where(spread > 0, (s["uy"] - s["u"] * s["y"] / s["n"]) / spread, 0.0)
        alpha = (s["y"] - beta * s["u"]) / s["n"]
        rss = s["yy"] - alpha * s["y"] - beta * s["uy"]
        turn = beta * (s["vy"] - alpha * s["v"] - beta * s["uv"])
    return {"n": s["n"], "alpha": alpha, "beta": beta, "rss": np.where(np.isfinite(rss), rss, np.inf), "slope": -2 * turn}


def _through(grid: np.ndarray, values: np.ndarray) -> np.polynomial.Chebyshev:
    return np.polynomial.Chebyshev.fit(grid, values, len(grid) - 1)


def _sign_change(grid: np.ndarray, slope: np.ndarray, best: int) -> float:
    """Where the slope turns from falling to rising, nearest to the best point; that point if it does not."""
    curve = _through(grid, slope)
    roots = curve.roots()
    real = roots[np.abs(roots.imag) < 1e-9 * (grid[-1] - grid[0])].real
    rising = [r for r in real if grid[0] <= r <= grid[-1] and curve.deriv()(r) > 0]
    return float(min(rising, key=lambda r: abs(r - grid[best]))) if rising else float(grid[best])


def _both(x: str, y: str) -> Column:
    return present(x).isNotNull() & present(y).isNotNull()


def fit_quality(df: DataFrame, x: str, y: str, coefficients: tuple[float, float, float]) -> DataFrame:
    """n, residual and total sums of squares and R² of given coefficients, in one row."""
    rows = df.where(_both(x, y))
    miss = F.col(y) - growth(x, coefficients)
    return (
        rows.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(miss * miss).alias("rss"),
            (F.var_pop(y) * F.count(F.lit(1))).alias("tss"),
        )
        .withColumn("r_squared", 1 - ratio("rss", "tss"))
    )
