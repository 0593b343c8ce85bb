"""Missing-value rules of the survey jobs, where they differ from Spark's defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_EQUAL = " ≠ "


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def present(c: Column | str) -> Column:
    """A numeric value with NaN as missing, as the sheets and grids mean it."""
    c = as_column(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def finite(c: Column | str) -> Column:
    """A numeric value with NaN and the two infinities as missing, as charts and their statistics mean it."""
    c = as_column(c)
    return F.when(F.abs(c) < float("inf"), c)


def sum0(c: Column | str) -> Column:
    """Sum without missing values; a group with none left sums to zero."""
    return F.coalesce(F.sum(present(c)), F.lit(0))


def mean(c: Column | str) -> Column:
    """Mean of the values that are there."""
    return F.avg(present(c))


def deviation(c: Column | str) -> Column:
    """Sample deviation of the values that are there."""
    return F.stddev_samp(present(c))


def any0(c: Column | str) -> Column:
    """True if any value is true; a group of missing values is false."""
    return F.coalesce(F.bool_or(as_column(c)), F.lit(False))


def standard_error(c: Column | str) -> Column:
    """Sample deviation over the root of the row count; missing values count as rows."""
    return deviation(c) / F.sqrt(F.count(F.lit(1)))


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b, missing where b is zero (never infinite, never an error)."""
    return F.try_divide(as_column(a).cast("double"), as_column(b).cast("double"))


def row_sum(*cols: Column | str) -> Column:
    """Sum across columns with missing values taken as zero."""
    total = F.coalesce(present(cols[0]), F.lit(0))
    for c in cols[1:]:
        total = total + F.coalesce(present(c), F.lit(0))
    return total


def half_even(c: Column | str, digits: int = 0) -> Column:
    return F.bround(as_column(c), digits)


def num_text(c: Column | str) -> Column:
    """A number with all its digits, as people write it: ``3`` rather than ``3.0``, and never with an exponent.

    Different numbers give different texts, whatever their size. NaN is missing.
    """
    c = present(as_column(c).cast("double"))
    size, text = F.abs(c), c.cast("string")
    whole = (c == F.floor(c)) & (size < 1e15)
    return (
        F.when(whole, c.try_cast("bigint").cast("string"))
        .when(size.between(1e-3, 1e6), text)
        .when(size < float("inf"), _without_exponent(text))
        .otherwise(text)
    )


def _without_exponent(text: Column) -> Column:
    """``1.25E-5`` as ``0.0000125``: the digits with the point moved."""

    def part(i: int) -> Column:
        return F.regexp_extract(text, r"^(-?)(\d+)\.(\d+?)0*(?:E(-?\d+))?$", i)

    def moved(p: Column) -> Column:
        digits, point = F.concat(p["whole"], p["fraction"]), F.length(p["whole"]) + p["shift"]
        number = (
            F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
            .when(point >= F.length(digits), F.rpad(digits, point, F.lit("0")))
            .otherwise(F.concat(F.substring(digits, F.lit(1), point), F.lit("."), F.substring(digits, point + 1, F.length(digits))))
        )
        return F.concat(p["sign"], number)

    parts = F.struct(
        part(1).alias("sign"), part(2).alias("whole"), F.when(part(3) == "0", "").otherwise(part(3)).alias("fraction"),
        F.coalesce(part(4).try_cast("int"), F.lit(0)).alias("shift"),
    )
    # through a list of one, so that the parts are worked out once
    return F.get(F.transform(F.array(parts), moved), F.lit(0))


def differs(a: Column | str, b: Column | str) -> Column:
    """Null-aware difference: two missing values agree, one missing value is a difference."""
    return ~as_column(a).eqNullSafe(as_column(b))


def diff_text(a: Column | str, b: Column | str, *, numeric: bool, null_aware: bool = False) -> Column:
    """``"a ≠ b"`` where the two values differ, else missing.

    By default a value missing on one side is not a difference; with ``null_aware`` it is,
    and prints as ``NA``.
    """
    a, b = (present(c) if numeric else as_column(c) for c in (a, b))
    show = num_text if numeric else (lambda c: c.cast("string"))
    if null_aware:
        text = F.concat(
            F.coalesce(show(a), F.lit("NA")), F.lit(NOT_EQUAL), F.coalesce(show(b), F.lit("NA"))
        )
        return F.when(differs(a, b), text)
    return F.when(a != b, F.concat(show(a), F.lit(NOT_EQUAL), show(b)))


def nulls_last(*cols: str, descending: bool = False) -> list[Column]:
    """Sort keys with missing values at the end in either direction."""
    return [F.desc_nulls_last(c) if descending else F.asc_nulls_last(c) for c in cols]


def level_rank(c: Column | str, levels: list[str]) -> Column:
    """Position of a value in a declared order, counted from 1; missing if not declared."""
    position = F.array_position(F.array(*[F.lit(v) for v in levels]), as_column(c))
    return F.nullif(position, F.lit(0).cast("bigint")).cast("int")
