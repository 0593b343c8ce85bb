"""Checks that return the offending rows (or counts) as a DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.operators.aggregates import count_by


def dup_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row, with their row count ``n``."""
    return count_by(df, keys).where(F.col("n") > 1)


def unclassified(df: DataFrame, label: str, value: str) -> DataFrame:
    """Distinct values that got no label."""
    return df.where(F.col(label).isNull()).select(value).distinct()


def unmatched(df: DataFrame, right_column: str, keys: Sequence[str]) -> DataFrame:
    """Keys of rows that found no partner, with their row count ``n``."""
    return count_by(df.where(F.col(right_column).isNull()), keys)


def bad_duration(df: DataFrame, duration: str) -> DataFrame:
    """Rows with a known duration that is not positive."""
    return df.where(F.col(duration) <= 0)


def recode_audit(df: DataFrame, raw: str, recoded: str) -> DataFrame:
    """Row count per original and recoded value."""
    return count_by(df, [raw, recoded])


def require_years(df: DataFrame, year: str, years: Sequence[int]) -> DataFrame:
    """``df`` unchanged, but failing when it runs if one of the years has no row.

    The wanted years are joined from outside, so a year without rows turns up as a row that
    fails; the input is read once, and an empty input fails as well. Meant for daily tables.
    """
    wanted = F.explode(F.array(*[F.lit(int(y)) for y in years])).alias("__wanted")
    expected = df.sparkSession.range(1).select(wanted)
    joined = df.withColumn("__present", F.lit(True)).join(
        expected, F.col(year) == F.col("__wanted"), "full"
    )
    empty = F.raise_error(F.concat(F.lit("no rows for year "), F.col("__wanted").cast("string")))
    return joined.where(F.coalesce("__present", empty.cast("boolean"))).select(*df.columns)


DUPLICATE, EMPTY = "duplicate_key", "empty"


def quality_report(
    df: DataFrame,
    keys: Sequence[str] = (),
    labels: Mapping[str, str] | None = None,
    partners: Mapping[str, Sequence[str]] | None = None,
    durations: Sequence[str] = (),
    recodes: Mapping[str, str] | None = None,
    required: Mapping[str, Sequence] | None = None,
    sep: str = " | ",
) -> DataFrame:
    """All checks of a job's end in one pass: ``check, subject, finding, n``.

    ``rows`` counts the table. ``duplicate_key`` tells each value of ``keys`` that has several rows, ``unclassified`` each
    value without a label (``labels`` maps label to value column), ``unmatched`` each key whose partner column is missing
    (``partners`` maps it to key columns), ``bad_duration`` each ``keys`` with a duration that is not positive, ``recode`` each
    pair ``raw -> recoded``, and ``empty`` each of the values ``required`` of a column that has no row (``n`` is 0). Several columns are
    written side by side, missing ones as ``NA``.

    Every row offers a piece to each check it has something to say to; the pieces are counted by one aggregate, which combines before it
    shuffles. Nothing is scanned twice and nothing is joined.
    """

    def written(columns: Sequence[str]) -> Column:
        return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in columns])

    def piece(check: str, subject: str, finding: Column, when: Column | None = None) -> Column:
        out = F.struct(F.lit(check).alias("check"), F.lit(subject).alias("subject"), finding.cast("string").alias("finding"))
        return out if when is None else F.when(when, out)

    pieces = [piece("rows", "", F.lit(""))]
    if keys:
        pieces.append(piece(DUPLICATE, sep.join(keys), written(keys)))
    pieces += [piece("unclassified", value, written([value]), F.col(label).isNull()) for label, value in (labels or {}).items()]
    pieces += [piece("unmatched", right, written(of), F.col(right).isNull()) for right, of in (partners or {}).items()]
    pieces += [piece("bad_duration", d, written([*keys, d]), F.col(d) <= 0) for d in durations]
    pieces += [piece("recode", new, F.concat_ws(" -> ", written([raw]), written([new]))) for raw, new in (recodes or {}).items()]
    pieces += [piece(EMPTY, c, written([c]), F.col(c).isin(list(values))) for c, values in (required or {}).items()]
    offered = df.select(F.explode(F.array_compact(F.array(*pieces))).alias("p")).select("p.*", F.lit(1).alias("weight"))
    wanted = [(EMPTY, c, str(v), 0) for c, values in (required or {}).items() for v in values]
    if wanted:
        offered = offered.union(df.sparkSession.createDataFrame(wanted, offered.schema))
    counted = offered.groupBy("check", "subject", "finding").agg(F.sum("weight").alias("n"))
    check, n = F.col("check"), F.col("n")
    return counted.where(((check != DUPLICATE) | (n > 1)) & ((check != EMPTY) | (n == 0)))
