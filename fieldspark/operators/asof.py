"""As-of pairing with the most recent earlier event."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.operators.joins import join_suffix


def _answered(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The questions among ``points`` with ``__match`` and ``__known`` (the key has any event).

    Points have keys, ``__day``, ``__is_event`` (0 or 1) and ``__event`` (missing for questions),
    with no more than one of each kind per key and day.
    """
    whole_key = Window.partitionBy(*keys)
    # within a day the question sorts before the event, which keeps same-day events out
    earlier = whole_key.orderBy("__day", "__is_event").rowsBetween(Window.unboundedPreceding, -1)
    undated = F.max(F.when(F.col("__day").isNull() & (F.col("__is_event") == 1), F.col("__event")))
    return (
        points.withColumn("__earlier", F.last("__event", ignorenulls=True).over(earlier))
        .withColumn("__undated", undated.over(whole_key))
        .withColumn("__known", F.max("__is_event").over(whole_key))
        .where(F.col("__is_event") == 0)
        .withColumn("__match", F.coalesce("__undated", "__earlier"))
    )


def _kept(unmatched: str):
    if unmatched not in ("drop", "keep"):
        raise ValueError("unmatched must be 'drop' or 'keep'")
    if unmatched == "keep":
        return F.lit(True)
    return F.col("__match").isNotNull() | (F.col("__known") == 0)


def prior_event_in_place(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    is_event: Column,
    event: Mapping[str, str],
    unmatched: str = "drop",
) -> DataFrame:
    """``prior_event_asof`` of a table's other rows with its event rows, in one shuffle.

    For tables with at most one event row and one other row per key and day, which bounds the
    window group by the number of days. ``event`` maps output columns to columns of the event row.
    """
    chosen = F.struct(*[F.col(src).alias(out) for out, src in event.items()])
    points = df.select(
        "*",
        F.to_date(time).alias("__day"),
        is_event.cast("int").alias("__is_event"),
        F.when(is_event, chosen).alias("__event"),
    )
    return (
        _answered(points, keys)
        .where(_kept(unmatched))
        .select(*df.columns, *[F.col(f"__match.{c}").alias(c) for c in event])
    )


def prior_event_asof(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    tie: str | None = None,
    unmatched: str = "drop",
) -> DataFrame:
    """Give each left row the latest right row of its key dated strictly before it.

    Times are compared as dates: a right row of the same day never counts. Among right rows of
    one day the latest ``tie`` wins, a missing ``tie`` counting as latest. A right row without a
    date wins over all dated ones. Left rows whose key has no right row at all are kept without
    a match; those whose key has right rows but none that qualify are dropped, or kept without a
    match under ``unmatched="keep"``.

    The match depends only on key and day. Both sides are therefore reduced to one row per key
    and day before the window (with map-side combining), which bounds a window group by the
    number of days, however many rows a key has; the left rows then pick up their day's answer
    by an equi-join, whose hot keys adaptive execution can split.
    """
    keys = list(keys)
    payload = [c for c in right.columns if c not in keys]
    clash = set(payload) & set(left.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")

    rank = [] if tie is None else [F.col(tie).isNull().alias("r0"), F.col(tie).alias("r1")]
    best = F.max(F.struct(*rank, F.struct(*payload).alias("event")))["event"]
    events = right.groupBy(*keys, F.to_date(right_time).alias("__day")).agg(best.alias("__event"))
    asked = left.select(*keys, F.to_date(left_time).alias("__day")).distinct()
    points = events.withColumn("__is_event", F.lit(1)).unionByName(
        asked.withColumn("__is_event", F.lit(0)), allowMissingColumns=True
    )
    answers = _answered(points, keys).select(*keys, "__day", "__match", "__known")

    paired = join_suffix(
        left.withColumn("__day", F.to_date(left_time)), answers, keys + ["__day"], "inner"
    )
    return paired.where(_kept(unmatched)).select(*left.columns, *[F.col(f"__match.{c}").alias(c) for c in payload])
