"""Running totals and exact quantiles that do not sort a whole group in one task.

Values are laid into cells that keep their order. The cells are cut from the data: a sketch of each group gives splitters
between which about equally many values lie, wherever and however densely they lie. The splitters only spread the work;
what is in a cell is counted exactly. Only per-cell totals are ever ordered across a group, and a group has no more than ``CELLS``;
rows are ordered within a cell.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.functions.nulls import finite
from fieldspark.operators.joins import join_suffix

#: Cells of a group, and neighbouring splitters that are looked at together.
CELLS, BLOCK = 256, 16


def with_cells(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Adds ``__cell``, which never falls as the value rises within a key; of few values each has a cell of its own."""
    x = F.col(value).cast("double")
    shares = [i / CELLS for i in range(1, CELLS)]
    splitters = df.groupBy(*keys).agg(F.array_sort(F.array_distinct(F.percentile_approx(x, shares, 16 * CELLS))).alias("__split"))
    # the last of each block first, then the splitters of one block
    splitters = splitters.withColumn("__last", F.filter("__split", lambda s, i: i % BLOCK == BLOCK - 1))
    blocks = F.size(F.filter("__last", lambda s: s < x))
    inside = F.size(F.filter(F.slice("__split", blocks * BLOCK + 1, BLOCK), lambda s: s < x))
    return join_suffix(df, splitters, keys).withColumn("__cell", blocks * BLOCK + inside).drop("__split", "__last")


def _cell_starts(celled: DataFrame, keys: Sequence[str], weight: str) -> DataFrame:
    """Per key and cell: weight before, in the cell and in the whole group, and rows in the group."""
    group = Window.partitionBy(*keys)
    before = group.orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    return (
        celled.groupBy(*keys, "__cell")
        .agg(F.sum(weight).alias("__in_cell"), F.count(F.lit(1)).alias("__rows"))
        .withColumn("__cell_start", F.coalesce(F.sum("__in_cell").over(before), F.lit(0)))
        .withColumn("__total", F.sum("__in_cell").over(group))
        .withColumn("__rows", F.sum("__rows").over(group))
    )


def running_total(df: DataFrame, keys: Sequence[str], order: str, weight: str) -> DataFrame:
    """Adds ``weight_before`` (sum over smaller ``order``), ``weight_total`` and ``rows_total`` per key.

    ``order`` must be unique within a key and not missing; ``weight`` is an integer column, so
    the sums are exact whatever the order of addition.
    """
    celled = with_cells(df, keys, order)
    starts = _cell_starts(celled, keys, weight).drop("__in_cell")
    within = (
        Window.partitionBy(*keys, "__cell").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    local = celled.withColumn("__local", F.coalesce(F.sum(weight).over(within), F.lit(0)))
    return join_suffix(local, starts, [*keys, "__cell"]).select(
        *df.columns,
        (F.col("__cell_start") + F.col("__local")).alias("weight_before"),
        F.col("__total").alias("weight_total"),
        F.col("__rows").alias("rows_total"),
    )


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows per key and value, as ``__n``; missing, NaN and infinite values are left out."""
    return df.where(finite(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))


def quantiles_of_counts(
    counts: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
) -> DataFrame:
    """Exact quantiles per key from ``value_counts``; linear between neighbours.

    ``probs`` maps output names to probabilities. Only the cells that hold a wanted rank have
    their values put in order.
    """
    celled = with_cells(counts, keys, value)
    starts = _cell_starts(celled, keys, "__n")
    position = {name: F.lit(float(p)) * (F.col("__total") - 1) for name, p in probs.items()}
    ranks = [r for p in position.values() for r in (F.floor(p), F.ceil(p))]

    cell_end = F.col("__cell_start") + F.col("__in_cell")
    wanted_cell = starts.where(
        F.exists(F.array(*ranks), lambda r: (r >= F.col("__cell_start")) & (r < cell_end))
    )
    within = (
        Window.partitionBy(*keys, "__cell").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = (
        join_suffix(celled, wanted_cell, [*keys, "__cell"])
        .withColumn(
            "__start", F.col("__cell_start") + F.coalesce(F.sum("__n").over(within), F.lit(0))
        )
        .withColumn("__end", F.col("__start") + F.col("__n"))
    )

    def at(rank):
        return F.max(F.when((rank >= F.col("__start")) & (rank < F.col("__end")), F.col(value)))

    found = placed.groupBy(*keys).agg(
        F.max("__total").alias("n"),
        *[x for name, p in position.items()
          for x in (at(F.floor(p)).alias(f"__lo_{name}"), at(F.ceil(p)).alias(f"__hi_{name}"))],
    )

    def between(name: str, prob: float):
        place = F.lit(float(prob)) * (F.col("n") - 1)
        lo, hi = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        return (lo + (hi - lo) * (place - F.floor(place))).alias(name)

    return found.select(*keys, "n", *[between(name, p) for name, p in probs.items()])


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float]
) -> DataFrame:
    return quantiles_of_counts(value_counts(df, keys, value), keys, value, probs)
