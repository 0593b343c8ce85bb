"""Weighted draws with replacement, repeatable and spread over the cluster."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.functions.nulls import half_even
from fieldspark.operators.joins import join_suffix
from fieldspark.operators.ordered import running_total

# probabilities are held as whole numbers of 2^-40, so cumulative sums are exact and leave no gap
FIXED_POINT = 1 << 40
SIZES_PER_CELL = 16
# draws of a group for each place where they meet its ranges
PLACE_DRAWS = 65_536


def hashed_uniform(group: Column, i: Column) -> Column:
    """A number in [0, 1) from a group's hash and a draw number; the same on every run."""
    return F.shiftrightunsigned(F.xxhash64(group, i), 11) / F.lit(float(1 << 53))


def _share_units(dist: DataFrame, prob: str) -> DataFrame:
    units = F.greatest(half_even(F.col(prob) * float(FIXED_POINT)).cast("bigint"), F.lit(1))
    return dist.where(F.col(prob) > 0).withColumn("__units", units)


def weighted_sample(
    groups: DataFrame,
    distribution: DataFrame,
    keys: Sequence[str],
    n: str,
    size: str,
    prob: str,
    fallback: DataFrame | None = None,
    uniform: Callable[[Column], Column] | None = None,
    seed: int = 1985,
    chunk: int = 65536,
) -> DataFrame:
    """Draw ``n`` sizes per group (half-even rounded) from the group's size distribution.

    ``distribution`` has keys, size and prob; groups it lacks use ``fallback`` (size, prob).
    Returns keys, ``draw`` (1..n) and size, one row per individual. ``uniform`` gives the random
    number of a draw from its number and the key columns (missing counts as 0); by default it is a
    hash of both and of ``seed``.

    Draws are made in chunks spread over all tasks, so one large group is many tasks' work. A
    draw finds its size by an equi-join on a hash of group and cell of the cumulative range, with
    group and exact range as residual. A size is listed once per cell it touches and place, and a group has
    a cell per few sizes, so no distribution is held whole by a row or task. The places of a group grow with its draws, those
    of the fallback with all draws: about ``PLACE_DRAWS`` meet in one, however many there are.
    """
    keys = list(keys)
    at_random = uniform or (lambda i: hashed_uniform(F.col("__seed"), i))

    places = F.greatest(F.lit(1), F.ceil(half_even(n) / PLACE_DRAWS)).cast("bigint")
    own_units = _share_units(distribution, prob).select(*keys, size, "__units")
    ranges = join_suffix(
        running_total(own_units, keys, size, "__units"), groups.select(*keys, places.alias("__places")), keys
    ).withColumn("__own", F.lit(True))
    totals = own_units.groupBy(*keys).agg(
        F.sum("__units").alias("__total"), F.count(F.lit(1)).alias("__rows")
    )
    wanted = join_suffix(
        groups.select(*keys, half_even(n).cast("bigint").alias("__n")), totals, keys, "left"
    ).withColumn("__own", F.col("__total").isNotNull())
    wanted = wanted.withColumn("__places", F.greatest(F.lit(1), F.ceil(F.col("__n") / PLACE_DRAWS)).cast("bigint"))
    if fallback is not None:
        units = _share_units(fallback, prob).select(size, "__units")
        types = {f.name: f.dataType for f in groups.schema}
        # one key for all rows, which Spark does not see through: a join on a constant would be a product
        other = running_total(units.withColumn("__all", F.least("__units", F.lit(0))), ["__all"], size, "__units")
        all_places = groups.agg(F.coalesce(F.sum(places), F.lit(1))).scalar()
        ranges = ranges.unionByName(
            other.drop("__all").withColumns(
                {"__own": F.lit(False), "__places": all_places, **{k: F.lit(None).cast(types[k]) for k in keys}}
            )
        )
        whole = units.agg(F.struct(F.sum("__units").alias("total"), F.count(F.lit(1)).alias("rows"))).scalar()
        wanted = wanted.withColumns(
            {
                "__total": F.coalesce("__total", whole["total"]), "__rows": F.coalesce("__rows", whole["rows"]),
                "__places": F.when(F.col("__own"), F.col("__places")).otherwise(all_places),
            }
        )

    # what depends on the group alone is worked out before the draws multiply its row
    def cells(rows: str) -> Column:
        return F.ceil(F.col(rows) / SIZES_PER_CELL)

    def group_hash(*values: Column) -> Column:
        return F.xxhash64(*values, F.col("__own"))

    def cell(at: Column, total: str) -> Column:
        return F.floor(at * F.col("__cells") / F.col(total)).cast("int")

    listed = (
        ranges.withColumn("__end", F.col("weight_before") + F.col("__units"))
        .withColumn("__cells", cells("rows_total"))
        .withColumn("__group", group_hash(*[F.col(k) for k in keys]))
        .withColumn(
            "__cell",
            F.explode(
                F.sequence(
                    cell(F.col("weight_before"), "weight_total"),
                    cell(F.col("__end") - 1, "weight_total"),
                )
            ),
        )
        .select(
            *keys, "__own", size, "weight_before", "__end",
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__places") - 1)).alias("__salt"), "__group", "__cell",
        )
        .withColumn("__place", F.xxhash64("__group", "__cell", "__salt"))
        .drop("__group", "__cell", "__salt")
    )

    last_chunk = F.floor((F.col("__n") - 1) / chunk)
    tasks = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    draws = (
        wanted.where((F.col("__n") >= 1) & F.col("__total").isNotNull())
        .withColumn("__cells", cells("__rows"))
        .withColumn("__group", group_hash(*[F.when(F.col("__own"), F.col(k)) for k in keys]))
        .withColumn("__seed", F.xxhash64(*keys, F.lit(seed)))
        .select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), last_chunk)).alias("__chunk"))
        # a fixed count, or adaptive execution would merge these few but fertile rows into one task
        .repartition(tasks, *keys, "__chunk")
        .select(
            *keys, "__own", "__total", "__cells", "__group", "__seed",
            # neighbouring chunks of a group go to neighbouring places, groups on the fallback begin anywhere
            F.pmod(F.when(F.col("__own"), F.lit(0)).otherwise(F.col("__seed")) + F.col("__chunk"), F.col("__places")).alias("__salt"),
            F.explode(
                F.sequence(
                    F.col("__chunk") * chunk + 1, F.least(F.col("__n"), (F.col("__chunk") + 1) * chunk)
                )
            ).alias("draw"),
        )
        # never missing, or the join would add a filter that works the number out a second time
        .withColumn("__at", F.coalesce(F.floor(at_random(F.col("draw")) * F.col("__total")), F.lit(0)))
        .withColumn("__cell", cell(F.col("__at"), "__total"))
        .select(*keys, "__own", "draw", "__at", F.xxhash64("__group", "__cell", "__salt").alias("__place"))
    )

    on = (
        (F.col("d.__place") == F.col("r.__place"))
        & (F.col("d.__at") >= F.col("r.weight_before"))
        & (F.col("d.__at") < F.col("r.__end"))
        & _same_group(keys)
    )
    # Spark sizes the draws by the rows they are exploded from and would broadcast them; the ranges are the small side
    return (
        draws.alias("d").join(listed.hint("shuffle_hash").alias("r"), on)
        .select(*[F.col(f"d.{k}") for k in keys], F.col("d.draw"), F.col(f"r.{size}"))
    )


def _same_group(keys: Sequence[str]) -> Column:
    """Guards against equal hashes; written as a case so that it stays out of the join keys."""
    same = F.lit(True)
    for k in keys:
        a, b = F.col(f"d.{k}"), F.col(f"r.{k}")
        same = same & F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).otherwise(a == b)
    return F.when(F.col("d.__own") & F.col("r.__own"), same).otherwise(
        ~F.col("d.__own") & ~F.col("r.__own")
    )
