"""Joins in which missing keys match each other, and set membership.

``eqNullSafe`` stays an equi-join for Spark (hash or sort-merge). No side is ever hinted for
broadcast: Spark broadcasts by measured size and otherwise shuffles, and adaptive execution
splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Key = str | tuple[str, str]


def key_pairs(keys: Sequence[Key]) -> list[tuple[str, str]]:
    return [(k, k) if isinstance(k, str) else k for k in keys]


def join_suffix(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[Key],
    how: str = "inner",
    suffix: tuple[str, str] = ("_x", "_y"),
) -> DataFrame:
    """Join on null-safe keys; other columns present on both sides get a suffix each.

    A key may be ``(left_name, right_name)``; the result carries the left name. Columns keep the
    order of ``left``, then of ``right``.
    """
    pairs = key_pairs(keys)
    left_keys = [a for a, _ in pairs]
    right_keys = [b for _, b in pairs]
    tagged = right.select(*[F.col(c).alias(f"__r_{c}") for c in right.columns])
    on = reduce(
        lambda x, y: x & y, [F.col(a).eqNullSafe(F.col(f"__r_{b}")) for a, b in pairs]
    )
    if how in ("left_semi", "left_anti"):
        return left.join(tagged, on, how)

    joined = left.join(tagged, on, how)
    right_name = dict(pairs)
    right_rest = [c for c in right.columns if c not in right_keys]
    shared = (set(left.columns) - set(left_keys)) & set(right_rest)

    def left_column(c: str):
        if c not in right_name:
            return F.col(c).alias(c + suffix[0]) if c in shared else F.col(c)
        if how == "full":
            return F.coalesce(F.col(c), F.col(f"__r_{right_name[c]}")).alias(c)
        return F.col(f"__r_{right_name[c]}").alias(c) if how == "right" else F.col(c)

    return joined.select(
        *[left_column(c) for c in left.columns],
        *[F.col(f"__r_{c}").alias(c + suffix[1] if c in shared else c) for c in right_rest],
    )


def missing_keys(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    both: bool = False,
    each_row: bool = False,
) -> DataFrame:
    """Keys of ``left`` that ``right`` does not have, with their number of rows ``n_rows``.

    With ``both``, the other way too; ``missing_in`` then tells the entry that lacks the key.
    With ``each_row``, a key comes once per row instead of with a count.

    Both sides are stacked and counted per key, which matches missing keys with each other, needs
    one shuffle with map-side combining and no join, and costs a key one row however often it
    occurs.
    """
    if each_row:
        one = join_suffix(left.select(*keys), right.select(*keys), keys, "left_anti")
        if not both:
            return one
        other = missing_keys(right, left, keys, each_row=True)
        return one.withColumn("missing_in", F.lit("second")).unionByName(
            other.withColumn("missing_in", F.lit("first"))
        )
    stacked = left.select(*keys, F.lit(1).alias("__a"), F.lit(0).alias("__b")).unionByName(
        right.select(*keys, F.lit(0).alias("__a"), F.lit(1).alias("__b"))
    )
    counts = stacked.groupBy(*keys).agg(F.sum("__a").alias("__a"), F.sum("__b").alias("__b"))
    if not both:
        return counts.where(F.col("__b") == 0).select(*keys, F.col("__a").alias("n_rows"))
    return counts.where((F.col("__a") == 0) | (F.col("__b") == 0)).select(
        *keys,
        (F.col("__a") + F.col("__b")).alias("n_rows"),
        F.when(F.col("__b") == 0, "second").otherwise("first").alias("missing_in"),
    )


def keep_members(
    df: DataFrame, lookup: DataFrame, key: Key, where=None
) -> DataFrame:
    """Rows whose key occurs in the (optionally filtered) lookup."""
    (a, b), = key_pairs([key])
    chosen = lookup if where is None else lookup.where(where)
    return df.join(chosen.select(F.col(b).alias("__member")), F.col(a) == F.col("__member"), "left_semi")
