"""Grouped aggregates that Spark has no single function for."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldspark.functions.nulls import mean, present, sum0


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Names of the numeric columns, from the schema only."""
    return [
        f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def numeric_means(df: DataFrame, keys: Sequence[str], drop: Sequence[str] = ()) -> DataFrame:
    """Mean of every numeric column per key; ``drop`` names columns left out."""
    return df.groupBy(*keys).agg(
        *[mean(c).alias(c) for c in numeric_columns(df, exclude=[*keys, *drop])]
    )


_PARTIAL = {
    "rows": lambda c: F.count(F.when(c, 1)),
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "any": F.bool_or,
}
_FINAL = {
    "rows": F.sum,
    "sum": lambda c: F.coalesce(F.sum(c), F.lit(0)),
    "min": F.min,
    "max": F.max,
    "any": lambda c: F.coalesce(F.bool_or(c), F.lit(False)),
}


def summarise(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, tuple[str, str | None]],
    *,
    distinct_counts: Mapping[str, str] | None = None,
    sorted_texts: Mapping[str, str] | None = None,
    ordered_texts: Mapping[str, str] | None = None,
    first_texts: Mapping[str, str] | None = None,
    order: Column | None = None,
    sep: str = " | ",
    collation: str | None = None,
) -> DataFrame:
    """Measures and text lists per key in one pass over the input.

    ``measures`` maps output to (``rows | sum | min | max | any``, column), missing values left
    out: a sum of nothing is zero, an any of nothing false. The text mappings are
    ``{output: column}``: ``sorted_texts`` joins the distinct texts in text order,
    ``ordered_texts`` in order of first appearance by ``order``, ``first_texts`` keeps the first
    one. ``distinct_counts`` counts distinct values. Text order is that of the characters' numbers, or that of ``collation``, one of Spark's
    (``UNICODE``: letters with and without accents side by side, small before capital); texts that a collation takes as equal
    stay apart, in order of their numbers.

    Every row gives one piece for its measures and one per text column. Pieces are reduced to one
    row per key, column and text (combining map-side) before any list is built, so a list holds
    what the output holds and never the rows of a group; the input is read once and nothing is
    joined. Give ``order`` as one number or time where the input is large, which keeps that
    reduction a hash aggregate.
    """
    counted, by_text = dict(distinct_counts or {}), dict(sorted_texts or {})
    by_order, firsts = dict(ordered_texts or {}), dict(first_texts or {})
    if (by_order or firsts) and order is None:
        raise ValueError("ordered_texts and first_texts need an order")
    sources = {**counted, **by_text, **by_order, **firsts}
    fractions = {c for c, kind in df.dtypes if kind in ("double", "float")}
    used = {c: (present(c).alias(c) if c in fractions else F.col(c)) for _, c in measures.values() if c is not None and c not in keys}
    pieces = [F.struct(F.lit("").alias("field"), F.lit(None).cast("string").alias("text"))] + [
        F.struct(F.lit(out).alias("field"), F.col(src).cast("string").alias("text"))
        for out, src in sources.items()
    ]
    is_row = F.col("__p.field") == ""
    reduced = (
        df.select(
            *keys,
            *used.values(),
            (F.lit(0) if order is None else order).alias("__ord"),
            F.explode(F.array(*pieces)).alias("__p"),
        )
        .where(is_row | F.col("__p.text").isNotNull())
        .groupBy(*keys, F.col("__p.field").alias("__field"), F.col("__p.text").alias("__text"))
        .agg(
            F.min("__ord").alias("__ord"),
            *[
                _PARTIAL[how](is_row if how == "rows" else F.when(is_row, F.col(c))).alias(out)
                for out, (how, c) in measures.items()
            ],
        )
    )

    def listed(out: str) -> Column:
        if out in firsts:
            return F.min(F.when(F.col("__field") == out, F.struct("__ord", "__text")))["__text"].alias(out)
        collated = [F.collate("__text", collation).alias("__key")] if collation else []
        entry = F.struct(*collated, "__text") if out in by_text else F.struct("__ord", "__text")
        entries = F.array_sort(F.collect_list(F.when(F.col("__field") == out, entry)))
        texts = F.transform(entries, lambda e: e["__text"])
        return F.nullif(F.array_join(texts, sep), F.lit("")).alias(out)

    return reduced.groupBy(*keys).agg(
        *[_FINAL[how](F.col(out)).alias(out) for out, (how, _) in measures.items()],
        *[F.count(F.when(F.col("__field") == out, 1)).alias(out) for out in counted],
        *[listed(out) for out in sources if out not in counted],
    )


def arrival_order(time: str, row_id: str) -> Column:
    """Time, then row number, as one number; rows without a time come last."""
    micros = F.coalesce(F.unix_micros(F.col(time).try_cast("timestamp")), F.lit(10**18))
    shift = F.lit(10**18).cast("decimal(19,0)")
    return (micros.cast("decimal(19,0)") * shift + F.col(row_id).cast("decimal(19,0)")).cast("decimal(38,0)")


def last_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row that sorts last per key, missing values sorting after all others.

    A max over a struct combines map-side, so no task holds a group. Spark sorts the rows by key for it, as a struct
    has no fixed width.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = [x for i, c in enumerate(order) for x in (F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}"))]
    best = F.max(F.struct(*rank, F.struct(*rest).alias("row")))["row"]
    return (
        df.groupBy(*keys)
        .agg(best.alias("__row"))
        .select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest])
        .select(*df.columns)
    )


AGGREGATES = {"sum": lambda c: sum0(c), "mean": mean}


def summarise_by(
    df: DataFrame, keys: Sequence[str], value: str, how: str, out: str = "value"
) -> DataFrame:
    """Aggregate ``value`` by keys and function chosen at run time."""
    if how not in AGGREGATES:
        raise ValueError(f"how must be one of {sorted(AGGREGATES)}")
    return df.groupBy(*keys).agg(AGGREGATES[how](value).cast("double").alias(out))


def count_by(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def bounds(df: DataFrame, *cols: str) -> DataFrame:
    """One row with the minimum and maximum of each column."""
    return df.agg(
        *[f(c).alias(f"{n}_{c}") for c in cols for n, f in (("min", F.min), ("max", F.max))]
    )


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: its type, rows, missing values and text of its least and largest value. One pass."""
    kinds = dict(df.dtypes)
    names = list(columns or [c for c, kind in df.dtypes if not kind.startswith(("array", "map", "struct"))])
    clean = {c: present(c) if kinds[c] in ("double", "float") else F.col(c) for c in names}
    row = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"), F.lit(kinds[c]).alias("type"), F.count(F.lit(1)).alias("n_rows"),
                    (F.count(F.lit(1)) - F.count(x)).alias("n_missing"),
                    F.min(x).cast("string").alias("least"), F.max(x).cast("string").alias("largest"),
                )
                for c, x in clean.items()
            ]
        ).alias("p")
    )
    return row.select(F.explode("p").alias("p")).select("p.*")


def annotation(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """What a plot writes beside a group: ``n``, the least x and the largest y of the rows with both values."""
    both = df.where(present(x).isNotNull() & present(y).isNotNull())
    return both.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(x).alias("min_x"), F.max(y).alias("max_y"))
