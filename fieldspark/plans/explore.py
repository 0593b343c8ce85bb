"""Count explorers: filter choices, summaries by chosen group and statistic, map table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.fixed_values import BUBBLE_RANGE, COUNT_COLUMNS, HABITAT_PATTERNS, TAXON_LABELS, URCHIN_COLUMNS
from fieldspark.functions.dates import day_of
from fieldspark.functions.models import rescale
from fieldspark.functions.nulls import level_rank, num_text, present, row_sum
from fieldspark.functions.text import classify, location_id
from fieldspark.operators.aggregates import bounds, summarise_by
from fieldspark.operators.joins import join_suffix, keep_members
from fieldspark.operators.reshape import to_long
from fieldspark.sources.typing import number, numbers


def prepare_counts(form: DataFrame) -> DataFrame:
    """Adds collection day, urchin total, habitat and site id to the count form."""
    form = numbers(form, *COUNT_COLUMNS)
    return form.withColumns(
        {
            "collection_date": day_of(form, "collection_date"),
            "total_urchins": row_sum(*URCHIN_COLUMNS),
            "habitat": classify("location", HABITAT_PATTERNS, "Other"),
            "site_id": location_id("location"),
        }
    )


def select_counts(
    df: DataFrame,
    day: str = "collection_date",
    first: date | None = None,
    last: date | None = None,
    **choices: Sequence | None,
) -> DataFrame:
    """Filter by day range and by chosen values per column; an empty choice filters nothing."""
    if first is not None:
        df = df.where(F.col(day) >= F.lit(first))
    if last is not None:
        df = df.where(F.col(day) <= F.lit(last))
    for column, values in choices.items():
        if values:
            df = df.where(F.col(column).isin(list(values)))
    return df


def count_summary(
    counts: DataFrame, group: str, taxa: Sequence[str], how: str = "sum", by: str = "substrate_type"
) -> DataFrame:
    """Sum or mean per chosen group, substrate and taxon, a missing count taken as zero.

    Sum and count are taken per group before taxa become rows, so the shuffle carries groups
    rather than one row per sample and taxon.
    """
    filled = counts.select(group, by, *[F.coalesce(present(t), F.lit(0)).cast("double").alias(t) for t in taxa])
    wide = filled.groupBy(group, by).agg(
        *[(F.sum(t) if how == "sum" else F.avg(t)).alias(t) for t in taxa]
    )
    if how not in ("sum", "mean"):
        raise ValueError("how must be 'sum' or 'mean'")
    return to_long(wide, [group, by], list(taxa), "taxon", "value")


def with_taxon_order(summary: DataFrame) -> DataFrame:
    """Adds the taxon's label and its place in the declared order."""
    label = F.create_map(*[F.lit(x) for pair in TAXON_LABELS.items() for x in pair])
    return summary.withColumn("taxon_label", F.element_at(label, F.col("taxon"))).withColumn(
        "taxon_rank", level_rank("taxon", list(TAXON_LABELS))
    )


def site_positions(sites: DataFrame) -> DataFrame:
    return sites.select(
        F.col("site_name").alias("site_id"),
        F.col("site_name").alias("location"),
        number(F.col("latitude").cast("string")).alias("lat"),
        number(F.col("longitude").cast("string")).alias("lon"),
        "mpa",
        "depth_m",
    )


def map_summary(
    counts: DataFrame,
    sites: DataFrame,
    taxa: Sequence[str],
    how: str = "sum",
    locations: Sequence[str] | None = None,
    by: str = "substrate_type",
) -> DataFrame:
    """Chosen taxa summed per sample, then per site and substrate, with the site's position."""
    if locations:
        counts = keep_members(counts, sites, "site_id", F.col("location").isin(list(locations)))
    values = counts.select("site_id", by, row_sum(*taxa).cast("double").alias("value"))
    placed = join_suffix(
        summarise_by(values, ["site_id", by], "value", how), sites, ["site_id"], "left"
    )
    return placed.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())


def with_bubbles(
    mapped: DataFrame, log_scale: bool = True, to: tuple[float, float] = BUBBLE_RANGE, by: str = "substrate_type"
) -> DataFrame:
    """Adds bubble radius and label text; the value range is a one-value subquery."""
    sized = mapped.withColumn("__size", F.log1p("value") if log_scale else F.col("value"))
    ends = sized.agg(F.struct(F.min("__size").alias("lo"), F.max("__size").alias("hi"))).scalar()
    lo, hi = ends["lo"], ends["hi"]
    return (
        sized.withColumn("radius", rescale(F.col("__size"), lo, hi, to))
        .withColumn(
            "label",
            F.concat("location", F.lit(" | "), F.col(by), F.lit(" | value: "), num_text("value")),
        )
        .drop("__size")
    )


def map_bounds(mapped: DataFrame) -> DataFrame:
    return bounds(mapped, "lon", "lat")


def filter_choices(df: DataFrame, day: str, columns: Sequence[str]) -> DataFrame:
    """Distinct values per column with their first and last day, and one row for all days.

    One pass: every row offers its values, which combine map-side.
    """
    offers = F.array(
        F.struct(F.lit(day).alias("field"), F.lit(None).cast("string").alias("choice")),
        *[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("choice")) for c in columns],
    )
    return (
        df.select(F.col(day).alias("__day"), F.explode(offers).alias("o"))
        .where((F.col("o.field") == day) | F.col("o.choice").isNotNull())
        .groupBy(F.col("o.field").alias("field"), F.col("o.choice").alias("choice"))
        .agg(F.min("__day").alias("first_day"), F.max("__day").alias("last_day"))
    )
