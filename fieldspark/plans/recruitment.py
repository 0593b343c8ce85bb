"""Recruitment counts: clean samples, summarise, join effort, rates and weekly series."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.fixed_values import (
    COLLECTION_DATE_CORRECTIONS,
    COUNT_COLUMNS,
    COUNT_SITE_ALIASES,
    MEDIA_TO_POSITION,
    MEDIA_TYPE_PATTERNS,
    PATCH_ORDER,
    PATCH_PATTERNS,
    POSITION_ORDER,
    SUBSTRATE_TO_MEDIA,
    URCHIN_COLUMNS,
)
from fieldspark.functions.dates import day_of, moment_of, week_start
from fieldspark.functions.models import offset_log10
from fieldspark.functions.nulls import level_rank, ratio, row_sum, sum0
from fieldspark.functions.text import labelled, recode, squish, squish_to_null
from fieldspark.operators.aggregates import summarise
from fieldspark.operators.joins import join_suffix
from fieldspark.sources.landed import ROW_ID
from fieldspark.sources.typing import numbers

SAMPLE_KEYS = ["site", "collection_date"]
EFFORT_KEYS = ["site", "date_collected"]


def corrected_date(site, raw, corrections: Sequence[tuple[str, str, str]]):
    """The raw date, or its correction where (site, date) is a known error."""
    out = raw
    for where, typed, sampled in corrections:
        hit = (site == where) & (raw == F.lit(date.fromisoformat(typed)))
        out = F.when(hit, F.lit(date.fromisoformat(sampled))).otherwise(out)
    return out


def correct_dates(
    df: DataFrame, corrections: DataFrame, keys: Sequence[str], raw: str, corrected: str, out: str
) -> DataFrame:
    """The same from a table of corrections (``keys``, ``raw``, ``corrected``); adds ``<out>_corrected``."""
    joined = join_suffix(df, corrections.select(*keys, raw, corrected), [*keys, raw], "left")
    return joined.withColumn(out, F.coalesce(corrected, raw)).withColumn(
        f"{out}_corrected", F.col(out) != F.col(raw)
    )


def clean_counts(
    form: DataFrame, aliases=COUNT_SITE_ALIASES, corrections=COLLECTION_DATE_CORRECTIONS
) -> DataFrame:
    """Typed samples with site code, urchin total, corrected collection date and a flag."""
    form = numbers(form, *COUNT_COLUMNS)
    squished = form.withColumns(
        {
            "timestamp": moment_of(form, "timestamp"),
            "collection_date_raw": day_of(form, "collection_date"),
            "sorting_date": day_of(form, "sorting_date"),
            "location": squish("location"),
            "substrate_type": squish("substrate_type"),
            "sorter_name": squish("name_of_person_sorting_first_last"),
            "notes": squish_to_null("notes"),
        }
    )
    # one step per column that others look at, so that each is worked out once per row
    coded = squished.withColumn("site", recode("location", aliases))
    dated = coded.withColumn(
        "collection_date", corrected_date(F.col("site"), F.col("collection_date_raw"), corrections)
    )
    return dated.withColumns(
        {
            "total_urchins": row_sum(*URCHIN_COLUMNS),
            "collection_date_corrected": F.col("collection_date") != F.col("collection_date_raw"),
        }
    )


def sample_summary(samples: DataFrame, collation: str | None = None) -> DataFrame:
    """Totals, dates and text lists per site and collection date; notes in sheet order, other texts in that of ``collation``."""
    order = ROW_ID if ROW_ID in samples.columns else "timestamp"
    return summarise(
        samples,
        SAMPLE_KEYS,
        {
            "n_rows": ("rows", None),
            "total_vials": ("sum", "number_of_vials_in_sample"),
            "total_purple_urchins": ("sum", "number_of_purple_urchins"),
            "total_red_urchins": ("sum", "number_of_red_urchins"),
            "total_unidentified_urchins": ("sum", "number_of_unidentified_urchins"),
            "total_urchins": ("sum", "total_urchins"),
            "total_crabs": ("sum", "number_of_crabs"),
            "total_gastropods": ("sum", "number_of_gastropods"),
            "total_bivalves": ("sum", "number_of_bivalves"),
            "total_plastic": ("sum", "number_of_plastic"),
            "first_sorting_date": ("min", "sorting_date"),
            "last_sorting_date": ("max", "sorting_date"),
            "any_collection_date_corrected": ("any", "collection_date_corrected"),
        },
        distinct_counts={"n_unique_sample_numbers": "sample_number"},
        sorted_texts={
            "substrate_types": "substrate_type",
            "sorters": "sorter_name",
            "raw_collection_dates": "collection_date_raw",
        },
        ordered_texts={"notes": "notes"},
        order=F.col(order),
        collation=collation,
    )


def effort_summary(soak: DataFrame, patterns=MEDIA_TYPE_PATTERNS, collation: str | None = None) -> DataFrame:
    """Earliest deployment, longest soak and text lists per site and collection date.

    Notes come by media type, in order of the labels of ``patterns`` (those that ``media_events`` was given; a type without one after
    all others), then by time.
    """
    labels = sorted({label for _, label in patterns})
    rank = F.coalesce(level_rank("sample_type", labels), F.when(F.col("sample_type").isNotNull(), len(labels) + 1), F.lit(0))
    micros = F.coalesce(F.unix_micros(F.col("collect_timestamp").try_cast("timestamp")), F.lit(-(10**17)))
    return summarise(
        soak,
        EFFORT_KEYS,
        {"date_deployed": ("min", "date_deployed"), "soak_time": ("max", "soak_time")},
        sorted_texts={"sample_types": "sample_type"},
        ordered_texts={"deploy_notes": "deploy_notes", "collect_notes": "collect_notes"},
        order=rank.cast("decimal(19,0)") * F.lit(10**18).cast("decimal(19,0)") + micros.cast("decimal(19,0)"),
        collation=collation,
    )


def site_rates(samples: DataFrame, effort: DataFrame) -> DataFrame:
    """Counts per day of soak by site and date; missing where the soak is missing or zero."""
    joined = join_suffix(samples, effort, ["site", ("collection_date", "date_collected")], "left")
    return joined.select(
        "site", "collection_date", "raw_collection_dates", "any_collection_date_corrected",
        "date_deployed", "soak_time",
        "total_purple_urchins", "total_red_urchins", "total_unidentified_urchins", "total_urchins",
        ratio("total_purple_urchins", "soak_time").alias("daily_purple_urchins"),
        ratio("total_red_urchins", "soak_time").alias("daily_red_urchins"),
        ratio("total_unidentified_urchins", "soak_time").alias("daily_unidentified_urchins"),
        ratio("total_urchins", "soak_time").alias("daily_counts"),
        "total_crabs", "total_gastropods", "total_bivalves", "total_plastic",
        "total_vials", "n_rows", "n_unique_sample_numbers",
        "first_sorting_date", "last_sorting_date",
        "substrate_types", "sample_types", "sorters", "notes", "deploy_notes", "collect_notes",
    )


def _lookup(c, pairs: Sequence[tuple[str, str]]):
    return labelled([(c == value, label) for value, label in pairs])


def type_rates(
    samples: DataFrame, soak: DataFrame, substrates=SUBSTRATE_TO_MEDIA, patches=PATCH_PATTERNS
) -> DataFrame:
    """Counts per day of soak by site, date and media type, labelled by patch and position.

    ``samples`` come from ``clean_counts``, with the substrate squished.
    """
    patch = labelled([(F.col("site").rlike(pattern), label) for pattern, label in patches])
    counts = (
        samples.withColumn("sample_type", _lookup(F.lower("substrate_type"), substrates))
        .where(F.col("sample_type").isNotNull())
        .groupBy("site", "collection_date", "sample_type")
        .agg(sum0("total_urchins").alias("total_urchins"))
    )
    rates = join_suffix(
        counts,
        soak.select("site", "sample_type", "date_collected", "soak_time"),
        ["site", "sample_type", ("collection_date", "date_collected")],
        "left",
    )
    return (
        rates.withColumns(
            {
                "daily_counts": ratio("total_urchins", "soak_time"),
                "patch_type": patch,
                "position": _lookup(F.col("sample_type"), MEDIA_TO_POSITION),
            }
        )
        .where(
            F.col("daily_counts").isNotNull()
            & F.col("patch_type").isNotNull()
            & F.col("position").isNotNull()
        )
        .withColumns(
            {
                "patch_rank": level_rank("patch_type", PATCH_ORDER),
                "position_rank": level_rank("position", POSITION_ORDER),
                "daily_counts_adj": F.col("daily_counts") + F.lit(0.01),
                "log_daily_counts": offset_log10("daily_counts"),
            }
        )
    )


def weekly_totals(rates: DataFrame) -> DataFrame:
    return rates.groupBy(week_start("collection_date").alias("week"), "position").agg(
        sum0("total_urchins").alias("total_urchins")
    )
