"""Gear effort: form rows -> media events -> soak time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.fixed_values import EFFORT_SITE_ALIASES, MEDIA_TYPE_PATTERNS
from fieldspark.functions.dates import day_of, days_between, moment_of
from fieldspark.functions.nulls import as_column
from fieldspark.functions.text import classify, recode, squish_to_null
from fieldspark.operators.aggregates import arrival_order, summarise
from fieldspark.operators.asof import prior_event_in_place
from fieldspark.operators.reshape import split_to_rows
from fieldspark.sources.landed import ROW_ID

DEPLOYMENT, COLLECTION, SURVEY = "Deployment", "Collection", "Survey"
EVENT_KEYS = ["site", "event_date", "event_record", "sample_type"]


def by_event(deployment: Column | str, collection: Column | str, survey: Column | str | None, *others: Column | str) -> Column:
    """The column that holds a value for the row's kind of event.

    ``others`` are tried in turn for rows of an unknown kind.
    """
    kind = F.col("event_record")
    return (
        F.when(kind == DEPLOYMENT, as_column(deployment))
        .when(kind == COLLECTION, as_column(collection))
        .when(kind == SURVEY, as_column(survey) if survey is not None else F.lit(None))
        .otherwise(F.coalesce(*[as_column(c) for c in others]) if others else F.lit(None))
    )


def standardise_form(form: DataFrame, aliases=EFFORT_SITE_ALIASES) -> DataFrame:
    """One date, site, sample list and note per form row. Stateless, so it also runs on a stream."""
    # dates are read here, once for each cell, and only passed on from here
    moments, days = {"timestamp": moment_of(form, "timestamp")}, {c: day_of(form, c) for c in ("date_deployed", "date_collected")}
    kind_known = form.withColumns({"event_record": squish_to_null("event_record"), **moments, **days})
    site = by_event("site_9", "site_5", "site_surveyed", "site_5", "site_9", "site_surveyed")
    notes = by_event("notes_11", "notes_7", "notes_13", "notes_7", "notes_11", "notes_13")
    sent = F.to_date("timestamp")
    day = by_event("date_deployed", "date_collected", sent, "date_collected", "date_deployed", sent)
    extra = [c for c in (ROW_ID,) if c in form.columns]
    return kind_known.select(
        "timestamp",
        squish_to_null("email_address").alias("email_address"),
        "event_record",
        day.alias("event_date"),
        squish_to_null(site).alias("site"),
        squish_to_null(by_event("samples_deployed", "samples_collected", None)).alias("samples"),
        squish_to_null(notes).alias("notes"),
        *extra,
    ).withColumn("site", recode("site", aliases))


def survey_table(effort: DataFrame) -> DataFrame:
    return effort.where(F.col("event_record") == SURVEY).select(
        "timestamp", "email_address", "event_date", "site", "notes"
    )


def media_events(effort: DataFrame, patterns=MEDIA_TYPE_PATTERNS) -> DataFrame:
    """One row per listed medium of deployments and collections, with its type. Stateless."""
    gear = effort.where(F.col("event_record").isin(DEPLOYMENT, COLLECTION))
    return split_to_rows(gear, "samples").select(
        "timestamp", "email_address", "event_record", "event_date", "site", "samples",
        classify("samples", patterns).alias("sample_type"),
        "notes",
        *[c for c in (ROW_ID,) if c in effort.columns],
    )


def effort_table(media: DataFrame) -> DataFrame:
    """Replicates collapsed to one row per site, date, event and media type."""
    typed = media.where(F.col("sample_type").isNotNull())
    ordered = arrival_order("timestamp", ROW_ID) if ROW_ID in media.columns else F.col("timestamp")
    return summarise(
        typed,
        EVENT_KEYS,
        {"timestamp": ("min", "timestamp")},
        first_texts={"email_address": "email_address"},
        ordered_texts={"notes": "notes"},
        order=ordered,
    )


def soak_time(effort: DataFrame, unmatched: str = "drop") -> DataFrame:
    """Each collection with its latest earlier deployment and the days between.

    The effort table has one row per site, media type, day and kind of event, so deployments and
    collections are paired in place, without splitting the table and joining it to itself.
    """
    gear = effort.where(F.col("event_record").isin(DEPLOYMENT, COLLECTION))
    paired = prior_event_in_place(
        gear,
        ["site", "sample_type"],
        time="event_date",
        is_event=F.col("event_record") == DEPLOYMENT,
        event={"date_deployed": "event_date", "deploy_timestamp": "timestamp", "deploy_notes": "notes"},
        unmatched=unmatched,
    ).withColumnsRenamed(
        {"event_date": "date_collected", "timestamp": "collect_timestamp", "notes": "collect_notes"}
    )
    return paired.select(
        "site", "sample_type", "date_deployed", "date_collected",
        days_between("date_collected", "date_deployed").alias("soak_time"),
        "deploy_timestamp", "collect_timestamp", "deploy_notes", "collect_notes",
    )
