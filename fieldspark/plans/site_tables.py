"""Site lookup tables with standard names, official dates and coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldspark.functions.dates import MONTH_FIRST, YEAR_FIRST, latest_of
from fieldspark.functions.text import site_code_padded
from fieldspark.sources.typing import all_text, apply_schema

_text, _number, _day = T.StringType(), T.DoubleType(), T.DateType()

MARGIN_TYPES = T.StructType(
    [T.StructField(c, _text) for c in ("survey_type", "region", "site_name_2024", "site_name_2025")]
    + [
        T.StructField(c, _number)
        for c in (
            "transect", "heading_out", "target_latitude", "target_longitude",
            "actual_latitude", "actual_longitude",
        )
    ]
    + [T.StructField(c, _day) for c in ("date_surveyed", "resite_date")]
)

RECOVERY_TYPES = T.StructType(
    [
        T.StructField(c, _text)
        for c in (
            "survey_type", "region", "site_name_2024", "site_type_2024", "site_name_2025",
            "site_type_2025", "transect", "notes",
        )
    ]
    + [
        T.StructField(c, _number)
        for c in ("old_latitude", "old_longitude", "new_latitude", "new_longitude")
    ]
    + [
        T.StructField(c, _day)
        for c in (
            "original_date_surveyed_2024", "resite_date_2024",
            "original_date_surveyed_2025", "resite_date_2025",
        )
    ]
)
# the 2025 dates were typed month first; either form is read for both years
_ANY_DATE = [*YEAR_FIRST, *MONTH_FIRST]
RECOVERY_DATES = {f.name: _ANY_DATE for f in RECOVERY_TYPES if isinstance(f.dataType, T.DateType)}


def margin_site_table(landed: DataFrame) -> DataFrame:
    """Margin sites that have a 2025 name; actual position and latest survey date where known."""
    sites = apply_schema(landed, MARGIN_TYPES).where(F.col("site_name_2025").isNotNull())
    return sites.select(
        "survey_type",
        "region",
        site_code_padded("site_name_2024").alias("site_name_2024"),
        site_code_padded("site_name_2025").alias("site_name_2025"),
        "transect",
        "heading_out",
        F.coalesce("actual_latitude", "target_latitude").alias("latitude"),
        F.coalesce("actual_longitude", "target_longitude").alias("longitude"),
        latest_of("resite_date", "date_surveyed").alias("survey_date"),
        F.col("date_surveyed").alias("date_surveyed_originally"),
    )


def recovery_site_table(landed: DataFrame) -> DataFrame:
    """Recovery sites with one official survey date per year; the text NULL is missing."""
    sites = apply_schema(all_text(landed), RECOVERY_TYPES, RECOVERY_DATES)
    return sites.select(
        "survey_type",
        "region",
        site_code_padded("site_name_2025").alias("site_name_2025"),
        "site_type_2025",
        site_code_padded("site_name_2024").alias("site_name_2024"),
        "site_type_2024",
        F.col("transect").alias("zone"),
        F.col("new_latitude").alias("latitude"),
        F.col("new_longitude").alias("longitude"),
        F.col("old_latitude").alias("latitude_old"),
        F.col("old_longitude").alias("longitude_old"),
        *[
            latest_of(f"resite_date_{y}", f"original_date_surveyed_{y}").alias(f"survey_date_{y}")
            for y in (2024, 2025)
        ],
        "notes",
    )
