"""Form rows as they land: standardised and split into media events without state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from fieldspark.plans.effort import media_events, standardise_form
from fieldspark.session import checkpoint_root


def media_event_stream(spark: SparkSession, landed: str, schema: StructType) -> DataFrame:
    """Media events from a folder of landed Parquet form files."""
    return media_events(standardise_form(spark.readStream.schema(schema).parquet(landed)))


def append_media_events(
    events: DataFrame, out: str, name: str, checkpoints: str | None = None
) -> StreamingQuery:
    """Append what has landed so far to a Parquet table, each form row once.

    Progress is kept under the cluster's checkpoint folder, so a restart goes on where it ended.
    """
    root = checkpoint_root(events.sparkSession, checkpoints)
    return (
        events.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", f"{root}/{name}")
        .trigger(availableNow=True)
        .start()
    )
