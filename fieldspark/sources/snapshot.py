"""Versioned snapshots of a table with a pointer to the latest and selection of expired versions."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.fixed_values import SNAPSHOT_RETENTION_DAYS


def snapshot_paths(root: str, name: str, at: datetime) -> tuple[str, str]:
    safe = re.sub(r"[^A-Za-z0-9_\-]+", "_", name)
    stamp = at.strftime("%Y%m%d_%H%M%S")
    return f"{root}/{safe}/versions/snapshot_ts={stamp}", f"{root}/{safe}/latest"


def snapshot(df: DataFrame, root: str, name: str, at: datetime) -> tuple[str, str]:
    """Write a version, then let a new pointer name it as the latest.

    The source is computed once. Pointers are only ever added, so readers always find a whole version; if the write
    fails, or the version exists, the latest one stays what it was.
    """
    version, latest = snapshot_paths(root, name, at)
    df.write.mode("error").parquet(version)
    stamp = version.rsplit("=", 1)[1]
    df.sparkSession.createDataFrame([(stamp,)], "snapshot_ts string").coalesce(1).write.mode("append").json(latest)
    return version, latest


def manifest(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One row per version: ``snapshot_ts``. Read from the pointers; no version is opened."""
    return spark.read.schema("snapshot_ts string").json(snapshot_paths(root, name, datetime(2000, 1, 1))[1]).distinct()


def read_latest(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The version that the last pointer names."""
    stamp = manifest(spark, root, name).agg(F.max("snapshot_ts")).first()[0]
    if stamp is None:
        raise ValueError(f"no snapshot of {name}")
    return spark.read.parquet(snapshot_paths(root, name, datetime.strptime(stamp, "%Y%m%d_%H%M%S"))[0])


def expired(
    listing: DataFrame, taken: str, as_of: datetime, days: int = SNAPSHOT_RETENTION_DAYS
) -> DataFrame:
    """Rows whose age in whole days exceeds ``days``. Selects only; removing is up to the caller."""
    age = F.datediff(F.lit(as_of), F.col(taken)) - F.when(
        F.date_format(F.col(taken), "HHmmssSSSSSS") > F.lit(as_of.strftime("%H%M%S%f")), 1
    ).otherwise(0)
    return listing.where(age > days)


def parse_stamp(c: Column) -> Column:
    return F.try_to_timestamp(c, F.lit("yyyyMMdd_HHmmss"))
