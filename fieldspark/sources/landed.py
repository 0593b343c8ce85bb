"""Reading landed sheets, CSV files and saved tables.

A sheet is landed once per tab as Parquet or CSV with every column as text and a ``_row_id``
holding the row's position in the sheet. Fetching sheets from online services is outside.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fieldspark.sources.typing import clean_names

ROW_ID = "_row_id"


def read_landed(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A landed sheet with repaired column names."""
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    df = clean_names(reader.format(fmt).load(path), keep=[ROW_ID])
    return df.withColumn(ROW_ID, F.col(ROW_ID).cast("bigint")) if ROW_ID in df.columns else df


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A CSV file under a declared schema; no inference pass."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table saved by ``sinks.write_table``."""
    return spark.read.parquet(path)


def drop_first_row(df: DataFrame, row_id: str = ROW_ID) -> DataFrame:
    """Without the example row at the top of a sheet, the one with the smallest row id."""
    first = df.agg(F.min(row_id)).scalar()
    return df.where(F.col(row_id) > first)
