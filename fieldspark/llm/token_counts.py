"""Token counts through a digest cache: only distinct texts that the cache does not hold are encoded."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from fieldspark.llm import tokens
from fieldspark.llm.common import in_batches, landed, quoted, slices, text_column, workspace

CACHE_SCHEMA = "digest binary, version string, n_tokens long"


def read_cache(spark, path: str) -> DataFrame:
    """The stored counts; a folder that is not there yet is an empty cache."""
    try:
        return spark.read.schema(CACHE_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE_SCHEMA)


def count_tokens(
    docs: DataFrame, tokenizer_path: str, cache_path: str, id_column: str = "doc_id", text: Column | None = None, limit: int = 1024
) -> DataFrame:
    """Tokens of each text: the identifier, ``n_bytes``, ``n_tokens`` and ``over_limit``, a row for each row.

    ``text`` is the normalised content (default: column ``text``, null as empty). Its SHA-256 and that of the
    tokenizer file are looked up in the Parquet table at ``cache_path``; each distinct text not found there is encoded
    once and its count appended. An append that is cut short leaves either a whole file or none, and a repeated
    entry does no harm. Null and repeated identifiers keep their rows; columns besides the two are not read.
    """
    spark = docs.sparkSession
    folder, version = workspace(spark, "counts"), tokens.version(tokenizer_path)
    rows = docs.select(quoted(id_column).alias("__id"), (text if text is not None else text_column()).alias("__text"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("__text", 256)))
    digests = landed(rows.select("__id", "digest", F.octet_length("__text").cast("long").alias("n_bytes")), folder, "digests")
    known = read_cache(spark, cache_path).where(F.col("version") == version)
    # one row stands for all with its text; the identifier in the key spreads the copies of one text
    chosen = digests.groupBy("digest").agg(F.min("__id").alias("__chosen")).join(known, "digest", "left_anti")
    misses = rows.join(
        chosen.withColumnRenamed("digest", "__digest").hint("shuffle_hash"),
        (F.col("digest") == F.col("__digest")) & F.col("__id").eqNullSafe(F.col("__chosen")),
    )
    schema = T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("n_tokens", T.LongType())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokens.tokenizer(tokenizer_path)
        for batch in slices(batches, "__text"):
            ids = tokenizer.encode(batch.column("__text").to_pylist())
            counts = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(counts)], ["digest", "n_tokens"])

    # rows equal in text and identifier are encoded each, but stored once
    counted = in_batches(misses.select("digest", "__text"), encode, schema, keeps=True).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    counted.select("digest", F.lit(version).alias("version"), "n_tokens").write.mode("append").parquet(cache_path)
    known = read_cache(spark, cache_path).where(F.col("version") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    known = landed(known, folder, "known")
    return digests.join(known, "digest").select(
        F.col("__id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
