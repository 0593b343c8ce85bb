"""Exact deduplication by a content sort.

Sampled splitters range-partition the texts by their first bytes and digest, Spark's external sort places
equal texts side by side, and each row is compared in full with its neighbour. A group of copies may
cover many ranges: equal texts are put in order of their identifier, so splitters fall inside the group too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.common import crossing, landed, neighbour_runs, partitions_for, text_column, workspace

#: Characters of a text that may become part of a splitter, which bounds what the driver holds.
SPLITTER_CHARS = 32


def _numbered(docs: DataFrame, text: Column, order: list[Column], carried: list[str]) -> DataFrame:
    prepared = docs.select(*carried, text.alias("__text")).withColumns(
        {"__start": F.substring("__text", 1, SPLITTER_CHARS), "__hash": F.xxhash64("__text"), "__sha": F.sha2("__text", 256)}
    )
    n = partitions_for(docs.sparkSession)
    return neighbour_runs(prepared, ["__text"], order, n, splitters=["__start", "__hash"])


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text: Column | None = None, keep: str = "largest") -> DataFrame:
    """One row for each row of ``docs``: its group of equal texts and whether it stays.

    ``text`` is the normalised text (default: column ``text``, null as empty). ``keep`` names the identifier that stays,
    ``largest`` or ``smallest``; a null identifier stays only if the group has no other. Of rows equal in text and
    identifier one stays. Returns the identifier, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.
    No rows give no rows; columns besides the two are not read.
    """
    folder = workspace(docs.sparkSession, "exact")
    order = F.col("__id").desc_nulls_last() if keep == "largest" else F.col("__id").asc_nulls_last()
    rows = docs.select(F.col(id_column).alias("__id"), (text if text is not None else text_column()).alias("__text"))
    numbered = _numbered(rows, F.col("__text"), [order], ["__id"])
    numbered = landed(
        numbered.select("__id", F.when(F.col("edge"), F.col("__text")).alias("__text"), "__sha", "run", "head", "edge"), folder, "runs"
    )
    joined = crossing(numbered, ["__text"])
    rows = numbered.where("not edge").drop("__text", "edge").join(F.broadcast(joined), "run", "left")
    rows = rows.withColumn("kept", F.col("head") & F.col("whole").isNull()).withColumn("run", F.coalesce("whole", "run"))
    groups = rows.groupBy("run").agg(
        F.count("*").alias("group_size"), F.max(F.when(F.col("kept"), F.col("__id"))).alias("keep_id")
    )
    # from a table of its own the join reads plain shuffles, which Spark splits where one run has many rows
    groups = landed(groups, folder, "groups")
    return rows.join(groups, "run").select(
        F.col("__id").alias(id_column), "keep_id", "group_size", "kept", F.col("__sha").alias("text_sha256")
    )


def drop_exact(docs: DataFrame, id_column: str = "doc_id", text: Column | None = None, keep: str = "largest") -> DataFrame:
    """The rows of ``docs`` that stay, all columns. Same rules as ``exact_groups``."""
    folder = workspace(docs.sparkSession, "exact")
    order = F.col("__id").desc_nulls_last() if keep == "largest" else F.col("__id").asc_nulls_last()
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
        F.col(id_column).alias("__id"),
        (text if text is not None else text_column()).alias("__text"),
    )
    numbered = _numbered(rows, F.col("__text"), [order], ["__row", "__id"])
    heads = landed(
        numbered.where("head or edge").select("__row", F.when(F.col("edge"), F.col("__text")).alias("__text"), "run", "edge"), folder, "heads"
    )
    joined = crossing(heads, ["__text"])
    return heads.where("not edge").join(F.broadcast(joined), "run", "left_anti").select("__row.*")
