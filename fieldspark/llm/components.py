"""Connected components by contracting stars, on tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.common import discard, landed

#: Rounds after which something must be wrong: each round at least halves what is left to contract.
MOST_ROUNDS = 60


def connected_components(edges: DataFrame, folder: str) -> DataFrame:
    """Rows ``node, component`` (the smallest node that can be reached) for every node of ``edges`` (``a, b`` long).

    Each round gives every node's larger neighbours, and then its smaller ones, the least of its neighbourhood;
    it ends when nothing but stars is left. The heaviest node spreads over tasks by Spark's skew handling
    of the joins; minima are combined before the shuffle. Every round is written to ``folder``, where only the last one stays.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    spark, known = edges.sparkSession, "edges"
    edges = landed(edges, folder, known)
    for round_ in range(MOST_ROUNDS):
        # large star: a node's larger neighbours are tied to the least of all
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = landed(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), folder, f"large{round_}m")
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = landed(large, folder, f"large{round_}")
        # small star: a node's smaller neighbours and itself are tied to the least of them
        least = landed(large.groupBy("a").agg(F.min("b").alias("m")), folder, f"small{round_}m")
        tied = large.join(least, "a").select("b", "m").union(least.select(F.col("a").alias("b"), "m"))
        small = tied.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small = landed(small, folder, f"small{round_}")
        # stars are left when every node has one neighbour and no centre is tied to another
        state = small.groupBy("a").agg(F.count("*").alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
        for name in (known, f"large{round_}m", f"large{round_}", f"small{round_}m"):
            discard(spark, folder, name)
        edges, known = small, f"small{round_}"
        if state <= 1 and small.join(small.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty():
            break
    else:
        raise RuntimeError("connected components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
