"""Consistent sharding through a permutation-filled look-up table.

Each shard prefers the slots of a prime-sized table in an order of its own. The shards take turns claiming the first slot of
their order that is still free, so shares differ by one slot at most, and a change of the shards moves little else.
A key's slot is its hash modulo the table size, its shard one look-up.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.llm.common import quoted

#: Slots of the table: prime, and many for each shard. The table's size bounds what is broadcast.
SLOTS = 65_537
#: Parts that one shard is written in.
WRITERS = 4


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """For each slot the number of its shard. Depends on the names, not on their order, but for the numbering."""
    if not shards or len(set(shards)) < len(shards) or len(shards) > slots:
        raise ValueError("shards must be distinct, at least one and no more than slots")
    if slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be prime, so that every order visits all of them")
    turns = sorted(range(len(shards)), key=lambda i: shards[i])
    place, step = [0] * len(shards), [0] * len(shards)
    for i, name in enumerate(shards):
        digest = hashlib.blake2b(name.encode(), digest_size=16).digest()
        place[i] = int.from_bytes(digest[:8], "little") % slots
        step[i] = int.from_bytes(digest[8:], "little") % (slots - 1) + 1
    table, filled = [-1] * slots, 0
    while True:
        for i in turns:
            at = place[i]
            while table[at] >= 0:
                at = (at + step[i]) % slots
            table[at], place[i] = i, (at + step[i]) % slots
            filled += 1
            if filled == slots:
                return table


def table_frame(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """The table as rows ``slot, shard``."""
    return spark.createDataFrame([(s, shards[i]) for s, i in enumerate(lookup_table(shards, slots))], "slot int, shard string")


def assign_shards(docs: DataFrame, shards: list[str], key: Column | str = "doc_id", slots: int = SLOTS) -> DataFrame:
    """Adds ``slot`` and ``shard`` to every row; columns of these names are replaced.

    The slot is the 64-bit hash of ``key`` modulo ``slots``. A null key hashes like any other value and repeated keys go
    together; choose a key without hot values, as the identifier is. The table is broadcast: ``slots`` rows, whatever the
    data. No rows give no rows.
    """
    table = F.broadcast(table_frame(docs.sparkSession, shards, slots))
    hashed = F.pmod(F.xxhash64(key if isinstance(key, Column) else quoted(key)), F.lit(slots)).cast("int")
    carried = [c for c in docs.columns if c not in ("slot", "shard")]
    return docs.select(F.struct(*map(quoted, carried)).alias("it"), hashed.alias("slot")).join(table, "slot").select("it.*", "slot", "shard")


def write_shards(assigned: DataFrame, path: str, writers: int = WRITERS) -> None:
    """Write a folder ``shard=<name>`` for each shard, each by ``writers`` tasks, so that none is one task's work."""
    kinds = ("tinyint", "smallint", "int", "bigint", "float", "double", "string", "binary", "boolean", "date", "timestamp", "timestamp_ntz")
    plain = [quoted(c) for c, kind in assigned.dtypes if c != "shard" and (kind in kinds or kind.startswith("decimal"))]
    salt = F.pmod(F.xxhash64(*plain, F.lit(0)), F.lit(writers))
    assigned.repartition(quoted("shard"), salt).write.partitionBy("shard").parquet(path)
