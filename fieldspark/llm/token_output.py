"""Token ids as fixed-width binary rows: best-fit-decreasing packing with a segment tree over free space."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.llm import tokens
from fieldspark.llm.common import slices
from fieldspark.llm.pieces import cut, with_end

#: Tokens that a task packs together; its memory is a few times that in bytes of ids.
BLOCK_TOKENS = 4 << 20

SCHEMA = (
    "sequence_id long, n_tokens int, input_ids binary, position_ids binary, cu_seqlens array<int>,"
    " doc_ids array<long>, pieces array<int>, starts array<long>"
)


class SpaceTree:
    """Counts of bins by free space 0 to ``capacity`` in a segment tree; finds the least space that is large enough."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.total = [0] * (2 * self.leaves)

    def change(self, space: int, by: int) -> None:
        i = space + self.leaves
        while i:
            self.total[i] += by
            i >>= 1

    def least_from(self, space: int) -> int | None:
        i, total = space + self.leaves, self.total
        if total[i]:
            return space
        # up to the first ancestor with bins to the right, then down on its left edge
        while i > 1 and (i & 1 or not total[i + 1]):
            i >>= 1
        if i <= 1:
            return None
        i += 1
        while i < self.leaves:
            i = 2 * i if total[2 * i] else 2 * i + 1
        return i - self.leaves


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers, each in the order of placing; lengths are 1 to ``capacity``."""
    tree, spaces, bins = SpaceTree(capacity), [[] for _ in range(capacity + 1)], []
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[item]
        space = tree.least_from(n)
        if space is None:
            space, number = capacity, len(bins)
            bins.append([])
        else:
            number = spaces[space].pop()
            tree.change(space, -1)
        bins[number].append(item)
        if space > n:
            spaces[space - n].append(number)
            tree.change(space - n, 1)
    return bins


def packed_rows(
    docs: DataFrame, tokenizer_path: str, width: int = 2048, end_id: int = 50256, block_tokens: int = BLOCK_TOKENS
) -> DataFrame:
    """Rows of ``width`` ids from whole documents (``doc_id``, ``text``), packed where they are read: no shuffle.

    A document is its ids and ``end_id``; a null or empty text is ``end_id`` alone. Longer ones are cut in pieces of ``width`` and a
    rest. ``input_ids`` and ``position_ids`` are little-endian unsigned 32-bit rows, filled up with ``end_id`` and 0.
    ``cu_seqlens`` bounds the pieces in a row (0 first, ``n_tokens`` last); positions start again at each piece.
    ``doc_ids``, ``pieces`` and ``starts`` name each piece and its place in its document, from which ``documents_of`` puts
    documents together again. Null and repeated ``doc_id`` are kept as they are; no rows give no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text").withColumn("__part", F.spark_partition_id())

    def block(held: list[tuple], base: int) -> pa.RecordBatch:
        bins = best_fit_decreasing([len(ids) // 4 for *_, ids in held], width)
        columns: list[list] = [[] for _ in range(8)]
        for number, items in enumerate(bins):
            lengths = [len(held[i][3]) // 4 for i in items]
            bounds = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            n = int(bounds[-1])
            ids = np.full(width, end_id, np.uint32)
            ids[:n] = np.frombuffer(b"".join(held[i][3] for i in items), np.uint32)
            positions = np.zeros(width, np.uint32)
            positions[:n] = np.arange(n) - np.repeat(bounds[:-1], lengths)
            values = (
                base + number, n, ids.tobytes(), positions.tobytes(), bounds,
                [held[i][0] for i in items], [held[i][1] for i in items], [held[i][2] for i in items],
            )
            for column, value in zip(columns, values):
                column.append(value)
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64())]
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokens.tokenizer(tokenizer_path)
        held, size, base = [], 0, None
        for batch in slices(batches, "text"):
            base = int(batch.column("__part")[0].as_py()) << 40 if base is None else base
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), tokenizer.encode(texts)):
                for piece, part in enumerate(cut(with_end(ids, end_id), width)):
                    held.append((doc_id, piece, piece * width, part))
                    size += len(part) // 4
            if size >= block_tokens:
                out = block(held, base)
                base, held, size = base + out.num_rows, [], 0
                yield from _small(out)
        if held:
            yield from _small(block(held, base))

    return rows.mapInArrow(pack, SCHEMA)


def _small(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def write_packed(packed: DataFrame, path: str) -> None:
    """Write the rows as Parquet, binary columns uncompressed lists of fixed width."""
    packed.write.parquet(path)


def documents_of(packed: DataFrame) -> DataFrame:
    """The inverse of ``packed_rows`` for unique ``doc_id``: ``doc_id`` and its ``ids`` (with the end id) as bytes."""
    places = F.arrays_zip("doc_ids", "starts", F.slice("cu_seqlens", 1, F.size("doc_ids")).alias("at"), F.slice("cu_seqlens", 2, F.size("doc_ids")).alias("end"))
    parts = packed.select("input_ids", F.explode(places).alias("p")).select(
        F.col("p.doc_ids").alias("doc_id"), F.col("p.starts").alias("start"),
        F.expr("substring(input_ids, p.at * 4 + 1, (p.end - p.at) * 4)").alias("ids"),
    )
    ordered = parts.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start", F.hex("ids").alias("ids")))).alias("parts"))
    return ordered.select("doc_id", F.unhex(F.array_join("parts.ids", "")).alias("ids"))
