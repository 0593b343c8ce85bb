"""Best-fit packing of documents into sequences, online and in bounded space."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.llm import tokens
from fieldspark.llm.common import in_batches, landed, slices, workspace
from fieldspark.llm.pieces import cut, with_end

#: Bins that a packer holds open, and the pieces that one packer gets.
OPEN_BINS, PACKER_PIECES = 4096, 50_000


class BoundedBestFit:
    """Online best fit with at most ``most`` open bins.

    Bit f of one number says that some open bin has f free places, so the tightest bin that fits is the lowest set bit
    from the length on. When a bin more than ``most`` would be open, the fullest closes.
    """

    def __init__(self, capacity: int, most: int = OPEN_BINS):
        self.capacity, self.most = capacity, most
        self._bits, self._open, self._bins = 0, 0, [[] for _ in range(capacity + 1)]
        self.count = 0

    def place(self, length: int) -> tuple[int, int]:
        """The bin of a piece, numbered from 0, and the offset in it."""
        fitting = self._bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self.capacity, self.count
            self.count += 1
        left = free - length
        if left:
            if self._open == self.most:
                self._take((self._bits & -self._bits).bit_length() - 1)
            self._bins[left].append(number)
            self._bits |= 1 << left
            self._open += 1
        return number, self.capacity - free

    def _take(self, free: int) -> int:
        bins = self._bins[free]
        number = bins.pop()
        if not bins:
            self._bits ^= 1 << free
        self._open -= 1
        return number


def token_pieces(docs: DataFrame, tokenizer_path: str, longest: int, end_id: int) -> DataFrame:
    """Rows ``doc_id, piece, start, length, ids_crc32`` of every document's ids followed by ``end_id``."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokens.tokenizer(tokenizer_path)
        for batch in slices(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            out = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), tokenizer.encode(texts)):
                for piece, part in enumerate(cut(with_end(ids, end_id), longest)):
                    out.append((doc_id, piece, piece * longest, len(part) // 4, zlib.crc32(part)))
            columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), *(pa.int64(),) * 3))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return in_batches(docs.select(F.col("doc_id").cast("long"), "text"), encode, schema, keeps=True)


def pack(pieces: DataFrame, capacity: int, open_bins: int = OPEN_BINS, packer_pieces: int = PACKER_PIECES) -> DataFrame:
    """Place pieces (column ``length``, 1 to ``capacity``) in sequences: adds ``sequence_id`` and ``offset``.

    Pieces are dealt out evenly, about ``packer_pieces`` to a packer, whatever their documents are. Of a packer's bins only the
    last ``open_bins`` can stay unfilled for want of pieces. Sequence numbers are unique, not dense. ``pieces`` is best a
    written table: it is counted first.
    """
    packers = -(-pieces.count() // packer_pieces) or 1
    dealt = pieces.repartition(packers).withColumn("__part", F.spark_partition_id())
    names = pieces.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = BoundedBestFit(capacity, open_bins)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            base = int(batch.column("__part")[0].as_py()) << 40
            lengths = batch.column("length").to_numpy()
            numbers, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
            # of the pieces at hand the long ones first: the short ones then fill what these leave
            for i in np.argsort(-lengths, kind="stable"):
                numbers[i], offsets[i] = bins.place(int(lengths[i]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(numbers + base), pa.array(offsets)], [*names, "sequence_id", "offset"]
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return in_batches(dealt, place, f"{fields}, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, open_bins: int = OPEN_BINS, packer_pieces: int = PACKER_PIECES
) -> DataFrame:
    """Pack whole documents (``doc_id``, ``text``) into sequences of at most ``capacity`` tokens.

    A null or empty text is its end id alone. Only documents longer than a sequence are cut, into full pieces and a rest.
    A null or repeated ``doc_id`` packs like any other row. No rows give no rows; further columns are not read.
    """
    pieces = landed(token_pieces(docs, tokenizer_path, capacity, end_id), workspace(docs.sparkSession, "best_fit"), "pieces")
    return pack(pieces, capacity, open_bins, packer_pieces)
