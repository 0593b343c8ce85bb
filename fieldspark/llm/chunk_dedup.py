"""Substring deduplication by content-defined chunks.

A gear hash rolls over the last 32 bytes; a chunk ends where its high bits are zero, so an insertion shifts only the chunks
that it touches. Chunks equal by digest are repeats of the first one; runs of neighbouring repeats that are long enough
are removed.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.common import crossing, landed, neighbour_runs, partitions_for, slices, text_bytes, workspace
from fieldspark.llm.hashing import mix, salt

#: Bytes of a chunk, least and most; beyond the least one byte in ``1 << CUT_BITS`` ends it.
LEAST, MOST, CUT_BITS = 32, 256, 4
#: Bytes of neighbouring repeated chunks that make a repeated passage.
LEAST_RUN = 100

#: A value for each byte; the hash sums those of the last 32, each shifted by its age.
GEAR = (mix(np.arange(256, dtype=np.uint64) + salt(77)) >> np.uint64(32)).astype(np.uint32)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """h[i] = 2 * h[i - 1] + GEAR[data[i]] modulo 2**32, by doubling the window from 1 byte to 32."""
    h = GEAR[data]
    for width in (1, 2, 4, 8, 16):
        longer = h.copy()
        longer[width:] += h[:-width] << np.uint32(width)
        h = longer
    return h


def chunk_ends(data: np.ndarray, ends: np.ndarray, least: int = LEAST, most: int = MOST, bits: int = CUT_BITS) -> list[list[int]]:
    """Ends of the chunks of each text, as places in ``data``.

    ``least`` is at least the hash window, so that no chunk's end depends on bytes before its text.
    """
    cuts = np.flatnonzero(gear_hashes(data) >> np.uint32(32 - bits) == 0) + 1
    bounds = np.searchsorted(cuts, ends)
    out = []
    for start, stop, a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), bounds[:-1].tolist(), bounds[1:].tolist()):
        own = []
        for cut in cuts[a:b].tolist():
            while cut - start > most:
                start += most
                own.append(start)
            if cut - start >= least and cut < stop:
                start = cut
                own.append(cut)
        while stop - start > most:
            start += most
            own.append(start)
        if stop > start:
            own.append(stop)
        out.append(own)
    return out


def chunk_table(docs: DataFrame, least: int = LEAST, most: int = MOST, bits: int = CUT_BITS) -> DataFrame:
    """A row for each document: ``row`` (a number of its own), ``doc_id, n_bytes, lengths`` and the chunks' ``digests``."""

    def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = 0
        for batch in slices(batches, "text"):
            part = int(batch.column("__part")[0].as_py()) << 33
            data, ends = text_bytes(batch.column("text"))
            view, lengths, digests = memoryview(data), [], []
            for start, own in zip(ends[:-1].tolist(), chunk_ends(data, ends, least, most, bits)):
                stops = [start, *own]
                lengths.append(np.diff(stops).astype(np.int32))
                digests.append([blake2b(view[a:b], digest_size=16).digest() for a, b in zip(stops, own)])
            n = batch.num_rows
            columns = [
                pa.array(np.arange(n) + part + count), batch.column("doc_id"), pa.array(np.diff(ends)),
                pa.array(lengths, pa.list_(pa.int32())), pa.array(digests, pa.list_(pa.binary())),
            ]
            count += n
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "n_bytes", "lengths", "digests"])

    rows = docs.select(F.col("doc_id").cast("long"), "text").withColumn("__part", F.spark_partition_id())
    return rows.mapInArrow(chunk, "row long, doc_id long, n_bytes long, lengths array<int>, digests array<binary>")


def repeated_chunks(table: DataFrame, folder: str) -> DataFrame:
    """Chunks that an earlier document, or the same one before, has too: ``row, chunk`` (its number in the document).

    The first in order of ``doc_id`` (null first), row and place is no repeat. One shuffle by sampled ranges of digest and place, so that a
    chunk with many copies spreads over ranges.
    """
    chunks = table.select("row", "doc_id", F.posexplode("digests").alias("chunk", "digest"))
    numbered = neighbour_runs(chunks, ["digest"], [F.col("doc_id"), F.col("row"), F.col("chunk")], partitions_for(table.sparkSession))
    # the first run of a range may go on from the one before; any other head is the first of its kind
    kept = landed(numbered.where("not head or edge or run % (1L << 33) = 0"), folder, "repeats")
    heads = kept.where("head").join(F.broadcast(crossing(kept, ["digest"])), "run", "left_semi")
    return kept.where("not head and not edge").select("row", "chunk").union(heads.select("row", "chunk"))


def chunk_repeats(docs: DataFrame, least_run: int = LEAST_RUN, least: int = LEAST, most: int = MOST, bits: int = CUT_BITS) -> DataFrame:
    """Repeated passages of each document (``doc_id``, ``text``): a row for each row of ``docs``.

    Columns ``doc_id, n_bytes, n_chunks, n_repeated`` (repeated chunks), ``n_removed`` (bytes in runs of neighbouring
    repeated chunks of at least ``least_run`` bytes) and ``removed``, these runs as byte ranges for ``without``. A null text is empty
    and has no chunks. Rows equal in text, with one ``doc_id`` or several, repeat the first of them. No rows give no
    rows; further columns are not read.
    """
    folder = workspace(docs.sparkSession, "chunks")
    table = landed(chunk_table(docs, least, most, bits), folder, "table")
    marks = repeated_chunks(table, folder).groupBy("row").agg(F.sort_array(F.collect_list("chunk")).alias("chunks"))
    rows = table.select("row", "doc_id", "n_bytes", "lengths").join(marks, "row", "left")

    def join_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lengths, chunks in zip(batch.column("lengths"), batch.column("chunks")):
                ends = np.concatenate([[0], np.cumsum(lengths.values.to_numpy())])
                marked = chunks.values.to_numpy() if chunks.is_valid else np.zeros(0, np.int32)
                new = np.flatnonzero(np.diff(marked, prepend=-2) > 1)
                starts, stops = ends[marked[new]], ends[marked[np.append(new[1:], len(marked)) - 1] + 1] if len(marked) else ends[:0]
                long = stops - starts >= least_run
                spans = [{"start": int(x), "stop": int(y)} for x, y in zip(starts[long], stops[long])]
                out.append((len(ends) - 1, len(marked), int((stops - starts)[long].sum()), spans))
            columns = [pa.array([r[i] for r in out], pa.int64()) for i in range(3)]
            spans = pa.array([r[3] for r in out], pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), *columns, spans],
                ["doc_id", "n_bytes", "n_chunks", "n_repeated", "n_removed", "removed"],
            )

    schema = "doc_id long, n_bytes long, n_chunks long, n_repeated long, n_removed long, removed array<struct<start:long,stop:long>>"
    return rows.mapInArrow(join_runs, schema)


def without(text: str | None, removed: list) -> str:
    """A text without byte ranges. A character that a border runs through stays whole."""
    data, out, at = (text or "").encode(), [], 0
    for span in removed:
        start, stop = span["start"], span["stop"]
        while stop < len(data) and stop > start and data[stop] & 0xC0 == 0x80:  # the character goes on: back to its first byte
            stop -= 1
        while start < stop and data[start] & 0xC0 == 0x80:  # the character began before: on to the next one
            start += 1
        out.append(data[at:start])
        at = max(stop, start)
    return b"".join([*out, data[at:]]).decode()
