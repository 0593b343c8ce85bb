"""Substring deduplication over sampled suffixes, sorted deep and shallow.

A string of ``LENGTH`` bytes always holds, among its first places, one whose next ``GRAM`` bytes hash lowest: its anchor, the
same wherever the string stands. The anchors (about one byte in 35) cut the suffix array of the corpus in buckets of suffixes
that can be equal at all. An anchor's own stretch of text, from the first to the end of the last string that it is the anchor
of, is compared first as a whole; only stretches of one bucket that differ are sorted suffix by suffix: a multikey
quicksort on words of 8 bytes down to a shallow depth, then a blind trie for groups with a long common prefix.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.common import landed, partitions_for, slices, text_bytes, workspace
from fieldspark.llm.hashing import mix, running_sums, salt, span_hash

LENGTH, GRAM = 100, 32
#: 8-byte words that the multikey quicksort looks at.
SHALLOW_WORDS = 4
#: Stretches of one bucket that one task sorts; the strings of larger buckets are dealt out one by one.
BUCKET = 4096
#: Text bytes that are cut in stretches at a time.
PIECE = 1 << 18
#: Stretches sorted at a time.
SORTED_AT_ONCE = 4096


def ordered_rows(docs: DataFrame) -> DataFrame:
    """``row, doc_id, text`` with rows numbered in order of ``doc_id`` (null first; equal ones by their text).

    Unique identifiers are their own numbers. Otherwise the rows are sorted in ranges and numbered range by range.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    total, distinct = rows.agg(F.count("*"), F.countDistinct("doc_id")).first()
    if total == distinct:
        return rows.select(F.col("doc_id").alias("row"), "doc_id", "text")
    folder = workspace(docs.sparkSession, "rows")
    placed = rows.repartitionByRange(partitions_for(docs.sparkSession), "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    placed = landed(placed.withColumn("__at", F.monotonically_increasing_id()), folder, "rows")
    return placed.select(F.col("__at").alias("row"), "doc_id", "text")


def stretches(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Anchors of some texts: place, first and last start of the strings that they are the anchor of, and two hashes.

    The first hash is of the anchor's own bytes, the second of its whole stretch and its place in it.
    """
    n = len(data) - length + 1
    starts = np.ones(max(n, 0), bool)
    for end in ends[1:]:  # strings do not run over the end of a text
        starts[max(0, end - length + 1) : end] = False
    if not starts.any():
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    sums = running_sums(data)
    at = np.arange(len(data) - gram + 1)
    hashes = span_hash(sums, at, at + gram)
    # the place of the lowest hash in each window; of equal ones the first
    width, reach, place = length - gram + 1, 1, at.astype(np.int32)

    def lower(apart: int) -> tuple[np.ndarray, np.ndarray]:
        later = lowest[apart:] < lowest[:-apart]
        return np.where(later, lowest[apart:], lowest[:-apart]), np.where(later, place[apart:], place[:-apart])

    lowest = hashes
    while reach * 2 <= width:
        lowest, place = lower(reach)
        reach *= 2
    if width > reach:
        lowest, place = lower(width - reach)
    anchor = place[:n].astype(np.int64)
    text = np.searchsorted(ends, np.arange(n), "right")
    new = starts.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~starts[:-1] | (text[1:] != text[:-1])
    last = starts.copy()
    last[:-1] &= new[1:] | ~starts[1:]
    first, final = np.flatnonzero(new), np.flatnonzero(last)
    place = anchor[first]
    whole = span_hash(sums, first, final + length)
    return place, first, final, hashes[place], mix(whole + (place - first).astype(np.uint64) * salt(3) + (final - first).astype(np.uint64) * salt(4))


def stretch_table(rows: DataFrame) -> DataFrame:
    """Rows ``bucket, whole, row, start, last``: an anchor's hash, its stretch's hash, and where its strings start."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PIECE):
            data, ends = text_bytes(batch.column("text"))
            # a long text comes alone, and is cut piece by piece: strings that start in one end in the next
            for offset in range(0, len(data), PIECE) if batch.num_rows == 1 else (0,):
                part, bounds = (data[offset : offset + PIECE + LENGTH - 1], None) if batch.num_rows == 1 else (data, ends)
                bounds = np.array([0, len(part)]) if bounds is None else bounds
                _, first, final, bucket, whole = stretches(part, bounds)
                text = np.searchsorted(bounds, first, "right") - 1
                row = batch.column("row").to_numpy()[text]
                shift = offset - bounds[text]
                columns = [bucket.view(np.int64), whole.view(np.int64), row, (first + shift).astype(np.int32), (final + shift).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["bucket", "whole", "row", "start", "last"])

    return rows.select("row", "text").mapInArrow(cut, "bucket long, whole long, row long, start int, last int")


def compare_whole(table: DataFrame, partitions: int) -> DataFrame:
    """Stretches equal to an earlier one as a whole (``again``), and the first of each kind in buckets that hold several.

    Buckets lie in sorted ranges, and one with many stretches in several ranges. A stretch at the border of a batch or range is
    passed on as a first one, whose equals ``sort_buckets`` then finds.
    """
    dealt = table.repartitionByRange(partitions, "bucket", "whole", "row", "start").sortWithinPartitions("bucket", "whole", "row", "start")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            bucket, whole = batch.column("bucket").to_numpy(), batch.column("whole").to_numpy()
            other = np.ones(n, bool)
            other[1:] = bucket[1:] != bucket[:-1]
            kind = other.copy()
            kind[1:] |= whole[1:] != whole[:-1]
            kind[0] = (bucket[0], whole[0]) != before
            before = (bucket[-1], whole[-1])
            number = np.cumsum(other) - 1
            several = np.bincount(number, kind) > 1
            several[[0, -1]] = True
            passed = ~kind | several[number]
            out = batch.filter(pa.array(passed))
            yield pa.RecordBatch.from_arrays(
                [*(out.column(c) for c in ("bucket", "row", "start", "last")), pa.array(~kind[passed])], ["bucket", "row", "start", "last", "again"]
            )

    return dealt.mapInArrow(compare, "bucket long, row long, start int, last int, again boolean")


def multikey_sort(words: np.ndarray, places: np.ndarray, group: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order suffixes by bucket and then word by word; suffixes alone in their group drop out.

    ``words[p]`` holds the 8 bytes from p on. Returns numbers of the suffixes still tied after ``depth`` words, in order, and their
    groups.
    """
    left = np.arange(len(places))
    for word in range(depth):
        value = words[places[left] + 8 * word]
        order = np.lexsort((value, group))
        left, group, value = left[order], group[order], value[order]
        new = np.ones(len(left), bool)
        new[1:] = (group[1:] != group[:-1]) | (value[1:] != value[:-1])
        group = np.cumsum(new) - 1
        tied = np.bincount(group, minlength=1)[group] > 1 if len(left) else np.zeros(0, bool)
        left, group = left[tied], group[tied]
    return left, group


class BlindTrie:
    """Orders strings of one length, looking at single bytes on the way down and at one whole string at the end."""

    def __init__(self):
        self.root = None

    def add(self, text: bytes, item: int) -> None:
        if self.root is None:
            self.root = (None, text, [item])
            return
        node = self.root
        while node[0] is not None:  # blindly: bytes between branches are not compared
            node = node[1].get(text[node[0]]) or next(iter(node[1].values()))
        known = node[1]
        if known == text:
            node[2].append(item)
            return
        at = next(i for i, (a, b) in enumerate(zip(known, text)) if a != b)
        parent, node = None, self.root
        while node[0] is not None and node[0] < at:
            parent, node = (node, text[node[0]]), node[1][text[node[0]]]
        leaf = (None, text, [item])
        if node[0] == at:
            node[1][text[at]] = leaf
            return
        branch = (at, {known[at]: node, text[at]: leaf})
        if parent is None:
            self.root = branch
        else:
            parent[0][1][parent[1]] = branch

    def leaves(self) -> Iterator[list[int]]:
        """Items in the order of their strings, equal ones together."""
        stack = [self.root] if self.root else []
        while stack:
            node = stack.pop()
            if node[0] is None:
                yield node[2]
            else:
                stack.extend(node[1][c] for c in sorted(node[1], reverse=True))


def equal_strings(data: np.ndarray, places: np.ndarray, group: np.ndarray, length: int = LENGTH, depth: int = SHALLOW_WORDS) -> Iterator[np.ndarray]:
    """Numbers of places from which the next ``length`` bytes are equal and whose group is the same, two or more at a time."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    words = np.zeros(len(data), np.uint64)
    for i in range(8):
        words = words << np.uint64(8) | padded[i : i + len(data)]
    left, tied = multikey_sort(words, places, group, min(depth, length // 8))
    if not len(left):
        return
    firsts = np.flatnonzero(np.diff(tied, prepend=-1))
    head = places[left[firsts]][np.cumsum(np.diff(tied, prepend=-1) != 0) - 1]
    differs = np.zeros(len(left), bool)
    for i in [*range(8 * depth, length - 7, 8), length - 8]:
        differs |= words[places[left] + i] != words[head + i]
    mixed = np.logical_or.reduceat(differs, firsts)
    for a, b, deep in zip(firsts.tolist(), [*firsts[1:].tolist(), len(left)], mixed.tolist()):
        if not deep:
            yield left[a:b]
            continue
        trie = BlindTrie()
        for item in left[a:b].tolist():
            p = int(places[item])
            trie.add(data[p : p + length].tobytes(), item)
        for items in trie.leaves():
            if len(items) > 1:
                yield np.array(items)


def stretch_bytes(firsts: DataFrame, rows: DataFrame) -> DataFrame:
    """The bytes of stretches: ``bucket, row, start, last, large, bytes``."""
    wanted = firsts.groupBy("row").agg(F.collect_list(F.struct("bucket", "start", "last", "large")).alias("wanted"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text, wanted in zip(batch.column("row").to_pylist(), batch.column("text"), batch.column("wanted")):
                part, data = wanted.values, text.as_py().encode()
                starts, lasts = part.field("start"), part.field("last")
                own = [data[a : b + LENGTH] for a, b in zip(starts.to_pylist(), lasts.to_pylist())]
                columns = [part.field("bucket"), pa.array([row] * len(part), pa.int64()), starts, lasts, part.field("large"), pa.array(own, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "row", "start", "last", "large", "bytes"])

    joined = rows.select("row", "text").join(wanted.hint("shuffle_hash"), "row")
    return joined.mapInArrow(fetch, "bucket long, row long, start int, last int, large boolean, bytes binary")


def sort_buckets(firsts: DataFrame) -> DataFrame:
    """Runs of strings that also start earlier, ``row, start, last``, from the first stretches of each kind in a bucket."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= SORTED_AT_ONCE:
                table = pa.Table.from_batches(held).combine_chunks()
                bucket = table.column("bucket").to_numpy()
                # whole buckets: all but the last, which may go on
                whole = int(np.searchsorted(bucket, bucket[-1]))
                if whole:
                    yield _find(table.slice(0, whole))
                held = table.slice(whole).to_batches()
        if held:
            yield _find(pa.Table.from_batches(held))

    ordered = firsts.repartition(partitions_for(firsts.sparkSession), "bucket").sortWithinPartitions("bucket", "row", "start")
    return ordered.mapInArrow(find, "row long, start int, last int")


def _find(table: pa.Table) -> pa.RecordBatch:
    data, ends = text_bytes(table.column("bytes").combine_chunks())
    start, last = table.column("start").to_numpy().astype(np.int64), table.column("last").to_numpy().astype(np.int64)
    bucket = table.column("bucket").to_numpy()
    counts = last - start + 1
    owner = np.repeat(np.arange(len(start)), counts)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    group = np.cumsum(np.diff(bucket, prepend=bucket[:1]) != 0)[owner]
    again = np.zeros(len(owner), bool)
    for same in equal_strings(data, ends[owner] + inner, group):
        again[same] = True
        again[same.min()] = False  # rows come in order of bucket, row and start
    return _runs(table.column("row").to_numpy(), start, owner, inner, again)


def _runs(row, start, owner, inner, again) -> pa.RecordBatch:
    new, end = again.copy(), again.copy()
    new[1:] &= ~again[:-1] | (owner[1:] != owner[:-1])
    end[:-1] &= ~again[1:] | (owner[1:] != owner[:-1])
    a, b = np.flatnonzero(new), np.flatnonzero(end)
    columns = [row[owner[a]], (start[owner[a]] + inner[a]).astype(np.int32), (start[owner[b]] + inner[b]).astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["row", "start", "last"])


def deal_strings(firsts: DataFrame) -> DataFrame:
    """As ``sort_buckets`` for large buckets: each string by its own digest, so that no bucket lies in one task."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, start, last, data in zip(*(batch.column(c).to_pylist() for c in ("row", "start", "last", "bytes"))):
                own = [sha256(data[i : i + LENGTH]).digest()[:16] for i in range(last - start + 1)]
                columns = [pa.array(own, pa.binary()), pa.array([row] * len(own), pa.int64()), pa.array(np.arange(start, last + 1, dtype=np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["digest", "row", "start"])

    strings = firsts.mapInArrow(explode, "digest binary, row long, start int")
    earliest = strings.groupBy("digest").agg(F.min(F.struct("row", "start")).alias("first"))
    later = strings.join(earliest, "digest").where(F.struct("row", "start") != F.col("first"))
    return later.select("row", "start", F.col("start").alias("last"))


def merged_runs(found: DataFrame, partitions: int) -> DataFrame:
    """Maximal runs of covered bytes, ``row, start, stop``, from ``row, start, last`` of repeated strings, which may overlap.

    The strings of a text stream by in order, so a text that repeats itself a million times needs no list of them.
    """
    dealt = found.repartition(partitions, "row").sortWithinPartitions("row", "start")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            row, start, stop = (batch.column(c).to_numpy().astype(np.int64) for c in ("row", "start", "last"))
            stop = stop + LENGTH
            if open_ is not None:
                row, start, stop = (np.append(a, b) for a, b in zip(open_, (row, start, stop)))
            turn = np.append(False, row[1:] != row[:-1])
            rank = np.cumsum(turn) << 40
            reach = np.maximum.accumulate(rank + stop)
            new = np.append(True, (rank + start)[1:] > reach[:-1]) | turn
            at = np.flatnonzero(new)
            stops = reach[np.append(at[1:], len(row)) - 1] - rank[at]
            open_ = row[at[-1:]], start[at[-1:]], stops[-1:]
            yield _merged(row[at[:-1]], start[at[:-1]], stops[:-1])
        if open_ is not None:
            yield _merged(*open_)

    return dealt.mapInArrow(merge, "row long, start long, stop long")


def _merged(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["row", "start", "stop"])


def substring_dedup(docs: DataFrame) -> DataFrame:
    """Bytes that belong to a string of 100 bytes which also starts earlier (``doc_id``, ``text``): a row for each row.

    Columns ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and ``removed``, the byte ranges. Earlier is a smaller ``doc_id``, or
    an earlier start in the same text; strings do not cross texts, may overlap, and are judged on the input. A null text is
    empty, and texts of fewer than 100 bytes lose nothing. Rows with one ``doc_id`` count in order of their text's hash, a null
    ``doc_id`` before all others. No rows give no rows; further columns are not read.
    """
    spark = docs.sparkSession
    folder, n = workspace(spark, "suffixes"), partitions_for(spark)
    rows = ordered_rows(docs)
    compared = landed(compare_whole(stretch_table(rows), n), folder, "compared")
    firsts = compared.where("not again")
    large = landed(firsts.groupBy("bucket").count().where(F.col("count") > BUCKET).select("bucket", F.lit(True).alias("large")), folder, "large")
    marked = firsts.join(large, "bucket", "left").withColumn("large", F.coalesce("large", F.lit(False)))
    fetched = landed(stretch_bytes(marked, rows), folder, "bytes")
    found = sort_buckets(fetched.where("not large")).union(deal_strings(fetched.where("large")))
    found = landed(found.union(compared.where("again").select("row", "start", "last")), folder, "found")
    runs = merged_runs(found, n).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("runs"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, runs in zip(batch.column("text"), batch.column("runs")):
                data = text.as_py().encode()
                spans = list(zip(runs.values.field("start").to_pylist(), runs.values.field("stop").to_pylist())) if runs.is_valid else []
                kept, at = [], 0
                for a, b in spans:
                    kept.append(data[at:a])
                    at = b
                kept.append(data[at:])
                digest = sha256(b"".join(kept)).hexdigest()
                out.append((len(data), sum(b - a for a, b in spans), len(spans), digest, [{"start": a, "stop": b} for a, b in spans]))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))]
            columns = [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<start:long,stop:long>>"
    return rows.join(runs.hint("shuffle_hash"), "row", "left").select("doc_id", "text", "runs").mapInArrow(remove, schema)
