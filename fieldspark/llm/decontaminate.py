"""Benchmark decontamination by a distributed positional inverted index.

The training documents are indexed in segments: a segment holds, for each benchmark term, the sorted positions at which
it stands. A phrase is looked up from its rarest term on: the positions of the next rarest are shifted by the
difference of their offsets and intersected, until nothing or the phrase is left. Segments are looked up side by
side, so no posting list of the whole corpus ever meets in one place.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.common import RowBits, in_batches, landed, numbered_rows, slices, workspace

#: Words of benchmark items that are looked up in one pass, which bounds what each task is sent.
BLOCK_WORDS = 500_000

#: Text bytes of a segment: a look-up visits each segment once, so they are large.
SEGMENT_BYTES = 4 << 20

INDEX_SCHEMA = "segment long, doc_ids array<long>, starts array<int>, terms array<int>, bounds array<int>, positions array<int>"
MATCH_SCHEMA = (
    "segment long, ordinal int, doc_id long, n_words long, spans array<struct<start:int,stop:int>>, items array<string>, near array<string>"
)
_KEEP = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(128, 256))
#: Lower-cases A-Z and puts a space for every byte that belongs to no word.
WORD_BYTES = bytes(c if c in _KEEP else 32 for c in (b + 32 if 65 <= b <= 90 else b for b in range(256)))


def words(text: str | None) -> list[bytes]:
    """Runs of digits, letters and all characters outside ASCII, A-Z in lower case. Null has none."""
    return text.encode().translate(WORD_BYTES).split() if text else []


class Phrases:
    """The distinct windows of some items: consecutive words, or a whole item that is shorter than a window."""

    def __init__(self, items: list[tuple[str, list[bytes]]], width: int):
        self.terms: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for item, text in items:
            ids = [self.terms.setdefault(w, len(self.terms) + 1) for w in text]
            for i in range(max(1, len(ids) - width + 1) if ids else 0):
                owners[tuple(ids[i : i + width])].add(item)
        self.windows = [(w, sorted(o)) for w, o in owners.items()]


def build_index(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """A row for each segment: its documents, where each starts, and the positions of each term in it.

    A place is left free after each document, so that no phrase runs from one into the next.
    """

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = 0, 0
        for batch in slices(batches, "text", SEGMENT_BYTES):
            part = int(batch.column("__part")[0].as_py()) << 32
            ids, starts, at = [], [], 0
            for text in batch.column("text").to_pylist():
                own = words(text)
                starts.append(at)
                ids.append(np.fromiter(map(terms.get, own, repeat(0)), np.int32, len(own)))
                ids.append(np.zeros(1, np.int32))
                at += len(own) + 1
            starts.append(at)
            ids = np.concatenate(ids)
            places = np.flatnonzero(ids)
            places = places[np.argsort(ids[places], kind="stable")].astype(np.int32)
            known, first = np.unique(ids[places], return_index=True)
            bounds = np.append(first, len(places)).astype(np.int32)
            row = [part + count, batch.column("doc_id").to_pylist(), np.array(starts, np.int32), known, bounds, places]
            kinds = [pa.int64(), *(pa.list_(t) for t in (pa.int64(), *(pa.int32(),) * 4))]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], [f.split()[0] for f in INDEX_SCHEMA.split(", ")])
            count += 1

    rows = docs.select(F.col("doc_id").cast("long"), "text").withColumn("__part", F.spark_partition_id())
    return in_batches(rows, index, INDEX_SCHEMA)


def term_counts(index: DataFrame) -> DataFrame:
    """How often each term stands in the corpus; a row for each term of the phrases at most."""
    sizes = F.transform("terms", lambda t, i: F.struct(t.alias("term"), (F.get("bounds", i + 1) - F.get("bounds", i)).alias("n")))
    return index.select(F.explode(sizes).alias("t")).groupBy("t.term").agg(F.sum("t.n").alias("n"))


def exact_starts(postings: dict[int, np.ndarray], window: list[tuple[int, int]]) -> np.ndarray:
    """Where a phrase starts: offset-adjusted lists intersected, rarest term first."""
    term, offset = window[0]
    found = postings[term] - offset
    for term, offset in window[1:]:
        found = found[_among(found + offset, postings[term])]
        if not len(found):
            break
    return found


def near_places(postings: dict[int, np.ndarray], window: list[tuple[int, int]], within: int, starts: np.ndarray) -> np.ndarray:
    """Positions of the rarest term with every other term of the phrase at most ``within`` words away in the same document."""
    found = postings[window[0][0]]
    for term, _ in window[1:]:
        doc = np.searchsorted(starts, found, "right")
        other = postings[term]
        at = np.searchsorted(other, np.maximum(found - within, starts[doc - 1]))
        ok = at < len(other)
        ok[ok] = other[at[ok]] <= np.minimum(found[ok] + within, starts[doc[ok]] - 1)
        found = found[ok]
        if not len(found):
            break
    return found


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    at = np.searchsorted(ordered, values)
    ok = at < len(ordered)
    ok[ok] = ordered[at[ok]] == values[ok]
    return ok


def find_matches(index: DataFrame, phrases: list[tuple[list[tuple[int, int]], list[str]]], slop: int) -> DataFrame:
    """A row for each document: the word spans covered by phrases, the items they come from, and the items near them.

    ``phrases`` are windows as (term, offset), rarest term first, with their items. An item is near if all words of one of its
    windows stand within the window's length and ``slop`` words around its rarest one, in any order.
    """

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield _look_up(*(batch.column(i)[row] for i in range(6)))

    def _look_up(segment, doc_ids, starts, terms, bounds, positions) -> pa.RecordBatch:
        starts, bounds, positions = (a.values.to_numpy() for a in (starts, bounds, positions))
        postings = {t: positions[bounds[i] : bounds[i + 1]] for i, t in enumerate(terms.as_py())}
        cover = np.zeros(int(starts[-1]) + 1, np.int32)
        n = len(starts) - 1
        items: list[set[str]] = [set() for _ in range(n)]
        near: list[set[str]] = [set() for _ in range(n)]
        for window, owners in phrases:
            if not all(t in postings for t, _ in window):
                continue
            places = near_places(postings, window, len(window) - 1 + slop, starts)
            if not len(places):
                continue
            for doc in np.unique(np.searchsorted(starts, places, "right") - 1):
                near[doc].update(owners)
            found = exact_starts(postings, window)
            if len(found):
                np.add.at(cover, found, 1)
                np.add.at(cover, found + len(window), -1)
                for doc in np.unique(np.searchsorted(starts, found, "right") - 1):
                    items[doc].update(owners)
        edge = np.diff(np.concatenate([[0], (np.cumsum(cover) > 0).astype(np.int8)]))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        owner = np.searchsorted(starts, first, "right") - 1
        spans: list[list[dict]] = [[] for _ in range(n)]
        for doc, a, b in zip(owner, first, last):
            spans[doc].append({"start": int(a - starts[doc]), "stop": int(b - starts[doc])})
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])), pa.list_(pa.string()), pa.list_(pa.string())]
        columns = [[segment.as_py()] * n, range(n), doc_ids.as_py(), np.diff(starts) - 1, spans, [sorted(i) for i in items], [sorted(i) for i in near]]
        names = ["segment", "ordinal", "doc_id", "n_words", "spans", "items", "near"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return in_batches(index, look_up, MATCH_SCHEMA)


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, width: int = 10, slop: int = 5, block_words: int = BLOCK_WORDS) -> DataFrame:
    """What of the benchmark stands in each document (``doc_id``, ``text``): a row for each row of ``docs``.

    Columns ``doc_id, n_words, spans`` (disjoint word ranges covered by windows of ``width`` words), ``items`` (sorted ids, as
    text, of the items with an exact match) and ``near`` (items with a proximity match; exact ones are among them). An item
    shorter than a window is one window; an item without words, or with a null id, matches nothing. Null texts have no
    words. Repeated ids and texts keep their rows. A benchmark of more than ``block_words`` words is looked up in
    blocks of items, one pass over the documents for each, and the passes are put together by document.
    """
    spark = docs.sparkSession
    folder = workspace(spark, "decontaminate")
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("string"), "text")
    total = items.agg(F.coalesce(F.sum(F.size(F.split("text", r"[^0-9A-Za-z\x{80}-\x{10FFFF}]+"))), F.lit(0))).first()[0]
    blocks = max(1, -(-int(total) // block_words))
    passes = []
    for block in range(blocks):
        chosen = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        phrases = Phrases([(r.item_id, words(r.text)) for r in chosen.toLocalIterator()], width)
        index = landed(build_index(docs, phrases.terms), folder, f"index{block}")
        counts = {r.term: r.n for r in term_counts(index).toLocalIterator()}
        ordered = [
            (sorted(((t, i) for i, t in enumerate(window)), key=lambda x: counts[x[0]]), owners)
            for window, owners in phrases.windows
            if all(t in counts for t in window)
        ]
        passes.append(find_matches(index, ordered, slop))
    if blocks == 1:
        return passes[0].drop("segment", "ordinal")
    whole = passes[0]
    for other in passes[1:]:
        whole = whole.unionByName(other)
    # at most one row from each pass for a document
    lists = [F.array_sort(F.flatten(F.collect_list(c))).alias(c) for c in ("spans", "items", "near")]
    merged = whole.groupBy("segment", "ordinal").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), *lists)
    return merged.drop("segment", "ordinal")


def covered_words(spans: str = "spans"):
    """Words in the union of sorted spans, which may overlap."""
    state = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto"))
    return F.aggregate(
        spans, state,
        lambda s, x: F.struct(
            (s["n"] + F.greatest(F.lit(0), x["stop"] - F.greatest(x["start"], s["upto"]))).cast("long").alias("n"),
            F.greatest(s["upto"], x["stop"]).alias("upto"),
        ),
        lambda s: s["n"],
    )


def contamination(matches: DataFrame) -> DataFrame:
    """Counts and digests of what ``benchmark_matches`` found."""
    return matches.select(
        "doc_id", "n_words", covered_words().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), F.size("near").cast("long").alias("n_near_items"),
    ).withColumn("contaminated", F.col("n_hit") > 0)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """The rows of ``docs``, all columns, in which no window of the benchmark stands; each row is decided on by its own text."""
    folder = workspace(docs.sparkSession, "decontaminate")
    rows, _ = numbered_rows(docs, folder)
    matches = benchmark_matches(rows.select(F.col("row").alias("doc_id"), "it.text"), benchmark, width)
    hit = landed(matches.where(F.size("spans") > 0).select(F.col("doc_id").alias("row")), folder, "hit")
    return RowBits(hit, folder, "hit_mask").drop(rows).select("it.*")
