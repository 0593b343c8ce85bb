"""Two tokenizers side by side: which ids of one stand for which of the other, counted over a corpus.

A text is cut into groups wherever tokens of both end at one byte. Most groups hold one token of each, with the same bytes:
an array made beforehand names for every id of A the id of B with its bytes, and such groups are counted in a vector
as long as the vocabulary, one for each task. Only the other groups' id pairs are shuffled, a row for each pair and
slice of the corpus. Every slice is then sent the counts of its own pairs back, and meets there the pairs that each of its texts
holds, with how often, which is all that is kept of a text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.common import held, in_batches, landed, slices, workspace
from fieldspark.llm.tokens import TextTokenizer, entry_bytes

#: Text bytes of a slice.
SLICE_BYTES = 2 << 20
#: Links of a group up to which each is written out; larger groups are reduced to distinct ids first.
WRITTEN_LINKS = 256

PARTS_SCHEMA = (
    "kind string, slice long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "exact binary, exact_times binary, pairs binary, pairs_times binary, keys array<long>, docs array<long>"
)
_LINKS = ["exact", "exact_times", "pairs", "pairs_times"]
RESULT_SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


class Pair:
    """The two tokenizers, the bytes of their ids, and the identity map between them."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a, self.b = TextTokenizer(a_path, special=False), sentencepiece.SentencePieceProcessor(model_file=b_path)
        if self.a.kind != "bytes":
            raise ValueError(f"{a_path} is not a byte-level vocabulary")
        self.a_bytes = [b""] * (max(self.a.vocabulary.values()) + 1)
        for entry, i in self.a.vocabulary.items():
            self.a_bytes[i] = entry_bytes(entry)
        pieces = [(i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces]
        # of two ids of B with the same bytes the piece goes before the byte
        by_bytes = {p: i for i, p in enumerate(self.b_bytes) if self.b.is_byte(i)}
        by_bytes |= {p: i for i, p in enumerate(self.b_bytes) if not self.b.is_byte(i)}
        self.same = np.array([by_bytes.get(p, -1) for p in self.a_bytes], np.int64)
        self.width = len(self.b_bytes)
        self._flat = [_flat(self.a_bytes), _flat(self.b_bytes)]
        # decimal ids: of A before a comma, then before the bar; of B before a comma, then before the semicolon
        self._shown = [f"{i}{c}".encode() for n, ends in ((len(self.a_bytes), ",|"), (self.width, ",;")) for c in ends for i in range(n)]

    def encode(self, texts: list[str]) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """For A and B the ids of all texts, one after another, and how many each text has; none where the bytes differ."""
        a = [np.frombuffer(x, np.uint32) for x in self.a.encode([" " + t for t in texts])]
        b = [np.array(x, np.uint32) for x in self.b.encode(texts, num_threads=1)]
        sides = [(np.concatenate(x).astype(np.int64), np.array([len(i) for i in x], np.int64)) for x in (a, b)]
        wanted = np.frombuffer((" " + " ".join(texts)).encode(), np.uint8)
        sizes = np.array([len(t.encode()) + 1 for t in texts], np.int64)
        good = np.array([t != "" for t in texts])
        for (ids, n), flat in zip(sides, self._flat):
            good &= self._equal(ids, n, flat, wanted, sizes)
        return tuple((ids[np.repeat(good, n)], n * good) for ids, n in sides)

    def _equal(self, ids, n, flat, wanted, sizes) -> np.ndarray:
        """Whether each text's tokens, joined, are the text."""
        data, starts, lengths = flat
        own = lengths[ids]
        text = np.repeat(np.arange(len(n)), n)
        good = np.bincount(text, own, len(n)).astype(np.int64) == sizes
        if len(ids):
            good &= np.bincount(text, own == 0, len(n)) == 0
        keep = good[text]
        ids, own = ids[keep], own[keep]
        if len(ids):
            stops = np.cumsum(own)
            joined = data[np.arange(stops[-1]) + np.repeat(starts[ids] - (stops - own), own)]
            differ = joined != wanted[np.repeat(good, sizes)]
            good[np.repeat(np.arange(len(n)), sizes * good)[differ]] = False
        return good

    def align(self, a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> Aligned:
        return Aligned(self, *a, *b)

    def shown(self, aligned: Aligned) -> list[str]:
        """SHA-256 of each text's groups, ``a1,a2|b1;a3|b2,b3``; of a text without tokens an empty text."""
        al, a_size = aligned, len(self.a_bytes)
        out = np.empty(len(al.a) + len(al.b), np.int64)
        a_last = np.append(al.ga[1:] != al.ga[:-1], True) if len(al.a) else np.zeros(0, bool)
        b_last = np.append(al.gb[1:] != al.gb[:-1], True) if len(al.b) else np.zeros(0, bool)
        out[np.arange(len(al.a)) + al.b_first[al.ga]] = al.a + a_size * a_last
        out[np.arange(len(al.b)) + (al.a_first + al.na)[al.gb]] = 2 * a_size + al.b + self.width * b_last
        codes, bounds, shown = out.tolist(), np.concatenate([[0], np.cumsum(al.n_a + al.n_b)]).tolist(), self._shown.__getitem__
        return [hashlib.sha256(b"".join(map(shown, codes[i:j]))[:-1]).hexdigest() if j > i else "" for i, j in zip(bounds, bounds[1:])]


def _flat(entries: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.array([len(e) for e in entries], np.int64)
    return np.frombuffer(b"".join(entries), np.uint8), np.cumsum(lengths) - lengths, lengths


class Aligned:
    """Groups and links of some texts. ``a``, ``b``: ids; ``ga``, ``gb``: the group of each; ``na``, ``nb``: tokens of each group."""

    def __init__(self, pair: Pair, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray):
        self.pair, self.a, self.b, self.n_a, self.n_b, self.texts = pair, a, b, n_a, n_b, len(n_a)
        ends_a, ends_b = np.cumsum(pair._flat[0][2][a]), np.cumsum(pair._flat[1][2][b])
        mark = np.zeros((int(ends_a[-1]) if len(a) else 0) + 1, bool)
        mark[ends_a] = True
        common = ends_b[mark[ends_b]]
        self.ga, self.gb = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        self.na, self.nb = np.bincount(self.ga, minlength=len(common)), np.bincount(self.gb, minlength=len(common))
        self.a_first, self.b_first = np.cumsum(self.na) - self.na, np.cumsum(self.nb) - self.nb
        self.text = np.repeat(np.arange(self.texts), n_a)[self.a_first]
        one = (self.na == 1) & (self.nb == 1)
        one[one] = pair.same[a[self.a_first[one]]] == b[self.b_first[one]]
        #: Groups of one token each that the identity map names; the others.
        self.exact, self.irregular = np.flatnonzero(one), np.flatnonzero(~one)

    def counts(self) -> list[np.ndarray]:
        links = _sums(self.text, self.na * self.nb, self.texts)
        return [self.n_a, self.n_b, np.bincount(self.text, minlength=self.texts), links]

    def exact_ids(self) -> tuple[np.ndarray, np.ndarray]:
        """Of the exact groups the text and A's id."""
        return self.text[self.exact], self.a[self.a_first[self.exact]]

    def irregular_links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the links in the other groups the text, the pair ``a * width + b`` and how often; a pair may come repeatedly."""
        links = self.na * self.nb
        small = self.irregular[links[self.irregular] <= WRITTEN_LINKS]
        n = links[small]
        group = np.repeat(small, n)
        at = np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)
        keys = self.a[self.a_first[group] + at // self.nb[group]] * self.pair.width + self.b[self.b_first[group] + at % self.nb[group]]
        parts = [(self.text[group], keys, np.ones(len(keys), np.int64))]
        for g in self.irregular[links[self.irregular] > WRITTEN_LINKS].tolist():
            i, j = self.a_first[g], self.b_first[g]
            a, n_a = np.unique(self.a[i : i + self.na[g]], return_counts=True)
            b, n_b = np.unique(self.b[j : j + self.nb[g]], return_counts=True)
            keys = (a[:, None] * self.pair.width + b).ravel()
            parts.append((np.full(len(keys), self.text[g]), keys, (n_a[:, None] * n_b).ravel()))
        return tuple(np.concatenate(x) for x in zip(*parts))

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each text the distinct pairs of the map, as ``text * vocabulary + a``, and the others, as ``text * vocabulary * width + pair``,
        both in order and with how often they are linked. A pair of the map counts as such wherever it stands."""
        pair, size = self.pair, len(self.pair.a_bytes)
        text, ids = self.exact_ids()
        other, keys, times = self.irregular_links()
        mapped = pair.same[keys // pair.width] == keys % pair.width
        exact = np.concatenate([text * size + ids, other[mapped] * size + keys[mapped] // pair.width])
        exact = _counted(exact, np.concatenate([np.ones(len(ids), np.int64), times[mapped]]))
        return *exact, *_counted(other[~mapped] * (size * pair.width) + keys[~mapped], times[~mapped])


def _counted(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of their times."""
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(times, first) if len(first) else times


def _sums(text: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of whole numbers by text; the texts ascend."""
    total = np.concatenate([[0], np.cumsum(values)])
    bounds = np.searchsorted(text, np.arange(n + 1))
    return total[bounds[1:]] - total[bounds[:-1]]


def _pair(a_path: str, b_path: str) -> Pair:
    return held(("pair", a_path, b_path), lambda: Pair(a_path, b_path))


def _encoded(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Rows of ``PARTS_SCHEMA``: ``doc`` for each document, ``pairs`` for each slice, ``same`` for each task."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(a_path, b_path)
        vector = np.zeros(len(pair.a_bytes), np.int64)
        place = TaskContext.get().partitionId() << 32
        for batch in slices(batches, "text", SLICE_BYTES):
            a, b = pair.encode([t or "" for t in batch.column("text").to_pylist()])
            aligned = pair.align(a, b)
            exact, exact_times, keys, times = aligned.links()
            vector += np.bincount(exact % len(vector), minlength=len(vector))
            span = len(vector) * pair.width
            known, docs = np.unique(keys % span, return_counts=True)
            parts = _packed(exact // len(vector), exact % len(vector), exact_times, len(vector), batch.num_rows)
            parts += _packed(keys // span, np.searchsorted(known, keys % span), times, len(known), batch.num_rows)
            columns = [batch.column("doc_id").to_pylist(), *aligned.counts(), pair.shown(aligned), *parts]
            yield _parts("doc", place, batch.num_rows, dict(zip(["doc_id", *_COUNTS, "groups_sha256", *_LINKS], columns)))
            yield _parts("pairs", place, 1, {"keys": [known], "docs": [docs]})
            place += 1
        found = np.flatnonzero(vector)
        yield _parts("same", place, 1, {"keys": [found], "docs": [vector[found]]})

    return in_batches(docs.select(F.col("doc_id").cast("long"), "text"), encode, PARTS_SCHEMA, keeps=True)


def _parts(kind: str, place: int, rows: int, columns: dict) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    columns = {"kind": [kind] * rows, "slice": [place] * rows} | columns
    schema = [f.split() for f in PARTS_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(columns.get(n, [None] * rows), kinds[k]) for n, k in schema], [n for n, _ in schema])


@dataclass
class Alignment:
    """``documents``: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``, a row for each row.

    ``links``: ``a_id, b_id, documents, best``, a row for each id pair: in how many documents it is linked, and
    whether no other id of B is linked with that id of A in more.
    """

    documents: DataFrame
    links: DataFrame


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str) -> Alignment:
    """Align a byte-level vocabulary A (of the tokenizers library) with a sentencepiece vocabulary B on ``doc_id`` and ``text``.

    A encodes each text after a space, B the text itself, which it puts a space before; strings of special tokens are
    plain text. A null or empty text, and one whose joined A or B bytes are not that space and the text, has no tokens: zeros and an
    empty ``groups_sha256``. Two tokens are linked when their byte ranges share a group. ``n_best`` counts the links whose
    pair is ``best``, ``count_sum`` adds up ``documents`` over the links. Every row is a document of its own, whatever its
    ``doc_id``; no rows give no rows; further columns are not read. What is collected is as long as the vocabulary of A.
    """
    spark, folder = docs.sparkSession, workspace(docs.sparkSession, "alignment")
    parts = landed(_encoded(docs, a_path, b_path), folder, "parts")
    pair = Pair(a_path, b_path)
    vocabulary, width, same = len(pair.a_bytes), pair.width, pair.same
    counted = parts.select("kind", "slice", F.explode(F.arrays_zip("keys", "docs")).alias("x")).select("kind", "slice", "x.keys", "x.docs")
    pairs = counted.where("kind = 'pairs'")
    totals = pairs.groupBy("keys").agg(F.sum("docs").alias("n")).withColumn("a_id", F.expr(f"keys div {width}"))
    exact = landed(counted.where("kind = 'same'").groupBy(F.col("keys").alias("a_id")).agg(F.sum("docs").alias("n")), folder, "exact")
    totals = landed(totals, folder, "totals")
    best = totals.select("a_id", "n").union(exact).groupBy("a_id").agg(F.max("n").alias("most"))
    vectors = np.zeros((2, vocabulary), np.int64)
    for a, n, most in best.join(exact, "a_id", "left").select("a_id", "n", "most").collect():
        vectors[:, a] = n or 0, most
    totals = totals.join(best, "a_id").select("keys", "a_id", "n", (F.col("n") == F.col("most")).alias("best"))
    totals = landed(totals, folder, "named")
    back = pairs.select(F.col("slice").alias("of"), "keys").join(totals.select("keys", "n", "best"), "keys")
    links = totals.select("a_id", F.expr(f"keys % {width}").alias("b_id"), F.col("n").alias("documents"), "best")
    mapped = [(a, int(same[a]), int(vectors[0, a]), bool(vectors[0, a] == vectors[1, a])) for a in np.flatnonzero(vectors[0]).tolist()]
    links = links.union(spark.createDataFrame(mapped, "a_id long, b_id long, documents long, best boolean"))

    def score(own: pa.Table, theirs: pa.Table) -> pa.Table:
        order = np.argsort(theirs.column("keys").to_numpy())
        n, best = (theirs.column(c).to_numpy()[order].astype(np.int64) for c in ("n", "best"))
        n_best, count_sum = np.zeros((2, own.num_rows), np.int64)
        for name, count, good in (("exact", vectors[0], (vectors[0] == vectors[1]).astype(np.int64)), ("pairs", n, best)):
            text, ids, times = _unpacked(own.column(name), own.column(f"{name}_times"), len(count))
            n_best += _sums(text, good[ids] * times, own.num_rows)
            count_sum += _sums(text, count[ids] * times, own.num_rows)
        columns = [own.column(c) for c in ("doc_id", *_COUNTS)] + [pa.array(n_best), pa.array(count_sum), own.column("groups_sha256")]
        return pa.table(columns, names=[f.split()[0] for f in RESULT_SCHEMA.split(", ")])

    own = parts.where("kind = 'doc'").select("slice", "doc_id", *_COUNTS, "groups_sha256", *_LINKS)
    return Alignment(own.groupBy("slice").cogroup(back.groupBy("of")).applyInArrow(score, RESULT_SCHEMA), links)


def _kind(most: int) -> type:
    """The narrowest of a few number types for values below ``most``."""
    return next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if most <= np.iinfo(k).max + 1)


def _packed(text: np.ndarray, ids: np.ndarray, times: np.ndarray, most: int, n: int) -> list[list[bytes]]:
    """For each text its ids, and how often it has each, as bytes; the texts ascend, ids are below ``most``."""
    cuts = np.searchsorted(text, np.arange(1, n))
    return [[x.tobytes() for x in np.split(ids.astype(_kind(most)), cuts)], [x.astype(_kind(int(x.max(initial=0)) + 1)).tobytes() for x in np.split(times, cuts)]]


def _unpacked(ids: pa.ChunkedArray, times: pa.ChunkedArray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The inverse of ``_packed``: texts, ids and how often."""
    lists = [np.frombuffer(x, _kind(most)) for x in ids.to_pylist()]
    sizes = np.array([len(x) for x in lists], np.int64)
    often = [np.frombuffer(t, f"u{len(t) // n}") if n else np.zeros(0, np.uint8) for t, n in zip(times.to_pylist(), sizes.tolist())]
    return np.repeat(np.arange(len(lists)), sizes), np.concatenate(lists).astype(np.int64), np.concatenate(often).astype(np.int64)
