"""Language identification by prediction by partial matching.

For each language a context tree over bytes counts what follows the last 0 to 3 bytes. The chance of a byte is that of
the longest context seen in training, with an escape to the next shorter one for bytes it has not met (method C: a
context with n bytes seen and d different ones escapes with d / (n + d)). The statistics are frozen, so the code length of every
byte after every context is worked out once and whole texts are scored by table look-ups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldspark.llm.common import held, in_batches, quoted, slices, text_bytes

#: Longest context in bytes.
ORDER = 3
#: Training sample: about this many documents of each language, whole texts.
SAMPLE_DOCS = 400

#: Contexts whose code lengths are worked out at a time.
CONTEXTS_AT_ONCE = 2048

COUNT_SCHEMA = "lang string, size int, context long, next int, n long"


def training_sample(labelled: DataFrame, docs_per_language: int = SAMPLE_DOCS) -> DataFrame:
    """Rows ``text, lang`` chosen by a hash of ``doc_id``, so that each language has about as many, its whole share if it has fewer."""
    labelled = labelled.select("doc_id", "text", "lang").where("lang is not null and text is not null")
    totals = labelled.groupBy("lang").agg(F.count("*").alias("total"))
    chance = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 40)) / float(1 << 40)
    # one row for each language
    return labelled.join(F.broadcast(totals), "lang").where(chance * F.col("total") < docs_per_language).select("text", "lang")


def context_counts(sample: DataFrame, order: int = ORDER) -> DataFrame:
    """How often each byte follows each context of 0 to ``order`` bytes, by language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, ends = text_bytes(batch.column("text"))
            langs = np.array(batch.column("lang").to_pylist())
            for lang in np.unique(langs):
                parts = [data[ends[i] : ends[i + 1]].astype(np.int64) for i in np.flatnonzero(langs == lang)]
                for size in range(order + 1):
                    keys = []
                    for p in parts:
                        key = np.zeros(max(0, len(p) - size), np.int64)
                        for back in range(size + 1):
                            key = key << 8 | p[back : back + len(key)]
                        keys.append(key)
                    found, n = np.unique(np.concatenate(keys), return_counts=True)
                    m = len(found)
                    columns = [pa.array([lang] * m, pa.string()), pa.array(np.full(m, size, np.int32)), pa.array(found >> 8), pa.array((found & 255).astype(np.int32)), pa.array(n.astype(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "size", "context", "next", "n"])

    counted = in_batches(sample.select("text", "lang"), count, COUNT_SCHEMA)
    return counted.groupBy("lang", "size", "context", "next").agg(F.sum("n").alias("n"))


class ContextTrees:
    """The frozen trees of all languages as one table: bits of a byte after a context, for each language.

    Bytes that training never met share one symbol, which costs an escape from every context and then one of 256.
    A context that no language met is looked up by its longest known end.
    """

    def __init__(self, langs: list[str], counts: list[np.ndarray], order: int = ORDER):
        """``counts``: columns lang number, size, context, next, n."""
        lang, size, context, after, n = counts
        self.langs, self.order = langs, order
        seen = np.unique(after)
        self.symbols = np.zeros(256, np.int32)
        self.symbols[seen] = np.arange(1, len(seen) + 1)
        #: symbols of a text: 0 for bytes never met, the last for places before its start
        self.width = width = len(seen) + 2
        self.nodes = np.zeros(width**order, np.int32)
        levels = [np.unique(context[size == k]) if k else np.zeros(1, np.int64) for k in range(order + 1)]
        self.bits = np.empty((sum(map(len, levels)), width, len(langs)), np.float32)
        base = np.full((1, width, len(langs)), 8.0, np.float32)
        parents: dict[tuple, int] = {}
        first = 0
        for k, contexts in enumerate(levels):
            of = size == k
            where = np.searchsorted(contexts, context[of])
            own = np.argsort(where, kind="stable")
            cells = [a[of][own] for a in (self.symbols[after], lang, n)]
            where = where[own]
            symbols = np.array([[self.symbols[c >> 8 * (k - 1 - i) & 255] for i in range(k)] for c in contexts.tolist()], np.int64).reshape(len(contexts), k)
            # the shorter context without the oldest byte; every end of a seen context is seen
            shorter = np.array([parents[tuple(s[1:])] for s in symbols.tolist()], np.int64) if k else None
            for start in range(0, len(contexts), CONTEXTS_AT_ONCE):
                stop = min(start + CONTEXTS_AT_ONCE, len(contexts))
                a, b = np.searchsorted(where, [start, stop])
                table = np.zeros((stop - start, width, len(langs)), np.float32)
                table[where[a:b] - start, cells[0][a:b], cells[1][a:b]] = cells[2][a:b]
                self.bits[first + start : first + stop] = _bits(table, self.bits[shorter[start:stop]] if k else base)
            parents = {tuple(s): first + i for i, s in enumerate(symbols.tolist())}
            self._place(symbols, first, k)
            first += len(contexts)

    def _place(self, symbols: np.ndarray, first: int, k: int) -> None:
        """Point every full context that ends with one of these at it; longer known ends come later and win."""
        shape = self.nodes.reshape((self.width,) * self.order)
        if k == 0:
            shape[...] = first
        for i, s in enumerate(symbols.tolist() if k else []):
            shape[(Ellipsis, *s)] = first + i

    def code_lengths(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Bits of each text (bytes ``ends[i]`` to ``ends[i + 1]``) under each language."""
        n = len(ends) - 1
        out = np.zeros((n, len(self.langs)))
        if not len(data):
            return out
        own = self.symbols[data]
        before, start = np.zeros(len(data), np.int64), ends[:-1]
        for back in range(self.order, 0, -1):
            past = np.full(len(data), self.width - 1, np.int32)
            past[back:] = own[:-back]
            for gone in range(back):  # places before a text's first byte
                at = start + gone
                past[at[at < ends[1:]]] = self.width - 1
            before = before * self.width + past
        rows = self.nodes[before].astype(np.int64) * self.width + own
        filled = np.flatnonzero(ends[1:] > start)
        flat = self.bits.reshape(-1, len(self.langs))
        out[filled] = np.add.reduceat(flat[rows].astype(np.float64), start[filled], axis=0)
        return out


def _bits(counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Bits of each symbol in contexts with these counts, escaping to ``shorter`` where a symbol was not seen."""
    total, kinds = counts.sum(1, keepdims=True), (counts > 0).sum(1, keepdims=True)
    whole = total + kinds
    with np.errstate(divide="ignore", invalid="ignore"):
        direct = np.log2(whole) - np.log2(counts)
        escape = np.log2(whole) - np.log2(kinds)
    return np.where(total == 0, shorter, np.where(counts > 0, direct, escape + shorter))


def _trees(model: bytes) -> ContextTrees:
    """A worker builds the table once from the counts it was sent."""
    return held(("trees", model), lambda: _build(model))


def _build(model: bytes) -> ContextTrees:
    with pa.ipc.open_stream(model) as reader:
        table = reader.read_all()
    langs = sorted(set(table.column("lang").to_pylist()))
    number = {name: i for i, name in enumerate(langs)}
    lang = np.array([number[x] for x in table.column("lang").to_pylist()], np.int64)
    return ContextTrees(langs, [lang, *(table.column(c).to_numpy().astype(np.int64) for c in ("size", "context", "next", "n"))])


def fit(labelled: DataFrame, docs_per_language: int = SAMPLE_DOCS) -> bytes:
    """The context counts of a bounded sample of labelled texts (``doc_id, text, lang``), as Arrow bytes.

    The bound is on documents; each is learned from as a whole. The counts reach the driver: a row for each context of at most three bytes
    and the byte after it that the sample holds.
    """
    table = context_counts(training_sample(labelled, docs_per_language)).toArrow()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def identify(docs: DataFrame, model: bytes, text: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score`` to every row, read from nothing but its whole text.

    ``lang_pred`` is the language with the shortest code, the first by name if two tie; ``score`` its share of the likelihood,
    all languages being equally likely beforehand. A text that is null or has no letter, or a model that learned no language,
    gives ``und`` and 0. Columns of ``docs`` with these two names are replaced.
    """
    columns = [c for c in docs.columns if c not in ("lang_pred", "score")]
    # the other columns travel as one, so that no name can clash
    rows = docs.select(F.struct(*map(quoted, columns)).alias("it"), F.coalesce(quoted(text).rlike(r"\p{L}"), F.lit(False)).alias("letter"))
    schema = T.StructType([rows.schema["it"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, place = _trees(model), columns.index(text)
        whole = (pa.RecordBatch.from_arrays([*b.columns, b.column("it").field(place)], ["it", "letter", "text"]) for b in batches)
        for batch in slices(whole, "text"):
            letter = np.asarray(batch.column("letter"))
            names, scores = np.full(batch.num_rows, "und", object), np.zeros(batch.num_rows)
            if trees.langs:
                bits = trees.code_lengths(*text_bytes(batch.column("text")))
                best = bits.argmin(1)
                share = 1 / np.exp2(np.minimum(bits[np.arange(len(best)), best][:, None] - bits, 0)).sum(1)
                names = np.where(letter, np.array(trees.langs, object)[best], "und")
                scores = np.where(letter, share, 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("it"), pa.array(names, pa.string()), pa.array(scores)], schema.names)

    return in_batches(rows, score, schema, keeps=True).select("it.*", "lang_pred", "score")
