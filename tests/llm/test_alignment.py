"""Token alignment against the definition, text by text."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fieldspark.llm import alignment
from fieldspark.llm.queries import QUERIES
from fieldspark.llm.tokens import entry_bytes

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
DIRECTORY = "/root/testdata/sf0.001"
NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def by_definition(rows):
    """Result rows and the pair table for (id, text)."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    entries = {i: e for e, i in a.get_vocab().items()}
    documents, held = [], Counter()
    for id_, text in rows:
        text = text or ""
        sides = []
        for ids, shown in (
            (a.encode(" " + text, add_special_tokens=False).ids, lambda i: entries[i].encode() if entries[i].startswith("<|") else entry_bytes(entries[i])),
            (b.encode(text), lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()),
        ):
            parts = [shown(i) for i in ids]
            if not text or b"".join(parts) != (" " + text).encode():
                sides = None
                break
            sides.append((ids, np.cumsum([len(p) for p in parts]).tolist()))
        if sides is None:
            documents.append((id_, [], 0, 0))
            continue
        (ids_a, ends_a), (ids_b, ends_b) = sides
        cuts = sorted(set(ends_a) & set(ends_b))
        groups, i, j = [], 0, 0
        for cut in cuts:
            k, m = i, j
            while i < len(ids_a) and ends_a[i] <= cut:
                i += 1
            while j < len(ids_b) and ends_b[j] <= cut:
                j += 1
            groups.append((ids_a[k:i], ids_b[m:j]))
        documents.append((id_, groups, len(ids_a), len(ids_b)))
        held.update({(x, y) for xs, ys in groups for x in xs for y in ys})
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = []
    for id_, groups, n_a, n_b in documents:
        links = [(x, y) for xs, ys in groups for x in xs for y in ys]
        shown = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in groups)
        digest = hashlib.sha256(shown.encode()).hexdigest() if groups else ""
        out.append((id_, n_a, n_b, len(groups), len(links), sum(held[x] == best[x[0]] for x in links), sum(held[x] for x in links), digest))
    return sorted(out, key=str), {(x, y, n, n == best[x]) for (x, y), n in held.items()}


def found(aligned):
    return sorted((tuple(r) for r in aligned.documents.select(*NAMES).collect()), key=str)


HOSTILE = [
    "<s> and </s> and <unk> and <|endoftext|>", "▁ a lower block", "naïve café ☕ 漢字 😀😀", "tab\tand\n\nlines\r\n", "  two  spaces   ", " ",
    "x" * 700, "ab " * 500, "🏴󠁧󠁢󠁳󠁣󠁴󠁿" * 60, "́a combining", "\x00 zero", "1234567890" * 20, "ﬁ ligature", "​zero width", "e" * 3 + "\n" * 40,
    "Donaudampfschifffahrtsgesellschaftskapitän " * 9,
]


@pytest.mark.parametrize("name", ["odd", "empty"])
@pytest.mark.parametrize("size", [alignment.SLICE_BYTES, 2000])
def test_alignment_equals_its_definition(spark, request, monkeypatch, name, size):
    """Also in many small slices."""
    monkeypatch.setattr(alignment, "SLICE_BYTES", size)
    docs = request.getfixturevalue(name).select("doc_id", "text", F.lit(1).alias("slice"), F.lit("x").alias("kind"))
    if name == "odd":
        docs = docs.union(spark.createDataFrame([(100 + i, t, 1, "x") for i, t in enumerate(HOSTILE)], docs.schema))
    aligned = alignment.align_tokenizers(docs, A, B)
    want, links = by_definition([(r.doc_id, r.text) for r in docs.collect()])
    assert found(aligned) == want
    assert {tuple(r) for r in aligned.links.collect()} == links


def test_large_groups_are_reduced_to_distinct_ids(monkeypatch):
    pair = alignment.Pair(A, B)
    a, b = pair.encode(["🏴󠁧󠁢󠁳󠁣󠁴󠁿" * 60, "plain Donaudampfschifffahrt", "▁"])
    seen = []
    for written in (0, 3, 10**6):
        monkeypatch.setattr(alignment, "WRITTEN_LINKS", written)
        aligned = pair.align(a, b)
        assert aligned.n_a.tolist()[2] == aligned.n_b.tolist()[2] == 0
        text, keys, times = aligned.irregular_links()
        links = Counter()
        for t, k, n in zip(text.tolist(), keys.tolist(), times.tolist()):
            links[t, k] += n
        seen.append(links)
        every = np.bincount(text, times, 3) + np.bincount(aligned.exact_ids()[0], minlength=3)
        assert every.tolist() == aligned.counts()[3].tolist()
    assert seen[0] == seen[1] == seen[2]


def test_exact_groups_do_not_enter_the_pair_shuffle(spark):
    """A text whose words are one token on both sides leaves no pair outside the vector."""
    docs = spark.createDataFrame([(i, "the time of the people") for i in range(5)], "doc_id long, text string")
    parts = alignment._encoded(docs.coalesce(1), A, B)
    assert parts.where("kind = 'pairs' and size(keys) > 0").count() == 0
    assert parts.where("kind = 'same'").selectExpr("inline(arrays_zip(keys, docs))").selectExpr("max(docs)").first()[0] == 5


def test_query_equals_its_definition(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DIRECTORY}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in QUERIES["op12_identity_alignment"](spark, DIRECTORY).select(*NAMES).collect()), key=str)
    assert got == by_definition(rows)[0]
