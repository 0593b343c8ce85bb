"""Registered queries without SQL over a whole small table: their results by brute force or by definition."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fieldspark.llm import chunk_dedup, sharding
from fieldspark.llm.queries import QUERIES, SHARDS, SQL
from test_dedup import chunks, repeats

DIRECTORY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DIRECTORY}/documents.parquet").collect()}


def rows(spark, name):
    return QUERIES[name](spark, DIRECTORY).collect()


def test_there_is_a_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert {n.split("_")[0] for n in SQL} == {"op5", "op9", "op10", "op11"}


def test_op1(spark, texts):
    seen, want = set(), {}
    for i, t in sorted(texts.items()):
        b, spans, n = t.encode(), [], 0
        own = chunks(b)
        for a, z in own:
            if b[a:z] in seen:
                n += 1
                if spans and spans[-1][1] == a:
                    spans[-1][1] = z
                else:
                    spans.append([a, z])
            seen.add(b[a:z])
        spans = [(a, z) for a, z in spans if z - a >= chunk_dedup.LEAST_RUN]
        want[i] = (len(b), len(own), n, sum(z - a for a, z in spans), spans)
    got = {r.doc_id: (r.n_bytes, r.n_chunks, r.n_repeated, r.n_removed, [tuple(x) for x in r.removed]) for r in rows(spark, "op1_chunk_dedup")}
    assert got == want and any(w[3] for w in want.values())


def test_op2(spark, texts):
    table = sharding.lookup_table(SHARDS)
    got = rows(spark, "op2_lookup_table")
    assert sorted(r.doc_id for r in got) == sorted(texts)
    assert all(r.shard == SHARDS[table[r.slot]] for r in got)
    hashed = spark.createDataFrame([(i,) for i in texts], "doc_id long").selectExpr("doc_id", f"pmod(xxhash64(doc_id), {sharding.SLOTS}) AS slot").collect()
    assert {r.doc_id: r.slot for r in got} == {r.doc_id: r.slot for r in hashed}


def test_op3(spark, texts):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, total = Counter(), 0
    for i, text in texts.items():
        ids = [*t.encode(text, add_special_tokens=False).ids, 0]
        total += len(ids)
        for k in range(0, len(ids), 2048):
            part = ids[k : k + 2048]
            want[i, k // 2048, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    got = rows(spark, "op3_best_fit")
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        parts.sort()
        assert [o for o, _ in parts] == [0, *np.cumsum([n for _, n in parts])[:-1]] and sum(n for _, n in parts) <= 2048
    assert len(bins) <= 1.1 * total / 2048 + 2


def test_op6(spark, texts):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: (len(x.encode()), n := len(t.encode(x, add_special_tokens=False).ids), n > 1024) for i, x in texts.items()}
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in rows(spark, "op6_token_counts")} == want


def test_op8(spark, texts):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows(spark, "op8_suffix_sort")}
    assert got == repeats(texts.items())
