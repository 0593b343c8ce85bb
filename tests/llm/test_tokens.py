"""Tokens, packing, sharding, language and decontamination against the libraries and brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fieldspark.llm import best_fit, decontaminate, language, sharding, token_counts, token_output
from fieldspark.llm.common import workspace
from fieldspark.llm.queries import held_out, language_model
from fieldspark.llm.tokens import TextTokenizer

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
PIECES = [
    "a", "B", "é", "é", "́", " ", "  ", "   ", "\n", " \n", "\t", "\x85", "\xa0", "　", "'s", "'S", "don't", "12", "<|endoftext|>",
    "<|startoftext|>", "!", "?", "Σ", "İ", "ß", "漢字", "😀", "\x1c", "​", "\r\n", "Hello", "world,", "x" * 80, "µ", "ª", "for.\nWhb", "ende\nAnfang", "\n\n",
]


@pytest.fixture(scope="module", params=[(WORDS, True), (BYTES, True), (WORDS, False), (BYTES, False)], ids=str)
def encoder(request):
    return TextTokenizer(*request.param)


@settings(max_examples=300, deadline=None)
@given(parts=st.lists(st.sampled_from(PIECES), max_size=30))
def test_encoder_gives_the_library_s_ids(encoder, parts):
    text = "".join(parts)
    want = encoder.library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode([text, text[::2]])[0], np.uint32).tolist() == want


def test_encoder_gives_the_library_s_ids_for_every_character(encoder):
    """Each character between letters, digits, spaces and marks, and twice in a row."""
    assert encoder.kind != "whole"
    for block in range(0, 0x110000, 2048):
        chars = [chr(c) for c in range(block, block + 2048) if not 0xD800 <= c <= 0xDFFF]
        texts = [f"a{c}b 1{c}2 {c}{c} {c}\n.{c}." for c in chars]
        if block >= 0x20000:  # beyond, blocks are alike: every 16th character
            texts = texts[::16]
        want = [np.array(e.ids, np.uint32).tobytes() for e in encoder.library.encode_batch_fast(texts, add_special_tokens=False)]
        assert encoder.encode(texts) == want


def test_other_kinds_are_left_to_the_library(tmp_path):
    """A file whose ids are not in the order of its merges is encoded by the library itself."""
    import json

    with open(BYTES, encoding="utf-8") as file:
        spec = json.load(file)
    spec["model"]["merges"][10], spec["model"]["merges"][11] = spec["model"]["merges"][11], spec["model"]["merges"][10]
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    other = TextTokenizer(str(path))
    assert other.kind == "whole"
    text = "The committee's reports\n\nwere 12 pages"
    assert np.frombuffer(other.encode([text])[0], np.uint32).tolist() == Tokenizer.from_file(str(path)).encode(text).ids


def ids_of(path, docs):
    t = Tokenizer.from_file(path)
    return {r.doc_id: t.encode(r.text or "", add_special_tokens=False).ids for r in docs.select("doc_id", "text").collect()}


@pytest.mark.parametrize("name", ["odd", "empty"])
def test_counts_and_cache(request, spark, name):
    docs = request.getfixturevalue(name)
    cache = workspace(spark, "cache")
    t = Tokenizer.from_file(BYTES)
    want = Counter((r.doc_id, len((r.text or "").encode()), n := len(t.encode(r.text or "", add_special_tokens=False).ids), n > 1024) for r in docs.select("doc_id", "text").collect())
    for _ in range(2):
        assert Counter(tuple(r) for r in token_counts.count_tokens(docs, BYTES, cache).collect()) == want
        stored = token_counts.read_cache(spark, cache)
        assert stored.count() == stored.select("digest").distinct().count() == len({r.text or "" for r in docs.collect()})
    # a stored count is used, one of another tokenizer is not
    assert token_counts.count_tokens(docs, WORDS, cache).count() == docs.count()
    assert token_counts.read_cache(spark, cache).select("version").distinct().count() == (2 if want else 0)


@pytest.mark.parametrize("name", ["unique", "empty"])
def test_best_fit_packing(request, name):
    docs = request.getfixturevalue(name)
    ids = ids_of(WORDS, docs)
    bins = defaultdict(list)
    seen = defaultdict(int)
    for r in sorted(best_fit.pack_documents(docs, WORDS, capacity=64).collect(), key=lambda r: (r.doc_id, r.piece)):
        own = ids[r.doc_id] + [0]
        part = own[r.start : r.start + r.length]
        assert r.start == seen[r.doc_id] and r.length == len(part) and r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        seen[r.doc_id] += r.length
        bins[r.sequence_id].append((r.offset, r.length))
    assert seen == {i: len(x) + 1 for i, x in ids.items()}
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64


def test_bounded_best_fit():
    bins = best_fit.BoundedBestFit(10, most=2)
    assert [bins.place(n) for n in (6, 7, 3, 4, 5, 9, 8, 1)] == [(0, 0), (1, 0), (1, 7), (0, 6), (2, 0), (3, 0), (4, 0), (4, 8)]
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 2049, 20_000)
    bins = best_fit.BoundedBestFit(2048)
    for n in lengths.tolist():
        bins.place(n)
    assert bins.count < 1.02 * math.ceil(lengths.sum() / 2048)


def test_segment_tree_packing():
    rng = np.random.default_rng(1)
    for _ in range(30):
        lengths = rng.integers(1, 33, 60).tolist()
        bins = token_output.best_fit_decreasing(lengths, 32)
        assert sorted(i for b in bins for i in b) == list(range(60)) and all(sum(lengths[i] for i in b) <= 32 for b in bins)
        # the same by trying every bin
        free, plain = [], []
        for i in sorted(range(60), key=lambda i: (-lengths[i], i)):
            fits = [k for k, f in enumerate(free) if f >= lengths[i]]
            k = min(fits, key=lambda k: free[k]) if fits else len(free)
            if not fits:
                free.append(32), plain.append([])
            free[k] -= lengths[i]
            plain[k].append(i)
        assert len(bins) == len(plain)


@pytest.mark.parametrize("name", ["unique", "empty"])
def test_packed_rows_round_trip(request, spark, name):
    docs = request.getfixturevalue(name)
    ids = ids_of(BYTES, docs)
    path = workspace(spark, "packed")
    token_output.write_packed(token_output.packed_rows(docs, BYTES, 64, block_tokens=2000), path)
    packed = spark.read.parquet(path)
    for r in packed.collect():
        row, positions = np.frombuffer(r.input_ids, "<u4"), np.frombuffer(r.position_ids, "<u4")
        assert len(row) == len(positions) == 64 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens
        assert (row[r.n_tokens :] == 50256).all()
        for a, b in zip(r.cu_seqlens, r.cu_seqlens[1:]):
            assert positions[a:b].tolist() == list(range(b - a))
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in token_output.documents_of(packed).collect()}
    assert got == {i: x + [50256] for i, x in ids.items()}


def test_odd_rows_pack(odd):
    n = odd.count()
    assert best_fit.pack_documents(odd, WORDS).where("piece = 0").count() == n
    assert sum(p == 0 for r in token_output.packed_rows(odd, BYTES).collect() for p in r.pieces) == n


def test_lookup_table():
    names = [f"s{i}" for i in range(7)]
    table = sharding.lookup_table(names, 251)
    counts = Counter(table)
    assert set(counts) == set(range(7)) and max(counts.values()) - min(counts.values()) <= 1
    # by the definition: whole permutations, one claim a turn
    orders = []
    for name in names:
        d = hashlib.blake2b(name.encode(), digest_size=16).digest()
        a, b = int.from_bytes(d[:8], "little") % 251, int.from_bytes(d[8:], "little") % 250 + 1
        orders.append([(a + j * b) % 251 for j in range(251)])
    want = {}
    while len(want) < 251:
        for i, order in enumerate(orders):
            free = next((s for s in order if s not in want), None)
            if free is not None:
                want[free] = i
    assert table == [want[s] for s in range(251)]
    fewer = sharding.lookup_table(names[:-1], 251)
    assert sum(a != b for a, b in zip(table, fewer) if a != 6) < 0.2 * 251
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.lookup_table(bad, 251)
    with pytest.raises(ValueError):
        sharding.lookup_table(["a"], 250)


def test_assign_and_write_shards(spark, odd, empty):
    names = [f"s{i}" for i in range(5)]
    extra = odd.selectExpr("*", "1 as slot", "'x' as shard")
    got = sharding.assign_shards(extra, names, slots=251)
    table = sharding.lookup_table(names, 251)
    rows = got.selectExpr("*", "pmod(xxhash64(doc_id), 251) as want").collect()
    assert len(rows) == odd.count() and all(r.slot == r.want and r.shard == names[table[r.slot]] for r in rows)
    path = workspace(spark, "shards")
    sharding.write_shards(got, path)
    assert spark.read.parquet(path).groupBy("shard").count().orderBy("shard").collect() == got.groupBy("shard").count().orderBy("shard").collect()
    assert sharding.assign_shards(empty, names).count() == 0


def bits_of(counts, order, text):
    """Code length of a text by one context tree, from the definition."""
    total = 0.0
    for i, byte in enumerate(text):
        p = 1.0
        known_bytes = counts["bytes"]
        for size in range(min(order, i), -1, -1):
            own = counts["tree"].get(text[i - size : i])
            if not own:
                continue
            n, kinds = sum(own.values()), len(own)
            if byte in own:
                p *= own[byte] / (n + kinds)
                break
            p *= kinds / (n + kinds)
        else:
            p *= 1 / 256
        total -= math.log2(p)
    return total


def test_context_trees_give_exact_code_lengths(spark):
    texts = {"a": [b"abracadabra abra", b"cadabra"], "b": [b"mississippi river", b"sip \xc3\xa9t\xc3\xa9"]}
    rows = [(i, t.decode(), lang) for lang, ts in texts.items() for i, t in enumerate(ts)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    trees = language._trees(model)
    assert trees.langs == ["a", "b"]
    tests = [b"abra", b"", b"mississippi", b"zz\xc3\xa9 ab", b"sipabra", b"c"]
    ends = np.cumsum([0, *map(len, tests)])
    got = trees.code_lengths(np.frombuffer(b"".join(tests), np.uint8), ends)
    for k, lang in enumerate(trees.langs):
        tree = defaultdict(Counter)
        for t in texts[lang]:
            for i in range(len(t)):
                for size in range(min(language.ORDER, i) + 1):
                    tree[t[i - size : i]][t[i]] += 1
        for j, t in enumerate(tests):
            assert got[j, k] == pytest.approx(bits_of({"tree": tree, "bytes": None}, language.ORDER, t), rel=1e-4)


def test_language_of_odd_rows(odd, empty):
    model = language_model(odd)
    got = language.identify(odd.selectExpr("*", "1 as score"), model).collect()
    assert len(got) == odd.count()
    for r in got:
        letter = bool(r.text) and any(c.isalpha() for c in r.text)
        assert (r.lang_pred == "en" and r.score == 1.0) if letter else (r.lang_pred == "und" and r.score == 0.0)
    assert language.identify(empty, model).count() == 0
    nothing = language.identify(odd, language_model(empty))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    named = language.identify(docs, language_model(docs)).where(held_out())
    right, n = named.selectExpr("count_if(lang = lang_pred)", "count(*)").first()
    assert n > 200 and right / n > 0.97


def windows(benchmark, width):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    found = defaultdict(set)
    for i, t in benchmark:
        w = split(t)
        for k in range(max(1, len(w) - width + 1) if w and i is not None else 0):
            found[tuple(w[k : k + width])].add(str(i))
    return found, split


@pytest.mark.parametrize("block_words", [500_000, 60])
def test_decontamination(spark, odd, empty, block_words):
    base = odd.where("doc_id = 0").first().text
    words = base.replace(",", "").split()
    items = [
        (1, " ".join(words[10:40])), (20, " ".join(words[30:45]) + " not there"), (3, "Two words!"), (None, "two words"), (5, None), (6, "?!"),
        (7, "ab " * 12), (8, " ".join(reversed(words[10:22]))), (9, "nowhere at all"), (10, "straße ñandú"), (20, " ".join(words[50:70])),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found, split = windows(items, 10)
    got = decontaminate.contamination(decontaminate.benchmark_matches(odd, benchmark, block_words=block_words)).collect()
    want = Counter()
    for r in odd.select("doc_id", "text").collect():
        w, hit, own = split(r.text), set(), set()
        for size in {len(x) for x in found}:
            for k in range(len(w) - size + 1):
                if (o := found.get(tuple(w[k : k + size]))):
                    hit.update(range(k, k + size))
                    own |= o
        want[r.doc_id, len(w), len(hit), len(own), hashlib.sha256(",".join(sorted(own)).encode()).hexdigest(), bool(hit)] += 1
    assert Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got) == want
    # the reversed phrase is near, not exact
    near = {r.doc_id: r for r in decontaminate.benchmark_matches(odd, benchmark, block_words=block_words).collect()}
    assert "8" in near[1].near and "8" not in near[1].items
    assert decontaminate.benchmark_matches(empty, benchmark).count() == 0
    assert decontaminate.benchmark_matches(odd, benchmark.limit(0)).where("size(items) > 0").count() == 0
    kept = decontaminate.drop_contaminated(odd, benchmark)
    assert kept.columns == odd.columns
    assert Counter(r.text for r in kept.collect()) == Counter(
        r.text for r in odd.collect() if not any(tuple(split(r.text)[k : k + s]) in found for s in {len(x) for x in found} for k in range(len(split(r.text)) - s + 1))
    )
