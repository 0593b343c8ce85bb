"""Exact, near and substring deduplication against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from fieldspark.llm import chunk_dedup, content_sort, metric_join, suffixes
from fieldspark.llm.common import workspace
from fieldspark.llm.components import connected_components
from fieldspark.llm.hashing import shingle_sets


def pairs_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def sha(b):
    return hashlib.sha256(b).hexdigest()


@pytest.mark.parametrize("name", ["odd", "crowd", "empty"])
@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_groups(request, name, keep):
    docs = request.getfixturevalue(name)
    groups = defaultdict(list)
    for i, t in pairs_of(docs):
        groups[t or ""].append(i)
    got = content_sort.exact_groups(docs, keep=keep).collect()
    assert len(got) == docs.count()
    by_sha = defaultdict(list)
    for r in got:
        by_sha[r.text_sha256].append(r)
    for text, ids in groups.items():
        rows = by_sha[sha(text.encode())]
        known = [i for i in ids if i is not None]
        stays = (max if keep == "largest" else min)(known) if known else None
        assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == sorted((i is None, i or 0) for i in ids)
        assert {(r.keep_id, r.group_size) for r in rows} == {(stays, len(ids))}
        assert [r.doc_id for r in rows if r.kept] == [stays]


def test_drop_exact_keeps_all_columns(odd):
    kept = content_sort.drop_exact(odd)
    assert kept.columns == odd.columns
    texts = [r.text or "" for r in kept.collect()]
    assert sorted(texts) == sorted({t or "" for _, t in pairs_of(odd)})


def jaccard(docs, width, percent):
    sets = {}
    for i, t in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = frozenset(zip(*(words[k:] for k in range(width)))) if len(words) >= width else frozenset([tuple(words)] if words else [])
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if b < a and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("name", ["unique", "crowd"])
@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80), (2, 50)])
def test_metric_join(request, monkeypatch, name, width, percent):
    docs = request.getfixturevalue(name)
    monkeypatch.setattr(metric_join, "BLOCK_SHINGLES", 1000)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in metric_join.jaccard_components(docs, width, percent).collect()}
    assert got == jaccard(pairs_of(docs), width, percent)


def test_metric_join_odd_rows(odd, empty):
    got = metric_join.jaccard_components(odd).collect()
    assert len(got) == odd.count()
    assert all(r.component_id is None for r in got if r.doc_id is None)
    assert all(r.component_id == r.doc_id for r in got if r.n_shingles == 0)
    assert metric_join.jaccard_components(empty).collect() == []
    kept = metric_join.drop_near(odd)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} >= {None, 0, 4, 5}


def test_slices_miss_no_similar_pair():
    rng = np.random.default_rng(5)
    for percent in (50, 80, 90, 95):
        slicing = metric_join.Slicing(percent)
        for _ in range(300):
            n = int(rng.integers(1, 120))
            a = rng.integers(0, 1 << 63, n).astype(np.uint64)
            gone, added = rng.integers(0, n // 4 + 1, 2)
            b = np.concatenate([a[gone:], rng.integers(0, 1 << 63, int(added)).astype(np.uint64)])
            common = len(a) - gone
            if 100 * common >= percent * (len(a) + added):
                (x, need_x), (y, need_y) = slicing.keys(a), slicing.keys(b)
                both = [k & 63 for k in set(x.tolist()) & set(y.tolist())]
                assert both and any(both.count(c) >= max(dict(need_x)[c], dict(need_y)[c]) for c in dict(need_x).keys() & dict(need_y).keys())


def test_region_is_joined_exactly_when_pivots_split_it():
    rng = random.Random(2)
    sets = []
    for c in range(12):
        base = [c * 1000 + i for i in range(100)]
        for k in range(10):
            own = set(base[rng.randint(0, 12) : 100 - rng.randint(0, 12)]) | {c * 1000 + 200 + k * 7 + j for j in range(rng.randint(0, 6))}
            sets.append(np.array(sorted(own)))
    region = metric_join.MetricRegion(sets, 90)
    root = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            common = len(np.intersect1d(a, sets[j]))
            if 100 * common >= 90 * (len(a) + len(sets[j]) - common):
                x, y = root[i], root[j]
                root = [min(x, y) if r in (x, y) else r for r in root]
    assert [region.find(i) for i in range(len(sets))] == root


def test_large_clusters_meet_only_where_links_are_open(spark, monkeypatch):
    """A cluster of near copies is settled by its pivots; only sets that no pivot reaches meet the others."""
    monkeypatch.setattr(metric_join, "BLOCK_SHINGLES", 100)
    monkeypatch.setattr(metric_join, "FEW_BLOCKS", 1000)
    rows = [(1, i, 10, 1, [0], 1) for i in range(400)] + [(1, 400 + i, 10, 0, [], 0) for i in range(5)] + [(2, 500 + i, 10, 1, [500], 1) for i in range(300)]
    rows += [(3, 800 + i, 10, 1 + i % 2, [800], 1 + i % 2) for i in range(40)]
    coloured = spark.createDataFrame(rows, "cluster long, node long, size long, mask long, pivots array<long>, colour long")
    placed = defaultdict(set)
    for r in metric_join._open_blocks(coloured).collect():
        placed[r.node].add((r.cluster, r.i, r.j))
    # a set of the one colour meets the one block of the five others, and these meet all blocks and each other
    assert all(len(placed[i]) == 1 for i in range(400)) and all(len(placed[400 + i]) == 41 for i in range(5))
    assert not any(500 <= node < 800 for node in placed)
    # all that is open does meet: two sets of different colours, or of none, share a pair of blocks
    colour = {r[1]: (r[0], r[5]) for r in rows}
    for a in placed:
        for b in placed:
            if a < b and colour[a][0] == colour[b][0] and (colour[a] != colour[b] or colour[a][1] == 0):
                assert placed[a] & placed[b]


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 150), (150, 120), (7, 7), (200, 201), (201, 200)] + [(300, 300 + i) for i in range(50)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long"), workspace(spark, "t")).collect())
    want = {i: 0 for i in range(41)} | {100: 100, 150: 100, 120: 100, 200: 200, 201: 200} | {300 + i: 300 for i in range(50)}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long"), workspace(spark, "t")).count() == 0


def test_shingle_sets_do_not_cross_texts():
    texts = [b"a b c", b"", b"d", b"a  B\tc d", b"b c d e", b"d"]
    sets, digests = zip(*shingle_sets(texts, 3))
    assert [len(s) for s in sets] == [1, 0, 1, 2, 2, 1]
    assert sets[0][0] in sets[3] and not set(sets[0]) & set(sets[4]) and sets[2] == sets[5]
    assert [digests.index(d) for d in digests] == [0, 1, 2, 3, 4, 2]
    assert [len(s) for s, _ in shingle_sets([], 3)] == []


def test_words_that_defeat_a_polynomial_hash_are_not_linked(spark):
    """Letters by the parity of the bits of their place, and the opposite letters: no shingle in common."""
    word = "".join("ab"[i.bit_count() % 2] for i in range(1024))
    opposite = word.translate(str.maketrans("ab", "ba"))
    docs = spark.createDataFrame([(1, word), (2, opposite), (3, word), (4, f"{word} {opposite} x"), (5, f"{opposite} {word} x")], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in metric_join.jaccard_components(docs).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5}


def test_rows_that_share_an_identifier(spark, base):
    """Classes join rows of one identifier; a filter decides on each row by its own text."""
    other = "quite another text of more than a few words that has nothing in common"
    rows = [(3, base), (5, base), (5, other), (7, other + " indeed"), (8, None), (8, base), (None, base), (None, base), (9, "alone but here"), (9, "alone but here")]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, row long").repartition(3)
    kept = metric_join.drop_near(docs, 3, 80)
    assert kept.columns == docs.columns
    assert sorted((r.row for r in kept.collect()), key=int)[:1] == [0]
    stays = sorted((r.doc_id if r.doc_id is not None else -1, r.text or "") for r in kept.collect())
    assert stays == sorted([(3, base), (5, other), (8, ""), (-1, base), (-1, base), (9, "alone but here")])
    classes = metric_join.jaccard_components(docs, 3, 80)
    assert classes.count() == len(rows)
    assert {(r.doc_id, r.component_id) for r in classes.collect()} == {(3, 3), (5, 3), (7, 3), (8, 3), (None, None), (9, 9)}


def repeats(rows, length=100):
    seen, out = set(), {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        cover = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if b[k : k + length] in seen:
                cover[k : k + length] = b"\1" * length
            seen.add(b[k : k + length])
        runs = sum(1 for k in range(len(b)) if cover[k] and not (k and cover[k - 1]))
        out[i] = (len(b), sum(cover), runs, sha(bytes(c for c, x in zip(b, cover) if not x)))
    return out


@pytest.mark.parametrize("name", ["unique", "crowd"])
@pytest.mark.parametrize("bucket,shallow", [(4096, 4), (3, 1)])
def test_substring_dedup(request, monkeypatch, name, bucket, shallow):
    docs = request.getfixturevalue(name)
    monkeypatch.setattr(suffixes, "BUCKET", bucket)
    monkeypatch.setattr(suffixes.equal_strings, "__defaults__", (100, shallow))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.substring_dedup(docs).collect()}
    assert got == repeats(pairs_of(docs))


@pytest.mark.parametrize("piece", [150, 1000])
def test_long_texts_are_cut_piece_by_piece(spark, base, monkeypatch, piece):
    monkeypatch.setattr(suffixes, "PIECE", piece)
    rng = random.Random(4)
    rows = [(0, base * 3), (1, "q" * 1500), (2, "ab" * 700 + base[200:900]), (3, "".join(rng.choice("xyz") for _ in range(2500))), (4, None), (5, base[:90])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.substring_dedup(docs).collect()}
    assert got == repeats(rows)


def test_a_very_long_text_of_one_byte(spark):
    size = 3_000_000
    docs = spark.createDataFrame([(1, "z" * size), (2, "z" * 120 + "y")], "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.n_spans, r.removed[0].start) for r in suffixes.substring_dedup(docs).collect()}
    assert got == {1: (size - 1, 1, 1), 2: (120, 1, 0)}


def test_substring_dedup_keeps_one_of_repeated_rows(odd, empty):
    got = suffixes.substring_dedup(odd).collect()
    assert len(got) == odd.count()
    base = [r for r in got if r.n_bytes == len(dict(pairs_of(odd))[0])]
    # the row without an identifier comes first
    assert [r.doc_id for r in base if r.n_removed == 0] == [None]
    assert suffixes.substring_dedup(empty).collect() == []


def test_deep_shallow_sort_finds_equal_strings():
    rng = random.Random(1)
    data = b"".join(rng.choice([b"abcdefgh" * 8, b"abcdefgh" * 7 + b"abcdefgx", b"zyxw" * 4]) for _ in range(60))
    places = np.array([p for p in range(0, len(data) - 64, 4)])
    group = np.array([i % 2 for i in range(len(places))])
    for depth in (1, 3, 8):
        got = sorted(sorted(x.tolist()) for x in suffixes.equal_strings(np.frombuffer(data, np.uint8), places, group, 64, depth))
        want = defaultdict(list)
        for i, p in enumerate(places):
            want[group[i], data[p : p + 64]].append(i)
        assert got == sorted(v for v in want.values() if len(v) > 1)


def test_blind_trie_orders_strings():
    rng = random.Random(4)
    strings = [bytes(rng.choice(b"ab") for _ in range(9)) for _ in range(200)]
    trie = suffixes.BlindTrie()
    for i, s in enumerate(strings):
        trie.add(s, i)
    leaves = list(trie.leaves())
    assert [strings[x[0]] for x in leaves] == sorted(set(strings)) and sorted(i for x in leaves for i in x) == list(range(200))


def chunks(b):
    gear, out, start, h = chunk_dedup.GEAR.tolist(), [], 0, 0
    for i, c in enumerate(b):
        h = (h * 2 + gear[c]) & 0xFFFFFFFF
        if i + 1 - start >= chunk_dedup.LEAST and h >> (32 - chunk_dedup.CUT_BITS) == 0 or i + 1 - start == chunk_dedup.MOST:
            out.append((start, i + 1))
            start = i + 1
    return out + [(start, len(b))] if start < len(b) else out


@pytest.mark.parametrize("name", ["unique", "crowd"])
def test_chunk_repeats(request, name):
    docs = request.getfixturevalue(name)
    got = {r.doc_id: r for r in chunk_dedup.chunk_repeats(docs).collect()}
    seen = set()
    for i, t in sorted(pairs_of(docs)):
        b, spans, n = (t or "").encode(), [], 0
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
        r = got[i]
        assert (r.n_bytes, r.n_chunks, r.n_repeated, [tuple(x) for x in r.removed]) == (len(b), len(own), n, spans)
        assert r.n_removed == sum(z - a for a, z in spans)
        assert len(chunk_dedup.without(t, [{"start": a, "stop": z} for a, z in spans]).encode()) <= len(b) - r.n_removed


def test_chunk_repeats_odd_rows(odd, empty):
    got = chunk_dedup.chunk_repeats(odd).collect()
    assert len(got) == odd.count()
    size = len(dict(pairs_of(odd))[0])
    assert sorted(r.n_removed > 0 for r in got if r.n_bytes == size and r.doc_id in (None, 0, 1)) == [False, True, True, True]
    assert chunk_dedup.chunk_repeats(empty).collect() == []


def test_chunks_resist_a_shift():
    rng = random.Random(3)
    text = bytes(rng.choice(b"abcdefghij ") for _ in range(20_000))
    moved = b"inserted " + text
    a = {text[x:y] for x, y in chunks(text)}
    b = {moved[x:y] for x, y in chunks(moved)}
    assert len(a & b) > 0.97 * len(a)
