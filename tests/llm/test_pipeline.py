"""The pipeline stage by stage against brute force, and the queries whose columns no other test looks at."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
from tokenizers import Tokenizer

import corpus_pipeline
from fieldspark.llm import language
from fieldspark.llm.queries import QUERIES, held_out

DIRECTORY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def corpus(spark, odd, base, tmp_path_factory):
    """The odd rows, near copies, repeated identifiers, and passages of a benchmark."""
    folder = tmp_path_factory.mktemp("corpus")
    item = " ".join(f"item{i} of the test" for i in range(6))
    words = base.split()
    near = [" ".join([*words[:i], f"other{i}", *words[i + 1 :]]) for i in (3, 90, 170)]
    more = [
        (50, near[0]), (51, near[1]), (52, near[2]), (52, "the same identifier with another text"), (53, "the same identifier with another text"),
        (60, f"Before it. {item.upper()}! After it."), (61, " ".join(item.split()[:9]) + " breaks off"), (62, "a " + " ".join(item.split()[4:14])), (63, "!!! ??? 123"),
    ]
    docs = odd.union(spark.createDataFrame([(i, t, "en", "s", "k", 1, 2) for i, t in more], odd.schema))
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None), (3, "short item")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), [item, "short item"]


def rows(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def one_of_each_class(kept, width=5, percent=80):
    """Of rows with an identifier, those that stay when classes of similar texts keep the smallest identifier."""
    listed = [(i, t) for (i, t), n in kept.items() for _ in range(n)]
    sets = []
    for _, t in listed:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        sets.append(frozenset(zip(*(w[k:] for k in range(width)))) if len(w) >= width else frozenset([tuple(w)] if w else []))
    root = list(range(len(listed)))
    for a in range(len(listed)):
        for b in range(a):
            if listed[a][0] is None or listed[b][0] is None or not sets[a] or not sets[b]:
                continue
            common = len(sets[a] & sets[b])
            if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = root[a], root[b]
                root = [min(x, y) if r in (x, y) else r for r in root]
    classes = defaultdict(list)
    for place, r in enumerate(root):
        classes[r].append(listed[place])
    return Counter(min(c, key=lambda row: (row[0] is not None, row[0] or 0)) for c in classes.values())


def test_stages_against_brute_force(spark, corpus):
    folder, benchmark = corpus
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns

    named = stages["language_id"](spark, docs, folder).cache()
    assert named.columns == columns
    want = Counter({row: n for row, n in rows(docs).items() if regex.search(r"\p{L}", row[1] or "")})
    assert rows(named) == want and (63, "!!! ??? 123") not in want

    exact = stages["exact_dedup"](spark, named, folder).cache()
    by_text = defaultdict(list)
    for (i, t), n in want.items():
        by_text[t] += [i] * n
    want = Counter((max((i for i in ids if i is not None), default=None), t) for t, ids in by_text.items())
    assert exact.columns == columns and rows(exact) == want

    near = stages["jaccard_join"](spark, exact, folder).cache()
    want = one_of_each_class(want)
    assert near.columns == columns and rows(near) == want

    clean = stages["decontamination"](spark, near, folder).cache()
    phrases = [w[k : k + 10] for w in (re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(b)) for b in benchmark) for k in range(max(1, len(w) - 9))]

    def hit(text):
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
        return any(own[k : k + len(p)] == p for p in phrases for k in range(len(own) - len(p) + 1))

    dropped = {i for i, t in want if hit(t)}
    want = Counter({row: n for row, n in want.items() if not hit(row[1])})
    assert clean.columns == columns and rows(clean) == want and dropped == {60, 62}

    packed = stages["best_fit_packing"](spark, clean, folder)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = Counter()
    for (i, t), n in want.items():
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            pieces[i, k // 2048, k, len(ids[k : k + 2048]), zlib.crc32(np.array(ids[k : k + 2048], "<u4").tobytes())] += n
    told = lambda df: Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert told(packed) == pieces
    assert told(corpus_pipeline.run(spark, folder)) == pieces


def test_pipeline_of_nothing(spark, corpus, tmp_path):
    folder, _ = corpus
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_language_query_over_a_whole_table(spark):
    docs = spark.read.parquet(f"{DIRECTORY}/documents.parquet")
    facts = {r.doc_id: (r.text, r.lang) for r in docs.collect()}
    got = QUERIES["op4_context_trees"](spark, DIRECTORY).collect()
    assert sorted(r.doc_id for r in got) == sorted(facts)
    learned = {lang for _, lang in facts.values() if lang}
    right = 0
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        letters = bool(regex.search(r"\p{L}", facts[r.doc_id][0] or ""))
        assert r.lang_pred in learned if letters else r.lang_pred == "und"
        assert 0 <= r.score <= 1 and (r.score > 0) == letters
        right += r.lang_pred == facts[r.doc_id][1]
    assert right >= 0.95 * len(got)


def test_language_is_learned_from_whole_texts(spark):
    """What stands only at the end of a long text counts, and nothing of the held-out part does."""
    long = "common words of all " * 2000
    rows = [(i, long + ("zebu zorro zaza " * 40 if i % 2 else "quip quota quay " * 40), "z" if i % 2 else "q") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs.where(~held_out()))
    asked = spark.createDataFrame([("zaza zebu",), ("quay quip",)], "text string")
    assert [r.lang_pred for r in language.identify(asked, model).orderBy("text").collect()] == ["q", "z"]


def test_packing_query_shows_the_matrices(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DIRECTORY}/documents.parquet").collect()}
    ids = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 50256] for i, t in texts.items()}
    seen = Counter()
    for r in QUERIES["op7_token_output"](spark, DIRECTORY).collect():
        row, positions = [], []
        for doc, start, a, b in zip(r.doc_ids, r.starts, r.cu_seqlens, r.cu_seqlens[1:]):
            row += ids[doc][start : start + b - a]
            positions += range(b - a)
            seen[doc] += b - a
        assert len(row) == r.n_tokens <= 2048
        rest = 2048 - len(row)
        assert r.ids_crc32 == zlib.crc32(np.array(row + [50256] * rest, "<u4").tobytes())
        assert r.positions_crc32 == zlib.crc32(np.array(positions + [0] * rest, "<u4").tobytes())
    assert seen == Counter({i: len(x) for i, x in ids.items()})
