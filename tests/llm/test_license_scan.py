"""License scans against a search of the whole text, and hand-made misspellings."""

import random
import re

import pytest
import regex
from pyspark.sql import functions as F

from fieldspark.llm import license_scan
from fieldspark.llm.license_scan import BASE_PHRASES, NOTICES, Scanner, allowed_edits, seeds
from fieldspark.llm.queries import QUERIES

DIRECTORY = "/root/testdata/sf0.001"


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def base_by_definition(text):
    own = words_of(text)
    return sorted((i, label) for label, phrase in BASE_PHRASES for i in range(len(own)) if own[i : i + len(phrase.split())] == phrase.split())


def spans_by_whole_search(text, notices=NOTICES):
    """Every notice looked for with edits through the whole text, without seeds or windows."""
    line = f" {' '.join(words_of(text))} "
    out = []
    for number, (_, notice) in enumerate(notices):
        pattern = regex.compile(rf"(?<= )(?:{regex.escape(notice, literal_spaces=True)}){{e<={allowed_edits(notice)}}}(?= )", regex.ENHANCEMATCH)
        out += [(m.start(), m.end(), sum(m.fuzzy_counts), number) for m in pattern.finditer(line)]
    return sorted(out)


def misspelt(notice, edits, rng):
    letters = list(notice)
    for _ in range(edits):
        at, kind = rng.randrange(len(letters)), rng.randrange(3)
        letters[at : at + 1] = [[], [letters[at], rng.choice("aeiou")], [rng.choice("bcdfg")]][kind]
    return "".join(letters)


def test_seeds_cover_a_notice():
    for _, notice in NOTICES:
        parts = seeds(notice, allowed_edits(notice))
        assert len(parts) == allowed_edits(notice) + 1
        assert "".join(p for _, p in parts) == notice
        assert all(notice[at : at + len(p)] == p for at, p in parts)


def test_windows_find_what_a_search_of_the_whole_text_finds():
    rng, scanner = random.Random(5), Scanner(NOTICES, BASE_PHRASES)
    for _ in range(120):
        parts = []
        for _ in range(rng.randrange(6)):
            notice = rng.choice(NOTICES)[1]
            parts.append(misspelt(notice, rng.randrange(allowed_edits(notice) + 3), rng))
            parts.append(" ".join(rng.choices(["license", "the", "mit", "under", "gnu", "general", "ñandú", "1", "public"], k=rng.randrange(8))))
        text = " ".join(parts)
        line = f" {' '.join(words_of(text))} "
        assert sorted(scanner.find(line)[1]) == spans_by_whole_search(text), text


def test_every_notice_is_found_with_the_edits_it_allows():
    rng, scanner = random.Random(7), Scanner(NOTICES, BASE_PHRASES)
    for label, notice in NOTICES:
        for edits in range(allowed_edits(notice) + 1):
            letters = list(notice)
            for at in rng.sample([i for i, c in enumerate(notice) if c != " "], edits):
                letters[at] = "q"
            _, _, found = scanner.scan(f"Intro, {''.join(letters).upper()}. End")
            assert [(f["label"], f["notice"], f["edits"], f["first_word"], f["last_word"]) for f in found] == [(label, notice, edits, 1, len(notice.split()))]


@pytest.mark.parametrize("name", ["odd", "crowd", "empty"])
def test_scan_of_odd_tables(spark, request, name):
    docs = request.getfixturevalue(name).withColumn("notices", F.lit(1)).withColumn("a.b", F.lit(2))
    notices = [
        "Released under the MIT License.", "Relesed under the MIT Licence", "GNU General Public License, GNU general public license!", "cc-by cc by CC BY-NC",
        "submit license", "the apache licenses", "ccby", "mit\nlicense mit  license", "x " * 5000 + "mit license " * 300, "licensed under the bsd license",
    ]
    if name == "odd":
        rows = docs.select("doc_id", "text").union(spark.createDataFrame([(200 + i, t) for i, t in enumerate(notices)], "doc_id long, text string"))
    else:
        rows = docs
    got = sorted((r.doc_id, r.n_words, sorted((x.word, x.label) for x in r.base)) for r in license_scan.scan_licenses(rows).collect() if r.doc_id is not None)
    want = sorted((r.doc_id, len(words_of(r.text)), base_by_definition(r.text)) for r in rows.collect() if r.doc_id is not None)
    assert got == want
    assert license_scan.scan_licenses(docs).count() == docs.count()
    if name == "odd":
        told = {r.doc_id - 200: r for r in license_scan.summary(license_scan.scan_licenses(rows)).where("doc_id >= 200").collect()}
        assert told[0].base_labels == "mit" and told[0].score == 1.0 and (told[0].first_word, told[0].last_word) == (3, 3)
        assert (told[1].base_labels, told[1].labels, told[1].n_notices) == ("", "mit", 1) and abs(told[1].score - 28 / 30) < 1e-9
        assert told[2].n_base == 2 and told[2].labels == "gpl"
        assert told[3].n_base == 3
        assert (told[4].labels, told[5].labels, told[6].labels) == ("", "", "") and told[4].score == 0.0 and told[4].first_word is None
        assert told[7].n_base == 2 and told[8].n_base == 300 and told[8].last_word == 5000 + 598
        assert (told[9].base_labels, told[9].labels, told[9].score) == ("", "bsd", 1.0)


def test_own_notices_and_identifier(spark):
    docs = spark.createDataFrame([("k1", "the grand old licence of yore"), ("k2", None)], "key string, text string")
    got = license_scan.scan_licenses(docs, [("old", "grand old license of yore")], [("grand", "the grand")], id_column="key").collect()
    assert [(r.key, len(r.base), len(r.notices)) for r in sorted(got)] == [("k1", 1, 1), ("k2", 0, 0)]
    assert got[0].notices[0].matched == "grand old licence of yore" and got[0].notices[0].edits == 1


def test_query_equals_its_definition(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DIRECTORY}/documents.parquet").collect()}
    got = QUERIES["op13_fuzzy_notices"](spark, DIRECTORY).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        base = base_by_definition(texts[r.doc_id])
        labels = sorted({label for _, label in base})
        places = [i for i, _ in base]
        assert (r.n_words, r.n_base, r.base_labels) == (len(words_of(texts[r.doc_id])), len(base), ",".join(labels))
        assert (r.first_word, r.last_word) == ((min(places), max(places)) if places else (None, None))
        assert set(labels) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert bool(r.n_notices) == bool(spans_by_whole_search(texts[r.doc_id]))
