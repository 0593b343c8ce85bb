"""Columns whose names could clash with an operator's own pass through it unchanged."""

import pytest
from pyspark.sql import functions as F

from fieldspark.llm import best_fit, chunk_dedup, content_sort, decontaminate, language, license_scan, manifest, metric_join, sharding, suffixes, token_counts, token_output
from fieldspark.llm.common import workspace

NAMES = [
    "__n", "__key", "__id", "__part", "__letter", "__row", "__text", "__at", "a.b", "slot", "shard", "score", "lang_pred", "row", "it", "maybe", "word", "bits",
    "node", "digest", "total", "letter", "position", "n", "part", "name", "hop", "id", "presented", "key", "kind", "slice", "keys",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"A text number {i} about the many things that are named alike and nothing else at all", "en") for i in range(6)] + [(6, None, None), (7, "", "en")]
    out = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return out.select("*", *[F.concat(F.lit(f"{n} of "), F.col("doc_id").cast("string")).alias(n) for n in NAMES])


def check(out, docs, without=()):
    """All rows of the result hold their own values of all other columns."""
    want = {r.doc_id: r.asDict() for r in docs.collect()}
    assert set(docs.columns) - set(without) <= set(out.columns)
    rows = out.collect()
    for r in rows:
        assert all(r.asDict()[c] == want[r.doc_id][c] for c in docs.columns if c not in without)
    return len(rows)


def test_operators_that_return_their_rows(spark, docs):
    benchmark = spark.createDataFrame([("i", "nothing of the kind stands in any of these texts here now")], "item_id string, text string")
    assert check(content_sort.drop_exact(docs), docs) == 7
    assert check(metric_join.drop_near(docs, 5, 95), docs) == 8
    assert check(decontaminate.drop_contaminated(docs, benchmark), docs) == 8
    assert check(sharding.assign_shards(docs, ["a", "b"]), docs, ["slot", "shard"]) == 8
    assert check(sharding.assign_shards(docs, ["a", "b"], "a.b"), docs, ["slot", "shard"]) == 8
    assert check(language.identify(docs, language.fit(docs)), docs, ["lang_pred", "score"]) == 8


def test_operators_with_rows_of_their_own(spark, docs, tmp_path):
    paths = __import__("public_tokenizers").path
    columns = ["doc_id", *NAMES[:9], "text"]
    built = manifest.build_manifest(docs, columns, "lang", workspace(spark, "names"))
    assert manifest.climb(built).where("verified").count() == 8
    for out in (
        best_fit.pack_documents(docs, paths("word_bpe_49k.json")),
        chunk_dedup.chunk_repeats(docs),
        content_sort.exact_groups(docs),
        license_scan.scan_licenses(docs),
        license_scan.scan_licenses(docs, id_column="a.b"),
        metric_join.jaccard_components(docs),
        suffixes.substring_dedup(docs),
        token_counts.count_tokens(docs, paths("byte_bpe_50k.json"), workspace(spark, "cache")),
        token_counts.count_tokens(docs, paths("byte_bpe_50k.json"), workspace(spark, "cache"), id_column="a.b"),
    ):
        assert out.count() == 8
    assert token_output.packed_rows(docs.coalesce(1), paths("byte_bpe_50k.json")).count() == 1
    sharding.write_shards(sharding.assign_shards(docs, ["a", "b"]).select(F.struct("doc_id").alias("only"), "shard"), str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == 8


def test_without_keeps_whole_characters():
    text = "aé漢b😀c"
    size = len(text.encode())
    for start in range(size):
        for stop in range(start + 1, size + 1):
            left = chunk_dedup.without(text, [{"start": start, "stop": stop}])
            gone = [c for i, c in enumerate(text) if len(text[:i].encode()) >= start and len(text[: i + 1].encode()) <= stop]
            assert left == "".join(c for c in text if c not in gone)
