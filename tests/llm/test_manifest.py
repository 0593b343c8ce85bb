"""The Merkle manifest against a tree built by hand."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fieldspark.llm import manifest
from fieldspark.llm.common import workspace
from fieldspark.llm.queries import MANIFEST_COLUMNS, QUERIES

DIRECTORY = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "source", "lang", "key", "text"]


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(digests, fanout):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i : i + fanout]) for i in range(0, len(out[-1]), fanout)])
    return out


def ascend(tree, place, digest, fanout):
    siblings = []
    for level in tree[:-1]:
        start = place - place % fanout
        before, after = level[start:place], level[place + 1 : start + fanout]
        siblings += before + after
        digest = sha(*before, digest, *after)
        place //= fanout
    return siblings, digest


def by_hand(rows, fanout=2):
    """Result rows for (id, group, leaf, presented)."""
    groups = defaultdict(list)
    for row in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2])):
        groups[row[1]].append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [levels([r[2] for r in groups[g]], fanout) for g in names]
    top = levels([t[-1][0] for t in trees], fanout) if trees else []
    out = []
    for place, name in enumerate(names):
        for i, (id_, _, own, presented) in enumerate(groups[name]):
            below, folded = ascend(trees[place], i, presented, fanout)
            above, folded = ascend(top, place, folded, fanout)
            root = top[-1][0]
            out.append((id_, own, trees[place][-1][0], root, sha(*below, *above), folded, folded == root))
    return sorted(out, key=str)


def found(climbed):
    names = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in climbed.select(*names).collect()), key=str)


@pytest.mark.parametrize("block, fanout", [(1024, 2), (2, 2), (4, 2), (64, 3), (3, 3)])
@pytest.mark.parametrize("name", ["odd", "crowd", "empty"])
def test_climb_equals_hand_built_tree(spark, request, monkeypatch, name, block, fanout):
    if name == "crowd" and block < 64:
        pytest.skip("many hops over many rows are covered by the other table")
    monkeypatch.setattr(manifest, "BLOCK", block)
    docs = request.getfixturevalue(name).withColumn("presented", F.lit("a clashing column"))
    built = manifest.build_manifest(docs, COLUMNS, "lang", workspace(spark, "manifest"), fanout=fanout)
    rows = [(r.doc_id, r.lang, own := leaf([r[c] for c in COLUMNS]), own) for r in docs.collect()]
    assert found(manifest.climb(built)) == by_hand(rows, fanout)


@pytest.mark.parametrize("count", [1, 2, 3, 17, 70])
def test_every_size_of_many_groups(spark, monkeypatch, count):
    monkeypatch.setattr(manifest, "BLOCK", 4)
    docs = spark.range(count).selectExpr("id AS doc_id", "cast(id % 9 AS string) AS lang", "concat('t', id) AS text")
    built = manifest.build_manifest(docs, ["doc_id", "text"], "lang", workspace(spark, "manifest"))
    rows = [(i, str(i % 9), own := leaf([i, f"t{i}"]), own) for i in range(count)]
    assert found(manifest.climb(built)) == by_hand(rows)


def test_shards_repeat_the_path_above_them(spark, monkeypatch):
    """No key of the climb meets the leaves of more than one shard, however large its group is."""
    monkeypatch.setattr(manifest, "BLOCK", 2)
    docs = spark.range(100).selectExpr("id AS doc_id", "'a' AS lang", "'t' AS text")
    built = manifest.build_manifest(docs, ["doc_id", "text"], "lang", workspace(spark, "manifest"))
    per_hop = {r.hop: r["count"] for r in built.nodes.groupBy("hop").count().collect()}
    assert {per_hop[h] for h in range(1, 7)} == {50}
    assert found(manifest.climb(built)) == by_hand([(i, "a", own := leaf([i, "t"]), own) for i in range(100)])


def test_a_changed_row_is_found_and_nothing_else(spark, unique):
    docs = unique.where("lang is not null")
    presented = manifest.digest_of(COLUMNS, {"text": F.when(F.col("doc_id") == 2, "changed").otherwise(F.col("text"))})
    built = manifest.build_manifest(docs, COLUMNS, "lang", workspace(spark, "manifest"), keep={"presented": presented})
    climbed = manifest.climb(built, "presented", siblings=True).collect()
    assert [r.id for r in climbed if not r.verified] == [2]
    assert all(r.proof_sha256 == sha(r.siblings) for r in climbed)


def test_row_limit_of_the_session_is_put_back(spark, odd):
    before = spark.conf.get(manifest.ROW_LIMIT)
    manifest.climb(manifest.build_manifest(odd, COLUMNS, "lang", workspace(spark, "manifest")))
    assert spark.conf.get(manifest.ROW_LIMIT) == before


def test_query_equals_hand_built_tree(spark):
    rows = []
    for r in spark.read.parquet(f"{DIRECTORY}/documents.parquet").collect():
        values = [r[c] for c in MANIFEST_COLUMNS]
        own = leaf(values)
        if zlib.crc32(str(r.doc_id).encode()) % 7 == 0 and r.n_chars is not None:
            values[3] += 1
        rows.append((r.doc_id, r.lang, own, leaf(values)))
    assert found(QUERIES["op11_merkle_climb"](spark, DIRECTORY).withColumnRenamed("doc_id", "id")) == by_hand(rows)
