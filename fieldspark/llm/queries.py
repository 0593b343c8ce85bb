"""The registered queries of this subpackage and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.llm import alignment, best_fit, chunk_dedup, content_sort, decontaminate, language, license_scan, manifest, metric_join, sharding, suffixes, token_counts, token_output
from fieldspark.llm.common import workspace

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def documents(spark: SparkSession, directory: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/documents.parquet")


@_query(
    "op10_content_sort",
    """
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
)
def op10(spark: SparkSession, directory: str) -> DataFrame:
    return content_sort.exact_groups(documents(spark, directory))


@_query("op6_token_counts")
def op6(spark: SparkSession, directory: str) -> DataFrame:
    cache = workspace(spark, "token_cache")
    return token_counts.count_tokens(documents(spark, directory), public_tokenizers.path("byte_bpe_50k.json"), cache)


@_query("op3_best_fit")
def op3(spark: SparkSession, directory: str) -> DataFrame:
    return best_fit.pack_documents(documents(spark, directory), public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end_id=0)


@_query("op7_token_output")
def op7(spark: SparkSession, directory: str) -> DataFrame:
    """Packed matrices; the ids are shown by their CRC-32 and the rows by their document pieces."""
    rows = token_output.packed_rows(documents(spark, directory), public_tokenizers.path("byte_bpe_50k.json"), 2048, end_id=50256)
    return rows.select(
        "sequence_id", "n_tokens", F.crc32("input_ids").alias("ids_crc32"), F.crc32("position_ids").alias("positions_crc32"),
        "cu_seqlens", "doc_ids", "pieces", "starts",
    )


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all(coalesce({_LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@_query(
    "op9_positional_index",
    rf"""
    WITH docs AS (
        SELECT doc_id, {_WORDS} AS w FROM documents
    ), places AS (
        SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM docs
    ), counts AS (
        SELECT word, count(*) AS n FROM places GROUP BY word
    ), items AS (
        SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL
    ), started AS (
        SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM items WHERE len(w) > 0
    ), windows AS (
        SELECT DISTINCT item, list_slice(w, k, least(k + 9, len(w))) AS ws FROM started
    ), exact AS (
        SELECT DISTINCT p.doc_id, x.item, p.i, len(x.ws) AS size FROM windows x JOIN places p ON p.word = x.ws[1] JOIN docs d ON d.doc_id = p.doc_id
        WHERE list_slice(d.w, p.i, p.i + len(x.ws) - 1) = x.ws
    ), hits AS (
        SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM exact) GROUP BY doc_id
    ), found AS (
        SELECT doc_id, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS ids FROM exact GROUP BY doc_id
    ), distinct_windows AS (
        SELECT DISTINCT ws FROM windows
    ), terms AS (
        SELECT ws, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS k FROM distinct_windows
    ), rarest AS (
        SELECT ws, arg_min(word, (n, k)) AS word FROM terms JOIN counts USING (word) GROUP BY ws HAVING count(*) = len(ws)
    ), close_by AS (
        -- around a place of a window's rarest word: those of its words that stand at most the window's length and 5 words away
        SELECT DISTINCT r.ws, p.doc_id, p.i, t.k FROM rarest r JOIN places p ON p.word = r.word JOIN terms t ON t.ws = r.ws
        JOIN places q ON q.doc_id = p.doc_id AND q.word = t.word AND abs(q.i - p.i) <= len(r.ws) - 1 + 5
    ), near AS (
        SELECT doc_id, count(DISTINCT item) AS n_near FROM (SELECT ws, doc_id, i FROM close_by GROUP BY ALL HAVING count(*) = len(ws)) c JOIN windows USING (ws) GROUP BY doc_id
    )
    SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(f.n_items, 0) AS n_items, sha256(coalesce(f.ids, '')) AS items_sha256,
           coalesce(n.n_near, 0) AS n_near_items, coalesce(h.n_hit, 0) > 0 AS contaminated
    FROM docs d LEFT JOIN hits h USING (doc_id) LEFT JOIN found f USING (doc_id) LEFT JOIN near n USING (doc_id)
    """,
)
def op9(spark: SparkSession, directory: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{directory}/benchmark.parquet")
    return decontaminate.contamination(decontaminate.benchmark_matches(documents(spark, directory), benchmark))


def held_out():
    """True for the documents whose labels are never learned from."""
    return F.pmod(F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(0)), F.lit(3)) == 1


def language_model(docs: DataFrame) -> bytes:
    return language.fit(docs.where(~held_out()))


@_query("op4_context_trees")
def op4(spark: SparkSession, directory: str) -> DataFrame:
    docs = documents(spark, directory)
    named = language.identify(docs.select("doc_id", "text"), language_model(docs))
    return named.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@_query(
    "op5_metric_join",
    rf"""
    WITH RECURSIVE worded AS (
        SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
    ), sets AS (
        SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
                            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
        FROM worded
    ), sizes AS (
        SELECT doc_id, len(s) AS n FROM sets
    ), shingles AS (
        SELECT doc_id, unnest(s) AS shingle FROM sets
    ), common AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL
    ), links AS (
        SELECT c.a, c.b FROM common c JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b WHERE 100 * c.n >= 90 * (x.n + y.n - c.n)
    ), reached AS (
        SELECT doc_id, doc_id AS other FROM sizes
        UNION
        SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.other = l.a
    )
    SELECT doc_id, n AS n_shingles, min(other) AS component_id FROM reached JOIN sizes USING (doc_id) GROUP BY doc_id, n
    """,
)
def op5(spark: SparkSession, directory: str) -> DataFrame:
    return metric_join.jaccard_components(documents(spark, directory), width=3, percent=90)


@_query("op1_chunk_dedup")
def op1(spark: SparkSession, directory: str) -> DataFrame:
    return chunk_dedup.chunk_repeats(documents(spark, directory))


#: Shards of the registered query.
SHARDS = [f"shard-{i:03d}" for i in range(256)]


@_query("op2_lookup_table")
def op2(spark: SparkSession, directory: str) -> DataFrame:
    return sharding.assign_shards(documents(spark, directory).select("doc_id"), SHARDS)


@_query("op8_suffix_sort")
def op8(spark: SparkSession, directory: str) -> DataFrame:
    return suffixes.substring_dedup(documents(spark, directory)).drop("removed")


#: Columns of the registered manifest, in the order of its leaves.
MANIFEST_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def _sql_leaf(n_chars: str) -> str:
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", f"CAST({n_chars} AS VARCHAR)", "text"]
    shown = [f"coalesce(CAST(octet_length(encode({f})) AS VARCHAR) || ':' || {f}, '-')" for f in fields]
    return f"sha256({' || '.join(shown)})"


@_query(
    "op11_merkle_climb",
    f"""
    WITH RECURSIVE summed AS (
        -- CRC-32 of the decimal identifier: each byte is mixed in, then shifted out bit by bit (-1 stands for a shift)
        SELECT *, xor(list_reduce(
                list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
                lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384::BIGINT * (c & 1)) END), 4294967295::BIGINT) AS crc
        FROM documents
    ), leaves AS (
        SELECT doc_id, lang, {_sql_leaf("n_chars")} AS leaf, {_sql_leaf("n_chars + CASE WHEN crc % 7 = 0 THEN 1 ELSE 0 END")} AS presented FROM summed
    ), placed AS (
        SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS part, row_number() OVER (PARTITION BY lang ORDER BY doc_id, leaf) - 1 AS position,
               count(*) OVER (PARTITION BY lang) AS n
        FROM leaves
    ), built AS (
        SELECT part, 0 AS level, position, leaf AS digest, n FROM placed
        UNION ALL
        SELECT part, level + 1, position // 2, sha256(string_agg(digest, '' ORDER BY position)), (n + 1) // 2
        FROM built WHERE n > 1 GROUP BY part, level, position // 2, n
    ), subroots AS (
        SELECT part, level AS height, digest AS subroot FROM built WHERE n = 1
    ), topped AS (
        SELECT 0 AS level, part AS position, subroot AS digest, (SELECT count(*) FROM subroots) AS n FROM subroots
        UNION ALL
        SELECT level + 1, position // 2, sha256(string_agg(digest, '' ORDER BY position)), (n + 1) // 2 FROM topped WHERE n > 1 GROUP BY level, position // 2, n
    ), nodes AS (
        SELECT part, level, position, digest, n FROM built WHERE n > 1
        UNION ALL
        SELECT s.part, s.height + t.level, t.position + 1099511627776, t.digest, t.n FROM subroots s, topped t WHERE t.n > 1
    ), climb AS (
        SELECT p.doc_id, p.part, 0 AS level, CASE WHEN p.n = 1 THEN p.part + 1099511627776 ELSE p.position END AS position, p.leaf, p.presented AS folded, '' AS siblings, s.height FROM placed p JOIN subroots s USING (part)
        UNION ALL
        SELECT c.doc_id, c.part, c.level + 1,
               CASE WHEN c.level + 1 = c.height THEN c.part + 1099511627776 WHEN c.position >= 1099511627776 THEN (c.position - 1099511627776) // 2 + 1099511627776 ELSE c.position // 2 END,
               c.leaf,
               CASE WHEN c.position % 2 = 1 THEN sha256(o.digest || c.folded) ELSE sha256(c.folded || coalesce(o.digest, '')) END,
               c.siblings || coalesce(o.digest, ''), c.height
        FROM climb c JOIN nodes m ON m.part = c.part AND m.level = c.level AND m.position = c.position
        LEFT JOIN nodes o ON o.part = c.part AND o.level = c.level AND o.position = xor(c.position, 1)
    )
    SELECT c.doc_id, c.leaf, s.subroot, t.digest AS root, sha256(c.siblings) AS proof_sha256, c.folded AS folded_root, c.folded = t.digest AS verified
    FROM climb c JOIN subroots s ON c.part = s.part JOIN topped t ON t.n = 1 AND c.level = s.height + t.level
    """,
)
def op11(spark: SparkSession, directory: str) -> DataFrame:
    docs = documents(spark, directory)
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    presented = manifest.digest_of(MANIFEST_COLUMNS, {"n_chars": F.col("n_chars") + tampered.cast("long")})
    built = manifest.build_manifest(docs, MANIFEST_COLUMNS, "lang", workspace(spark, "manifest"), keep={"presented": presented})
    return manifest.climb(built, "presented").withColumnRenamed("id", "doc_id")


@_query("op12_identity_alignment")
def op12(spark: SparkSession, directory: str) -> DataFrame:
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align_tokenizers(documents(spark, directory), a, b).documents


@_query("op13_fuzzy_notices")
def op13(spark: SparkSession, directory: str) -> DataFrame:
    return license_scan.summary(license_scan.scan_licenses(documents(spark, directory)))
