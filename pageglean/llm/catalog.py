"""Registered queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import DataFrame, SparkSession

from pageglean.llm import bpe, fingerprints, jaccard_join, language, mixing, pii, prefix_trie, quality, resampling, shards, simhash, substrings, topk

TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Python workers are told where this package is, as the entry module tells the driver."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment
    if root not in known.get("PYTHONPATH", "").split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join(x for x in (known.get("PYTHONPATH", ""), root) if x)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark, sf):
    posterior = mixing.mix(table(spark, sf, "documents"), table(spark, sf, "labels"))
    shares = [posterior["posterior"][k].alias(f"p_{name}") for k, name in enumerate(mixing.DOMAINS)]
    return posterior.select("doc_id", "n_tokens", *shares, "rate", "copies")


def op2_substrings(spark, sf):
    return substrings.remove_repeats(table(spark, sf, "documents"))


def op3_topk(spark, sf):
    return topk.top_k(table(spark, sf, "embeddings"))


def op4_language(spark, sf):
    return language.identify(table(spark, sf, "documents"))


def op5_shards(spark, sf):
    return shards.shard_documents(table(spark, sf, "documents"))


def op6_quality(spark, sf):
    return quality.grade_documents(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op7_jaccard_join(spark, sf):
    return jaccard_join.near_duplicates(table(spark, sf, "documents"))


def op8_fingerprints(spark, sf):
    return fingerprints.fingerprint_documents(table(spark, sf, "documents"))


def op9_bpe(spark, sf):
    return bpe.encode_documents(table(spark, sf, "documents"), TOKENIZER)


def op10_pii(spark, sf):
    return pii.pseudonymize(table(spark, sf, "documents").select("doc_id", "text"), count_col="n_values")


def op11_simhash(spark, sf):
    return simhash.near_duplicates(table(spark, sf, "documents"))


def op12_prefix_trie(spark, sf):
    return prefix_trie.conversation_trie(table(spark, sf, "conversations"))


def op13_resampling(spark, sf):
    return resampling.resample(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


_TOP_K_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), r AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

_SUBSTRINGS_SQL = r"""
WITH w AS (
    SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') END AS words
    FROM documents
), p AS (
    SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS pos FROM w WHERE len(words) >= 13
), g AS (
    SELECT doc_id, pos, md5(array_to_string(words[pos:pos + 12], ' ')) AS gram FROM p
), first AS (
    SELECT gram, min(doc_id) AS least FROM g GROUP BY gram
), gone AS (
    SELECT DISTINCT g.doc_id, unnest(range(pos, pos + 13)) AS pos FROM g JOIN first USING (gram) WHERE least < g.doc_id
), lists AS (
    SELECT doc_id, list(pos) AS gone FROM gone GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
    sha256(array_to_string(CASE WHEN gone IS NULL THEN words
        ELSE list_transform(list_filter(range(1, len(words) + 1), lambda i: NOT list_contains(gone, i)), lambda i: words[i]) END, ' ')) AS kept_sha256
FROM w LEFT JOIN lists USING (doc_id)
"""


# crc32 of a text's UTF-8: the usual table, made by rule, folded over the bytes.
_CRC_TABLE = """crc AS MATERIALIZED (
    SELECT list(v ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), [1, 2, 3, 4, 5, 6, 7, 8]),
            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END) AS v
        FROM range(256) r(i))
)"""


def _crc32(text: str) -> str:
    digits = f"hex(encode({text}))"
    return f"""xor(CAST(4294967295 AS BIGINT), list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
        list_transform(range(0, octet_length(encode({text}))), lambda i: CAST('0x' || substr({digits}, CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT))),
        lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS INTEGER) + 1])))"""


_RESAMPLING_SQL = rf"""
WITH {_CRC_TABLE}, d AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), b AS (
    SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
    FROM benchmark
), dc AS (
    SELECT row, word, count(*) AS n FROM (SELECT row, unnest(words) AS word FROM d) GROUP BY ALL
), every AS (
    SELECT DISTINCT word FROM (SELECT word FROM dc UNION ALL SELECT word FROM b)
), h AS MATERIALIZED (
    SELECT word, {_crc32("word")} % 10000 AS bucket FROM every, crc
), s AS (
    SELECT bucket, sum(n) AS s FROM dc JOIN h USING (word) GROUP BY bucket
), t AS (
    SELECT bucket, count(*) AS t FROM b JOIN h USING (word) GROUP BY bucket
), sizes AS (
    SELECT (SELECT coalesce(sum(s), 0) FROM s) AS all_s, (SELECT coalesce(sum(t), 0) FROM t) AS all_t
), g AS (
    SELECT bucket, floor(1000 * ln((CAST(coalesce(t, 0) AS DOUBLE) + 1) * (CAST(all_s AS DOUBLE) + 10000)
        / ((CAST(s AS DOUBLE) + 1) * (CAST(all_t AS DOUBLE) + 10000)))) AS gain
    FROM s LEFT JOIN t USING (bucket), sizes
), w AS (
    SELECT row, CAST(floor(sum(n * gain) / sum(n)) AS BIGINT) AS weight FROM dc JOIN h USING (word) JOIN g USING (bucket) GROUP BY row
), scored AS (
    SELECT row, doc_id, CAST(len(words) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
        (CAST(CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS DOUBLE) + 0.5) / 4294967296))) AS BIGINT) AS score
    FROM d LEFT JOIN w USING (row)
), ranked AS (
    SELECT row, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, row) AS rank, count(*) OVER () AS total
    FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * total // 100 THEN rank END AS rank FROM scored LEFT JOIN ranked USING (row)
"""


_TRIE_SQL = rf"""
WITH {_CRC_TABLE}, t AS (
    SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos
    FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
), sizes AS (
    SELECT conv_id, count(*) AS n, conv_id - conv_id % 20 AS base FROM t GROUP BY conv_id
), c AS MATERIALIZED (
    SELECT s.conv_id, s.base, s.h, least(s.h, coalesce(b.n, 0)) AS taken
    FROM (SELECT *, {_crc32("CAST(conv_id AS VARCHAR)")} % 4 AS h FROM sizes, crc) s LEFT JOIN sizes b ON b.conv_id = s.base
), r AS (
    SELECT conv_id, pos - h + taken + 1 AS depth, role, text FROM t JOIN c USING (conv_id) WHERE pos >= h
    UNION ALL
    SELECT c.conv_id, pos + 1, role, text FROM t JOIN c ON t.conv_id = c.base AND t.pos < c.taken
), p AS MATERIALIZED (
    SELECT conv_id, depth, words, md5(string_agg(turn, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS key FROM (
        SELECT conv_id, depth, md5(length(role) || ':' || role || text) AS turn, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM r)
    UNION ALL
    SELECT conv_id, 0, 0, '' FROM c
), n AS MATERIALIZED (
    SELECT key, any_value(depth) AS depth, any_value(words) AS words, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs
    FROM (SELECT *, lag(key) OVER (PARTITION BY conv_id ORDER BY depth) AS up FROM p) GROUP BY key
), children AS (
    SELECT up AS key, count(*) AS n_children FROM n WHERE up IS NOT NULL GROUP BY up
), below AS (
    SELECT v.key, sum((n_convs - 1) * n.words) AS saved_tokens, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves
    FROM (SELECT DISTINCT a.key, b.key AS under FROM p a JOIN p b ON a.conv_id = b.conv_id AND b.depth >= a.depth) v
    JOIN n ON n.key = v.under LEFT JOIN children k ON k.key = v.under GROUP BY v.key
), ends AS (
    SELECT key, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
    FROM (SELECT conv_id, key, depth = max(depth) OVER (PARTITION BY conv_id) AS is_last FROM p) WHERE is_last GROUP BY key
)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
    CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM n LEFT JOIN n u ON u.key = n.up LEFT JOIN children k ON k.key = n.key JOIN below b ON b.key = n.key LEFT JOIN ends e ON e.key = n.key
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_mixing, op2_substrings, op3_topk, op4_language, op5_shards, op6_quality, op7_jaccard_join, op8_fingerprints, op9_bpe, op10_pii, op11_simhash, op12_prefix_trie, op13_resampling)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that SQL can express; the tests hold the others against plain versions."""
    return {"op2_substrings": _SUBSTRINGS_SQL, "op3_topk": _TOP_K_SQL, "op12_prefix_trie": _TRIE_SQL, "op13_resampling": _RESAMPLING_SQL}
