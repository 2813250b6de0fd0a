"""The queries op1 to op13 and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeforge.llm import exact, html, licenses, packing, passages, pieces, pii, quality, sharding, simhash, toxicity, trie, whitening
from placeforge.llm.common import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.shared_passages(table(spark, sf_dir, "documents"))


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pieces.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("detections")


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.kd_shards(table(spark, sf_dir, "documents"), n_shards=16)
    return shards.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(trie.spliced(trie.turn_lists(table(spark, sf_dir, "conversations"))))


QUERIES = {f.__name__: f for f in (op1_quality, op2_html, op3_simhash, op4_exact_dedup, op5_packing, op6_toxicity, op7_passages, op8_pii, op9_pieces, op10_licenses, op11_sharding, op12_whitening, op13_trie)}

ORACLE_SQL = {
    "op4_exact_dedup": r"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM n WINDOW w AS (PARTITION BY text_sha256)""",
    "op13_trie": r"""
WITH own AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS k, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
all_ids AS (SELECT DISTINCT c FROM own),
heads AS (SELECT c, c - c % 5 AS base, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ord(x)::BIGINT)), lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda v, z: xor(v // 2, (v % 2) * 3988292384)))) % 9 AS h FROM all_ids),
taken AS (SELECT h.c, o.k, o.role, o.text FROM heads h JOIN own o ON o.c = h.base AND o.k <= h.h UNION ALL SELECT h.c, o.k + 8, o.role, o.text FROM heads h JOIN own o ON o.c = h.c AND o.k > h.h),
turns AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY k) AS d, sha256(length(role) || ':' || role || text) AS id, strlen(text) AS size FROM taken),
lists AS (SELECT i.c, coalesce(t.ids, []) AS ids, coalesce(t.sizes, []) AS sizes FROM all_ids i LEFT JOIN (SELECT c, list(id ORDER BY d) AS ids, list(size ORDER BY d) AS sizes FROM turns GROUP BY c) t USING (c)),
prefixes AS (SELECT c, d, sha256(array_to_string(ids[1:d], ',')) AS node, CASE WHEN d > 0 THEN sha256(array_to_string(ids[1:d - 1], ',')) END AS parent, CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size, d = len(ids) AS at_end FROM (SELECT c, ids, sizes, unnest(range(0, len(ids) + 1)) AS d FROM lists)),
nodes AS (SELECT node, d, any_value(parent) AS parent, min(c) AS conv_id, count(*) AS n_convs, any_value(size) AS size, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE at_end), '')) AS ends_sha256 FROM prefixes GROUP BY node, d),
children AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
named AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN children k USING (node)),
sums AS (SELECT p.node, sum(CASE WHEN n.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n.n_convs - 1) * n.size) AS saved_tokens FROM named n JOIN prefixes p ON p.c = n.conv_id AND p.d <= n.d GROUP BY p.node)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM named n JOIN sums s USING (node) LEFT JOIN nodes p ON p.node = n.parent""",
}
