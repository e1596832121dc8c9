"""Driver queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, embedding_dedup, license_scan, mixing, quality, simhash, substring_dedup, token_output, toxicity, warc
from tessera.runtime import read_table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(read_table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_report(read_table(spark, sf_dir, "documents"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_dedup(read_table(spark, sf_dir, "documents"))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_dedup(read_table(spark, sf_dir, "embeddings"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(read_table(spark, sf_dir, "pages"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return out.drop("spans")


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read_table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")).drop("terms")


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.token_output(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_license_scan": op2_license_scan,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_embedding_near_dedup": op4_embedding_near_dedup,
    "op5_warc": op5_warc,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_mix_sources": op7_mix_sources,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_toxicity": op9_toxicity,
    "op10_token_output": op10_token_output,
}

OP6_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bp AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, array_to_string(w[s:s + 9], ' ') AS t, least(len(w), 10) AS n FROM bp),
dp AS (SELECT rid, doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d CROSS JOIN (SELECT DISTINCT n FROM bw) WHERE len(w) >= n),
hit AS (SELECT dp.rid, dp.s, dp.n, bw.item_id FROM dp JOIN bw ON bw.n = dp.n AND bw.t = array_to_string(dp.w[dp.s:dp.s + dp.n - 1], ' ')),
pos AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM hit) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, sha256(string_agg(i, ',' ORDER BY i)) AS h FROM (SELECT DISTINCT rid, item_id::VARCHAR AS i FROM hit) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (rid) LEFT JOIN its USING (rid)
"""

OP7_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5(concat_ws(':', '42', coalesce(doc_id::VARCHAR, ''), md5(coalesce(text, '')))), 1, 6))::BIGINT AS draw FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS weight, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rk FROM s),
c AS (SELECT *, source_size * 3 AS cap, (source_size * 3)::DOUBLE / weight AS ratio FROM r),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY ratio, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(weight) OVER (ORDER BY ratio, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM c),
t AS (SELECT source, source_size, CASE WHEN level >= ratio THEN cap::DOUBLE ELSE weight * max(CASE WHEN level < ratio THEN level END) OVER () END AS target FROM l),
n AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
g AS (SELECT source, draw, sum(size)::BIGINT AS words FROM d GROUP BY source, draw),
k AS (SELECT source, draw, words, sum(words) OVER (PARTITION BY source ORDER BY draw) - words AS before FROM g),
x AS (SELECT k.source, k.draw, k.before + k.words / 2.0 <= n.target - n.whole * n.source_size AS more FROM k JOIN n ON k.source IS NOT DISTINCT FROM n.source)
SELECT d.doc_id, d.size, n.source_size, n.target, (d.size * (n.whole + CASE WHEN x.more THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN n ON d.source IS NOT DISTINCT FROM n.source JOIN x ON d.source IS NOT DISTINCT FROM x.source AND d.draw = x.draw
"""

OP4_SQL = r"""
WITH RECURSIVE r AS (SELECT row_number() OVER () AS rid, vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
u AS (SELECT rid, vec_id, label, v FROM r
    WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
p AS (SELECT a.rid AS x, b.rid AS y FROM u a JOIN u b ON a.label = b.label AND len(a.v) = len(b.v) AND a.rid < b.rid
    WHERE list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v)) >= 0.93),
e AS (SELECT x, y FROM p UNION ALL SELECT y, x FROM p),
c(rid, seen) AS (SELECT rid, rid FROM r UNION SELECT e.x, c.seen FROM e JOIN c ON c.rid = e.y),
m AS (SELECT c.rid, min(s.vec_id) AS component_id FROM c JOIN r s ON s.rid = c.seen GROUP BY c.rid),
n AS (SELECT x AS rid, count(*) AS n FROM e GROUP BY x)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM r JOIN m USING (rid) LEFT JOIN n USING (rid)
"""

OP5_SQL = r"""
WITH b AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
h AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS hex FROM b),
g AS (SELECT *, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(hex, (i * 5 // 4 + 1)::INT, 2) || '0')::INT >> (7 - i * 5 % 4)::INT) & 31) + 1, 1)), '') AS payload_digest,
    max(page_id) OVER (PARTITION BY hex, payload_bytes) AS latest FROM h)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id < latest THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id < latest THEN latest END AS refers_to
FROM g
"""

ORACLE_SQL: dict[str, str] = {
    "op4_embedding_near_dedup": OP4_SQL,
    "op5_warc": OP5_SQL,
    "op6_benchmark_decontamination": OP6_SQL,
    "op7_mix_sources": OP7_SQL,
}
