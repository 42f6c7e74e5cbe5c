"""The registered queries: each applies an operator to its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import bytepairs, chosenpath, fingerprint, importance, licenses, maintext, mixing, pieces, pivots, repair, topk, toxicity, warc
from plumbline.llm.registry import query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_repair_tokens")
def op1(spark, sf_dir):
    return repair.token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op2_source_mix")
def op2(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "shard")


@query("op3_chosen_path_join")
def op3(spark, sf_dir):
    return chosenpath.similar(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


@query("op4_arc_to_warc")
def op4(spark, sf_dir):
    return warc.converted(table(spark, sf_dir, "pages"))


@query("op6_merge_dropout")
def op6(spark, sf_dir):
    """Ids of every text under seeded dropout, whether they decode to the text, and how many there are."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.round_trip(table(spark, sf_dir, "documents"), model)


@query("op7_one_permutation")
def op7(spark, sf_dir):
    return fingerprint.edited_fingerprints(table(spark, sf_dir, "documents"))


@query("op8_kneser_ney_toxicity")
def op8(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP10_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.e, d.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id AND len(q.e) = len(d.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op10_block_topk", OP10_SQL)
def op10(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0)


@query("op9_license_scan")
def op9(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op5_main_text")
def op5(spark, sf_dir):
    return maintext.extract(table(spark, sf_dir, "pages"))


@query("op11_lazy_transducer")
def op11(spark, sf_dir):
    return bytepairs.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def _op12_sql() -> str:
    """CRC-32 by its table, a byte at a time, once for each distinct feature; buckets and gains follow from its counts."""
    return """
WITH crc_table AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda r, k: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END) ORDER BY i) AS t FROM range(256) x(i)),
texts AS (SELECT 'd' AS side, row_number() OVER () AS pos, doc_id, text FROM documents UNION ALL SELECT 'b', row_number() OVER (), NULL, text FROM benchmark),
words AS (
  SELECT side, pos, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
features AS (
  SELECT side, pos, unnest(w || list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM words),
counted AS (SELECT side, pos, f, count(*) AS n FROM features GROUP BY ALL),
bytes AS (
  SELECT f, list_transform(range(0, octet_length(encode(f))), lambda i: CAST('0x' || substr(hex(encode(f)), 2 * i + 1, 2) AS BIGINT)) AS b FROM (SELECT DISTINCT f FROM counted)),
buckets AS (
  SELECT f, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket FROM bytes, crc_table),
sides AS (SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 'b'), 0) AS t FROM counted JOIN buckets USING (f) GROUP BY bucket),
totals AS (SELECT coalesce(sum(s), 0) AS all_s, coalesce(sum(t), 0) AS all_t FROM sides),
gains AS (SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (all_s + 10000) AS DOUBLE) / CAST((s + 1) * (all_t + 10000) AS DOUBLE))) AS BIGINT) AS gain FROM sides, totals),
sums AS (SELECT pos, sum(n) AS n, sum(n * gain) AS g FROM counted JOIN buckets USING (f) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY pos),
weights AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features, CAST(coalesce((g - ((g % n) + n) % n) // n, 0) AS BIGINT) AS weight,
    CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) AS h
  FROM words LEFT JOIN sums USING (pos) WHERE side = 'd'),
scores AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM weights),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 AND score IS NOT NULL ORDER BY score DESC, doc_id, weight DESC, n_features DESC) AS place,
    count(*) FILTER (n_words >= 20) OVER () AS enters FROM scores)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CASE WHEN n_words >= 20 AND score IS NOT NULL AND place <= 25 * enters // 100 THEN place END AS rank FROM placed
"""


@query("op12_importance_resampling", _op12_sql())
def op12(spark, sf_dir):
    return importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _op13_sql(k: int = 40, rounds: int = 5) -> str:
    """Each round compares all centroids; the operator finds the same ones with fewer distances."""
    parts = [f"""
WITH kept AS (
  SELECT row_number() OVER () AS pos, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS c, v FROM kept QUALIFY c < {k})"""]
    for i in range(rounds + 1):
        parts.append(f"""
a{i} AS MATERIALIZED (
  SELECT pos, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT pos, c, CAST(list_sum(list_transform(list_zip(kept.v, c{i}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d FROM kept, c{i}) GROUP BY pos)""")
        if i < rounds:
            parts.append(f"""
m{i} AS (SELECT c, j, sum(x) AS s, count(*) AS n FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM a{i} JOIN kept USING (pos)) GROUP BY c, j),
n{i} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS v FROM m{i} GROUP BY c),
c{i + 1} AS MATERIALIZED (SELECT c{i}.c, coalesce(n{i}.v, c{i}.v) AS v FROM c{i} LEFT JOIN n{i} USING (c))""")
    return ",".join(parts) + f"""
SELECT vec_id, CAST(a{rounds}.c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a{rounds}.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN kept USING (pos) JOIN c{rounds} ON c{rounds}.c = a{rounds}.c
"""


@query("op13_pivot_clusters", _op13_sql())
def op13(spark, sf_dir):
    return pivots.clustered(table(spark, sf_dir, "embeddings"))
