"""The operators bound to the tables of a data directory, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .embedding_dedup import near_vectors
from .html_extract import extract_pages
from .line_dedup import dedup_lines
from .mixing import mix_sources
from .mtree import top_inner
from .pieces import encode_texts
from .quality import quality_report
from .secrets import scan_secrets
from .simhash import hexed, simhash_groups
from .substring_dedup import dedup_substrings, kept_digest


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents").select("doc_id", "source"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept_digest(dedup_substrings(_table(spark, sf_dir, "documents")))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hexed(simhash_groups(_table(spark, sf_dir, "documents")))


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_inner(_table(spark, sf_dir, "embeddings"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(_table(spark, sf_dir, "documents"))


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(_table(spark, sf_dir, "pages"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_tokens", "token_ids", "round_trip")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (op1_line_dedup, op2_mix_sources, op3_embedding_dedup, op4_substring_dedup, op5_simhash_dedup, op6_exact_top_k, op7_quality, op8_secret_scan, op9_html_extract, op10_sentencepiece)
    return {f.__name__: f for f in ops}


_OP2 = """
WITH RECURSIVE counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
weights AS (SELECT source, greatest(1, CAST(floor(100 * sqrt(n / (SELECT max(n) FROM counts))) AS BIGINT)) AS w FROM counts),
listed AS (SELECT source, w, row_number() OVER (ORDER BY -w, source IS NOT NULL, source) AS i FROM weights),
total AS (SELECT list(w ORDER BY i) AS ws, CAST(sum(w) AS BIGINT) AS period, count(*) AS k FROM listed),
picks(t, served, pick) AS (
  SELECT CAST(0 AS BIGINT), list_transform(ws, lambda w: CAST(0 AS BIGINT)), CAST(0 AS BIGINT) FROM total WHERE k > 0
  UNION ALL
  SELECT t + 1, list_transform(served, lambda n, i: CASE WHEN i = best THEN n + 1 ELSE n END), best
  FROM (SELECT t, served, period, list_min(list_filter(list_transform(ws, lambda w, i: CASE WHEN served[i] < w AND served[i] * period // w <= t THEN ((served[i] + 1) * period + w - 1) // w * 100000 + i END), lambda x: x IS NOT NULL)) % 100000 AS best
        FROM picks, total WHERE t < period)),
slots AS (SELECT pick AS i, t - 1 AS slot, row_number() OVER (PARTITION BY pick ORDER BY t) AS j FROM picks WHERE t > 0),
numbered AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id) - 1 AS rn FROM documents)
SELECT doc_id, n.source, rn // 64 AS block, (rn // 64) // w * period + slot AS slot, ((rn // 64) // w * period + slot) * 64 + rn % 64 AS position
FROM numbered n JOIN listed l ON n.source IS NOT DISTINCT FROM l.source CROSS JOIN total JOIN slots s ON s.i = l.i AND s.j = (rn // 64) % w + 1
"""

_VECTORS = """SELECT vec_id, label, embedding, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0"""

_OP3 = f"""
WITH RECURSIVE fine AS (SELECT vec_id, label, v, sqrt(list_inner_product(v, v)) AS n FROM ({_VECTORS}) WHERE label IS NOT NULL AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_inner_product(a.v, b.v) / (a.n * b.n) >= 0.93),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN low USING (vec_id) LEFT JOIN n USING (vec_id)
"""

_OP4 = r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
pos AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13 AND doc_id IS NOT NULL),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k FROM pos),
low AS (SELECT k, min(doc_id) AS first_doc FROM win GROUP BY k),
cut AS (SELECT doc_id, list(DISTINCT p) AS gone FROM (SELECT doc_id, unnest(range(i, i + 13)) AS p FROM win JOIN low USING (k) WHERE first_doc < doc_id) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN ws ELSE list_transform(list_filter(range(1, len(ws) + 1), lambda p: NOT list_contains(gone, p)), lambda p: ws[p]) END, ' ')) AS kept_sha256
FROM w LEFT JOIN cut USING (doc_id)
"""

_OP6 = f"""
WITH q AS (SELECT vec_id, list_transform(v, lambda x: CAST(floor(256 * x) AS BIGINT)) AS z FROM ({_VECTORS})),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(CAST(a.z AS DOUBLE[]), CAST(b.z AS DOUBLE[])) AS BIGINT) AS score FROM q a JOIN q b ON a.vec_id <> b.vec_id AND len(a.z) = len(b.z) WHERE a.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_mix_sources": _OP2, "op3_embedding_dedup": _OP3, "op4_substring_dedup": _OP4, "op6_exact_top_k": _OP6}
