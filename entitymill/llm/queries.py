"""The queries op1 to op13 and the pipeline, with their parameters and DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entitymill.llm import alignment, bpe, html, jpeg, lexical, lines, minhash, mixing, preference, quality, secrets, tokencount, vptree
from entitymill.llm.common import documents


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), k=4)


def op3_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return vptree.nearest(vectors, F.col("vec_id") % 50 == 0)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = preference.swapped_replies(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    shown = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return preference.format_pairs(pairs).withColumns({c: shown(c) for c in ("chosen_spans", "rejected_spans")})


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(documents(spark, sf_dir))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jpeg.digest_media(documents(spark, sf_dir))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op11_wand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_documents(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html": op1_html,
    "op2_minhash": op2_minhash,
    "op3_vptree": op3_vptree,
    "op4_quality": op4_quality,
    "op5_preference": op5_preference,
    "op6_mixing": op6_mixing,
    "op7_bpe": op7_bpe,
    "op8_jpeg": op8_jpeg,
    "op9_line_dedup": op9_line_dedup,
    "op10_token_counts": op10_token_counts,
    "op11_wand": op11_wand,
    "op12_alignment": op12_alignment,
    "op13_secrets": op13_secrets,
}

OP9_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (
  SELECT doc_id, pos, line,
         translate(trim(line, concat(' ', chr(9), chr(11), chr(12), chr(13))), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
s AS (
  SELECT key, min(doc_id) AS keeper FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
m AS (
  SELECT k.doc_id, k.pos, k.line, (s.key IS NOT NULL AND k.doc_id <> s.keeper) AS gone FROM k LEFT JOIN s ON k.key = s.key)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

OP3_SQL = """
WITH v AS (
  SELECT vec_id, min(CAST(embedding AS DOUBLE[])) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         list_dot_product(q.e, c.e) / (sqrt(list_dot_product(q.e, q.e)) * sqrt(list_dot_product(c.e, c.e))) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

_TURN = "'<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)"
_SPANS = """array_to_string(list_transform(list_filter(range(1, len({c}) + 1), lambda i: {c}[i].role = 'assistant'), lambda i:
  CAST(CAST(coalesce(list_sum(list_transform({c}[1:i - 1], lambda x: length({turn}))), 0) AS BIGINT) + 5 + length({c}[i].role) AS VARCHAR) || '-' ||
  CAST(CAST(list_sum(list_transform({c}[1:i], lambda x: length({turn}))) AS BIGINT) AS VARCHAR)), ',')"""
OP5_SQL = f"""
WITH t AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn, role, text) AS t FROM (SELECT *, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS own FROM conversations) GROUP BY conv_id, own),
p AS (
  SELECT a.conv_id AS pair_id, a.t AS c, list_concat(a.t[1:len(a.t) - 1], CASE WHEN b.t IS NULL THEN a.t[1:0] ELSE b.t[len(b.t):len(b.t)] END) AS r
  FROM t a LEFT JOIN t b ON b.conv_id = xor(a.conv_id, 1)),
n AS (
  SELECT *, coalesce(list_filter(range(1, least(len(c), len(r)) + 1), lambda i: c[i] IS DISTINCT FROM r[i])[1] - 1, least(len(c), len(r))) AS n FROM p),
s AS (SELECT pair_id, n, c[1:n] AS p, c[n + 1:len(c)] AS c, r[n + 1:len(r)] AS r FROM n)
SELECT pair_id, CAST(n AS INTEGER) AS n_prompt_turns, array_to_string(list_transform(p, lambda x: {_TURN}), '') AS prompt,
       array_to_string(list_transform(c, lambda x: {_TURN}), '') AS chosen, array_to_string(list_transform(r, lambda x: {_TURN}), '') AS rejected,
       {_SPANS.format(c="c", turn=_TURN)} AS chosen_spans, {_SPANS.format(c="r", turn=_TURN)} AS rejected_spans
FROM s
"""

_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP11_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents),
s AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(ts)) AS BIGINT) AS total FROM d WHERE len(ts) > 0),
i AS (SELECT row_number() OVER () AS i, item_id, list_distinct({_TERMS}) AS ts FROM benchmark),
q AS (SELECT i, item_id, unnest(ts) AS term FROM i),
p AS (
  SELECT r, doc_id, CAST(n AS BIGINT) AS n, term, CAST(count(*) AS BIGINT) AS tf
  FROM (SELECT r, doc_id, len(ts) AS n, unnest(ts) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM p, s GROUP BY term, docs),
f AS (
  SELECT i, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total)))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN p USING (term), s GROUP BY i, item_id, r, doc_id),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM f WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10
"""

ORACLES: dict[str, str] = {"op11_wand": OP11_SQL, "op5_preference": OP5_SQL, "op3_vptree": OP3_SQL, "op9_line_dedup": OP9_SQL}
