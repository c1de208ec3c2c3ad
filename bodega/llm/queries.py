"""The registered queries of the text operators, and SQL for those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bodega.llm import (
    conversation_repair,
    host_rules,
    language_id,
    main_text,
    packing,
    passages,
    periodic_runs,
    permutation_index,
    pieces,
    prob_minhash,
    quality_score,
    source_mix,
    url_filter,
)
from bodega.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

# Vocabulary files of public tokenizers; the folder lies on every machine.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")


def tokenizer(name: str) -> str:
    return f"{TOKENIZERS}/{name}"


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language and score of every document."""
    return language_id.identify(table(spark, sf_dir, "documents"))


def op2_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage that a document repeats from another."""
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every text, their digests, and the bytes of text their spans cover."""
    return pieces.digest_table(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op4_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of the quality rules on every document."""
    return host_rules.host_rules(table(spark, sf_dir, "documents")).drop("host_rate")


def op5_prob_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return prob_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return main_text.main_text(table(spark, sf_dir, "pages"))


def op7_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20."""
    return permutation_index.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document and its place in the packed sequences."""
    return packing.pack_documents(
        table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("byte_bpe_50k.tiktoken"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's url."""
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), url_filter.rule_table(spark))


def op10_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality_score.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, and its source's target."""
    return source_mix.mixed(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after the planted damage."""
    return conversation_repair.repair_damaged(table(spark, sf_dir, "conversations"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document after the planted repeats."""
    return periodic_runs.run_digests(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_language_id": op1_language_id,
    "op2_passages": op2_passages,
    "op3_pieces": op3_pieces,
    "op4_host_rules": op4_host_rules,
    "op5_prob_minhash": op5_prob_minhash,
    "op6_main_text": op6_main_text,
    "op7_permutation_index": op7_permutation_index,
    "op8_packing": op8_packing,
    "op9_url_filter": op9_url_filter,
    "op10_quality_score": op10_quality_score,
    "op11_source_mix": op11_source_mix,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE: dict[str, str] = {
    "op4_host_rules": r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT r, w, generate_subscripts(w, 1) AS i FROM (
    SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs) WHERE len(w) >= 3),
windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS n FROM words WHERE i + 2 <= len(w)),
repeats AS (
  SELECT r, count(DISTINCT i + k) AS n FROM windows, (VALUES (0), (1), (2)) AS s(k) WHERE n > 1 GROUP BY r),
lines AS (
  SELECT r, sum(n - 1) AS n FROM (
    SELECT r, line, count(*) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r, line) GROUP BY r),
stats AS (
  SELECT r, doc_id, source, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS n_words,
    len(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
    CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words
  FROM docs LEFT JOIN lines USING (r) LEFT JOIN repeats USING (r)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM stats),
hosts AS (
  SELECT source, CAST(count(*) AS DOUBLE) AS n, CAST(sum(CAST(base_failed AS INT)) AS DOUBLE) AS failed
  FROM judged WHERE source IS NOT NULL GROUP BY source),
sums AS (
  SELECT sum(n) AS n, sum(failed) / sum(n) AS mean, count(*) AS hosts, sum(failed * failed / n) / sum(n) AS s2 FROM hosts),
moments AS (
  SELECT n, mean, mean * (1 - mean) AS drawn, s2 - mean * mean - mean * (1 - mean) * hosts / n AS spread FROM sums),
prior AS (
  SELECT mean, CASE WHEN drawn <= 0 OR spread <= drawn / (n + 1) THEN n ELSE greatest(drawn / spread - 1, 1) END AS weight
  FROM moments),
verdicts AS (
  SELECT source, (failed + mean * weight) / (n + weight) > 0.5 AS bad FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(bad, false) AS kept
FROM judged LEFT JOIN verdicts USING (source)
""",
    "op9_url_filter": r"""
WITH urls AS (
  SELECT page_id, coalesce(substr(url, nullif(instr(url, '://'), 0) + 3), '') AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM urls),
rules(host, path, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
best AS (
  SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict
  FROM parts p LEFT JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM best
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST) = 1
""",
    "op11_source_mix": r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS digest FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS n,
    [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM docs GROUP BY source),
rates AS (
  SELECT n, w, 2.0 * n / w AS reach,
    (1.5 * sum(n) OVER () - coalesce(sum(2.0 * n) OVER (filled ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(w) OVER (filled ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
  FROM sources WINDOW filled AS (ORDER BY 2.0 * n / w, source)),
goals AS (
  SELECT source, n, least(2.0 * n, w * (SELECT arg_min(CAST(rate AS DOUBLE), reach) FROM rates WHERE 2.0 * n >= rate * w)) AS target
  FROM sources),
laid AS (
  SELECT doc_id, size, goals.n, CAST(target AS DOUBLE) AS target, round(target) AS quota,
    sum(size) OVER (PARTITION BY docs.source ORDER BY digest ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS until
  FROM docs JOIN goals ON docs.source IS NOT DISTINCT FROM goals.source)
SELECT doc_id, size, n AS source_size, target,
  CAST(greatest(0, least(until, quota) - (until - size)) + greatest(0, least(n + until, quota) - (n + until - size)) AS BIGINT) AS taken
FROM laid
""",
}
