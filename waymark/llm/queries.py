"""One query for each operator, over the whole tables, and the SQL of those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from .. import session
from . import bpe, chat, decontaminate, html, pii, quality, simhash, substring, toxicity, urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.kept_digest(substring.remove_repeats(_table(spark, sf_dir, "documents")))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_table(spark, sf_dir, "documents"), keep_text=False)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_table(spark, sf_dir, "documents"))


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(_table(spark, sf_dir, "pages"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.recover(_table(spark, sf_dir, "conversations"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace(_table(spark, sf_dir, "documents")).select("doc_id", "n_entities", "kinds", "text")


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "score")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), p AS (
  SELECT doc_id, unnest(range(1, len(w) - 48)) AS s, w FROM d WHERE len(w) >= 50
), h AS (
  SELECT doc_id, s, sha256(array_to_string(w[s:s + 49], ' ')) AS k FROM p
), f AS (
  SELECT k, min(doc_id) AS least FROM h GROUP BY k
), c AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS i FROM h JOIN f USING (k) WHERE doc_id > least
), r AS (
  SELECT doc_id, list(i) AS gone FROM c GROUP BY doc_id
), k AS (
  SELECT doc_id, w, gone, i FROM d LEFT JOIN r USING (doc_id), unnest(range(1, len(w) + 1)) AS t(i)
  WHERE gone IS NULL OR NOT list_contains(gone, i)
), j AS (
  SELECT doc_id, string_agg(w[i], ' ' ORDER BY i) AS kept FROM k GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id) LEFT JOIN j USING (doc_id)
"""

OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), win AS (
  SELECT doc_id, s, array_to_string(w[s:s + 7], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS s FROM d)
), rep AS (
  SELECT doc_id, count(DISTINCT i) AS n FROM (
    SELECT doc_id, unnest(range(s, s + 8)) AS i FROM win SEMI JOIN (
      SELECT doc_id, k FROM win GROUP BY ALL HAVING count(*) > 1) AS t USING (doc_id, k))
  GROUP BY doc_id
), c AS (
  SELECT doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines
  FROM d LEFT JOIN rep USING (doc_id)
), m AS (
  SELECT *, n_symbols::DOUBLE / nullif(n_words, 0) AS a, n_dup_lines::DOUBLE / nullif(n_lines, 0) AS b, word_chars::DOUBLE / nullif(n_words, 0) AS e FROM c
), u AS (
  SELECT lang, source, unnest(['a', 'b', 'e']) AS k, unnest([a, b, e]) AS v FROM m WHERE n_words >= 20
), own AS (
  SELECT lang, source, k, any_value(c) AS n, max(v) FILTER (r = greatest(ceil(round(0.01 * c, 7)), 1)) AS q1, max(v) FILTER (r = greatest(ceil(round(0.1 * c, 7)), 1)) AS q2,
         max(v) FILTER (r = greatest(ceil(round(0.5 * c, 7)), 1)) AS q3, max(v) FILTER (r = ceil(round(0.9 * c, 7))) AS q4, max(v) FILTER (r = ceil(round(0.99 * c, 7))) AS q5
  FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, k ORDER BY v) AS r, count(*) OVER (PARTITION BY lang, source, k) AS c FROM u)
  GROUP BY lang, source, k
), wide AS (
  SELECT lang, k, max(v) FILTER (r = greatest(ceil(round(0.01 * c, 7)), 1)) AS q1, max(v) FILTER (r = greatest(ceil(round(0.1 * c, 7)), 1)) AS q2,
         max(v) FILTER (r = greatest(ceil(round(0.5 * c, 7)), 1)) AS q3, max(v) FILTER (r = ceil(round(0.9 * c, 7))) AS q4, max(v) FILTER (r = ceil(round(0.99 * c, 7))) AS q5
  FROM (SELECT *, row_number() OVER (PARTITION BY lang, k ORDER BY v) AS r, count(*) OVER (PARTITION BY lang, k) AS c FROM u)
  GROUP BY lang, k
), g AS (
  SELECT g.lang, g.source, wide.k, CASE WHEN own.n >= 100 THEN own.q1 ELSE wide.q1 END AS q1, CASE WHEN own.n >= 100 THEN own.q2 ELSE wide.q2 END AS q2,
         CASE WHEN own.n >= 100 THEN own.q3 ELSE wide.q3 END AS q3, CASE WHEN own.n >= 100 THEN own.q4 ELSE wide.q4 END AS q4, CASE WHEN own.n >= 100 THEN own.q5 ELSE wide.q5 END AS q5
  FROM (SELECT DISTINCT lang, source FROM m) AS g JOIN wide ON wide.lang IS NOT DISTINCT FROM g.lang
  LEFT JOIN own ON own.lang IS NOT DISTINCT FROM g.lang AND own.source IS NOT DISTINCT FROM g.source AND own.k = wide.k
), f AS (
  SELECT lang, source,
         max(q4 + 2::DOUBLE * (q4 - q3) + 0.1::DOUBLE * (q5 - q4)) FILTER (k = 'a') AS a_hi, max(q4 + 2::DOUBLE * (q4 - q3) + 0.75::DOUBLE * (q5 - q4)) FILTER (k = 'b') AS b_hi,
         max(q2 + 2::DOUBLE * (q2 - q3) + 0.25::DOUBLE * (q1 - q2)) FILTER (k = 'e') AS e_lo, max(q4 + 2::DOUBLE * (q4 - q3) + 0.25::DOUBLE * (q5 - q4)) FILTER (k = 'e') AS e_hi
  FROM g GROUP BY lang, source
), j AS (
  SELECT m.*, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
         a <= a_hi AND b <= b_hi AND e BETWEEN e_lo AND e_hi AS inside
  FROM m LEFT JOIN f ON f.lang IS NOT DISTINCT FROM m.lang AND f.source IS NOT DISTINCT FROM m.source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(inside, true) AS kept FROM j
"""


def _shipping(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        session.ship(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        "op1_substring_dedup": op1_substring_dedup,
        "op2_quality": op2_quality,
        "op3_bpe": op3_bpe,
        "op4_html": op4_html,
        "op5_chat": op5_chat,
        "op6_decontaminate": op6_decontaminate,
        "op7_pii": op7_pii,
        "op8_urls": op8_urls,
        "op9_simhash": op9_simhash,
        "op10_toxicity": op10_toxicity,
    }
    found["pipeline"] = corpus_pipeline.run
    return {name: _shipping(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    return {"op1_substring_dedup": OP1_SQL, "op2_quality": OP2_SQL}
