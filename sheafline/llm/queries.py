"""The operators of this subpackage as queries over the test tables, and their SQL where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontam, htmlmain, langid, minhash, quality, tokencount, toxicity, urlfilter, warc
from .common import Scratch, held_out, spread, table

#: Vocabulary files; each is a parameter of its operator.
BPE_PATH = os.environ.get("SHEAFLINE_BPE", public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
PIECES_PATH = os.environ.get("SHEAFLINE_PIECES", public_tokenizers.path("piece_bpe_32k.model"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    train = docs.where(~held_out(docs, 5, 0))
    model = toxicity.fit(spark, train, table(spark, sf_dir, "labels"), Scratch(spark, "op1"))
    out = toxicity.tag(spread(docs), model)
    offending = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"], s["end"])), " ")
    return out.select("doc_id", held_out(out, 5, 0).alias("held_out"), "score", "predicted", offending.alias("offending"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    trees = urlfilter.train(urlfilter.rule_labels(urlfilter.with_parts(pages.where("url is not null"))))
    return urlfilter.judge(pages, trees).select("page_id", "host", "path", "rule", "verdict")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(~held_out(docs, 3, 1)), PIECES_PATH, Scratch(spark, "op3"))
    out = langid.predict(spread(docs.select("doc_id", "text")), model)
    return out.select("doc_id", held_out(out, 3, 1).alias("held_out"), "lang_pred", "score")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(spread(docs), BPE_PATH, public_tokenizers.PATTERN).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"), Scratch(spark, "op5")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return quality.judge(docs, Scratch(spark, "op6"), keep_text=False).select("doc_id", *quality.COUNTS, "base_failed", "kept")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Scratch(spark, "op7"))
    return found.select("doc_id", "item_id", F.col("matched").cast("long").alias("matched"), F.col("of").cast("long").alias("of"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(spark, table(spark, sf_dir, "documents"), Scratch(spark, "op8"), size=3, percent=85)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = tokencount.count_sections(spread(docs), BPE_PATH, public_tokenizers.PATTERN, rule="most")
    return out.select("doc_id", F.explode("sections").alias("s")).select("doc_id", "s.section", F.col("s.start").alias("char_start"), F.col("s.end").alias("char_end"), "s.n_tokens", "s.n_crossing")


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmlmain.extract(table(spark, sf_dir, "pages"), Scratch(spark, "op10"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {f.__name__: f for f in (op1_toxicity, op2_url_filter, op3_language, op4_bpe, op5_warc, op6_quality, op7_decontamination, op8_minhash, op9_token_counts, op10_main_text)}
    return found | {"pipeline": pipeline}


_WORDS = r"string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+')"

#: base32 of a SHA-1: each digit is five bits, read from the two hexadecimal digits it lies in.
_OP5 = r"""
WITH keyed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS sha FROM pages),
firsts AS (SELECT sha, min(page_id) AS first_id FROM keyed GROUP BY sha)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((((instr('0123456789abcdef', substr(sha || '0', CAST(1 + (5 * i) // 4 AS INT), 1)) - 1) * 16
      + instr('0123456789abcdef', substr(sha || '0', CAST(2 + (5 * i) // 4 AS INT), 1)) - 1) >> CAST(3 - (5 * i) % 4 AS INT)) & 31) AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first_id OR first_id IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS NOT DISTINCT FROM first_id OR first_id IS NULL THEN NULL ELSE first_id END AS refers_to
FROM keyed JOIN firsts USING (sha)
"""

_MEASURE_SQL = {m: f"CASE WHEN {under} > 0 THEN (1000 * {over}) // {under} ELSE 0 END" for m, (over, under, _) in quality.MEASURES.items()}


def _op6_sql() -> str:
    unpivot = " UNION ALL ".join(f"SELECT lang, source, '{m}' AS measure, {s} AS value FROM ok" for m, s in _MEASURE_SQL.items())
    spread_of = "CASE measure " + " ".join(f"WHEN '{m}' THEN {v[2]}" for m, v in quality.MEASURES.items()) + " END"
    # a document's cutoffs: of its own group, its language or everything, whichever is the first with 200 documents
    within = " AND ".join(f"({_MEASURE_SQL[m]}) <= max(cutoff) FILTER (measure = '{m}')" for m in quality.MEASURES)
    return rf"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text, list_filter({_WORDS}, lambda w: w <> '') AS ws FROM documents),
lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM words)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM (
    SELECT r, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM words))),
covered AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM windows, range(3) t(k) WHERE n > 1 GROUP BY r),
counted AS (
  SELECT r, doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM words LEFT JOIN lines USING (r) LEFT JOIN covered USING (r)),
based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted),
ok AS (SELECT * FROM based WHERE NOT base_failed),
sketch AS (
  SELECT lang, source, measure, (value >> greatest(length(bin(value)) - 6, 0)) << greatest(length(bin(value)) - 6, 0) AS bucket, count(*) AS n
  FROM ({unpivot}) GROUP BY ALL),
running AS (
  SELECT 2 AS level, lang, source, measure, bucket, sum(n) OVER (PARTITION BY lang, source, measure ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY lang, source, measure) AS total FROM sketch
  UNION ALL
  SELECT 1, lang, NULL, measure, bucket, sum(n) OVER (PARTITION BY lang, measure ORDER BY bucket), sum(n) OVER (PARTITION BY lang, measure) FROM (SELECT lang, measure, bucket, sum(n) AS n FROM sketch GROUP BY ALL)
  UNION ALL
  SELECT 0, NULL, NULL, measure, bucket, sum(n) OVER (PARTITION BY measure ORDER BY bucket), sum(n) OVER (PARTITION BY measure) FROM (SELECT measure, bucket, sum(n) AS n FROM sketch GROUP BY ALL)),
points AS (
  SELECT level, lang, source, measure, total, min(bucket) FILTER (upto * 1000 >= total * 500) AS q50, min(bucket) FILTER (upto * 1000 >= total * 750) AS q75 FROM running GROUP BY ALL),
cutoffs AS (
  SELECT a.lang, a.source, a.measure AS measure,
    CASE WHEN a.total >= 200 THEN a.q50 WHEN b.total >= 200 THEN b.q50 ELSE c.q50 END AS q50,
    CASE WHEN a.total >= 200 THEN a.q75 WHEN b.total >= 200 THEN b.q75 ELSE c.q75 END AS q75
  FROM (SELECT * FROM points WHERE level = 2) a
  JOIN (SELECT * FROM points WHERE level = 1) b ON a.lang IS NOT DISTINCT FROM b.lang AND a.measure = b.measure
  JOIN (SELECT * FROM points WHERE level = 0) c ON a.measure = c.measure),
fences AS (SELECT lang, source, measure, q50 + 6 * greatest(q75 - q50, {spread_of}) AS cutoff FROM cutoffs)
SELECT any_value(doc_id) AS doc_id, any_value(n_words) AS n_words, any_value(word_chars) AS word_chars, any_value(n_symbols) AS n_symbols, any_value(n_dup_lines) AS n_dup_lines,
  any_value(n_repeat_words) AS n_repeat_words, any_value(base_failed) AS base_failed,
  any_value(NOT base_failed) AND coalesce({" AND ".join(f"any_value({_MEASURE_SQL[m]}) <= max(cutoff) FILTER (measure = '{m}')" for m in quality.MEASURES)}, true) AS kept
FROM based LEFT JOIN fences ON based.lang IS NOT DISTINCT FROM fences.lang AND based.source IS NOT DISTINCT FROM fences.source
GROUP BY r
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_warc": _OP5, "op6_quality": _op6_sql()}
