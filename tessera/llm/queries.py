"""The queries that apply each operator to its whole table, and the SQL that they must equal where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import iblt, langid, mil, mixing, pfor, rules, simhash, spbpe, surrogates, zdict
from tessera.llm.common import fold, table

#: The key of surrogates in registered queries; a real run passes its own secret.
KEY = "registered queries"


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iblt.compare_edits(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), fold(F.col("doc_id"), 5) == 0
    got = zdict.predict(docs, zdict.fit_on(docs, table(spark, sf_dir, "labels"), ~held_out))
    return got.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op4_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pfor.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replace(table(spark, sf_dir, "documents"), KEY)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), fold(F.col("doc_id"), 3) == 1
    got = mil.predict(docs, mil.fit_on(docs, table(spark, sf_dir, "labels"), ~held_out))
    return got.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), fold(F.col("doc_id"), 4) == 2
    got = langid.predict(docs, langid.fit_on(docs, ~held_out))
    return got.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spbpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_fingerprints, op2_mixing, op3_compression, op4_token_blocks, op5_surrogates, op6_toxicity, op7_language, op8_quality_rules, op9_sentencepiece, op10_simhash)}
_STOPS = ", ".join(f"'{w}'" for w in rules.STOP_WORDS)
ORACLES = {
    "op8_quality_rules": rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: length(regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g')) > 0) AS ls FROM d),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS c FROM p),
r AS (SELECT doc_id, count(DISTINCT k) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS k FROM g WHERE c > 1) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
             len(list_filter(ws, lambda x: lower(x) IN ({_STOPS})))::BIGINT AS n_stop_words, len(ls)::BIGINT AS n_lines,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
             len(list_filter(ls, lambda x: ltrim(x)[1] IN ('-', '*', '•')))::BIGINT AS n_bullet_lines,
             len(list_filter(ls, lambda x: ends_with(x, '...') OR ends_with(x, '…')))::BIGINT AS n_ellipsis_lines
      FROM w LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND word_chars >= 2 * n_words AND word_chars <= 15 * n_words AND n_symbols <= 0.1::DOUBLE * n_words
       AND n_stop_words >= 0.02::DOUBLE * n_words AND n_dup_lines <= 0.5::DOUBLE * n_lines AND n_bullet_lines <= 0.9::DOUBLE * n_lines
       AND n_ellipsis_lines <= 0.3::DOUBLE * n_lines AS kept
FROM b""",
}
