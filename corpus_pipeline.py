"""A corpus pipeline: language ID, near-duplicates, PII surrogates, source mixing, SentencePiece ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents. Nulls, empty tables and repeated rows have the results
that the operators define.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import jaccard, langid, mixing, spbpe, surrogates
from tessera.llm.common import remove, shared_dir

#: Below this calibrated probability above chance (0: as likely as any, 1: certain) a language counts as not told.
LEAST_SCORE = 0.3
#: The mixture: share of the largest entropy, and how often a source's documents may be repeated.
ENTROPY, REPETITION = 0.95, 2.0
#: The key of surrogates; a real run passes its own secret.
KEY = "corpus pipeline"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without a letter or a likely language go."""
    return langid.keep(docs, langid.fit_on(docs, F.lit(True)), LEAST_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates by SimHash at a wide radius: five-word shingles with a Jaccard
    similarity of 0.8 or more, which the exact sets confirm."""
    return jaccard.one_of_each(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their personal data replaced and n_chars brought up to date."""
    got = surrogates.replace(docs, KEY)
    return got.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once; those of sources that gain weight again in later epochs."""
    rows = mixing.realise(docs, mixing.plan(docs, ENTROPY, REPETITION))
    return rows.select(*(F.col(f"`{c}`") for c in docs.columns))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document."""
    return spbpe.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("pii", pii),
    ("mixing", mix_sources),
    ("sentencepiece", sentencepiece),
]
#: SQL has neither the fitted language model nor min-hashes nor the merges; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, over documents. A stage's folder goes once the next stage is written."""
    folder = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        at = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
        if k:
            remove(spark, f"{folder}/{k - 1}-{STAGES[k - 1][0]}")
    return docs
