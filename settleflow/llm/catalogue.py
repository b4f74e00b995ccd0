"""The registered queries of the text operators, one for each, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from settleflow.llm import bpe, conversations, decontaminate, digests, language_id, language_model, licences, mixing, near_dedup, passages, phrases, pii, quality
from settleflow.llm.common import remainder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(build):
    QUERIES[build.__name__] = build
    return build


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query
def op2_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.cluster(_table(spark, folder, "documents"))


@_query
def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    model = quality.train(docs, labels.where(remainder(F.col("doc_id"), 5) != 0))
    return quality.classify(docs, model).select(
        "doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


@_query
def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = language_id.train(docs.where(remainder(F.col("doc_id"), 3) != 1))
    return language_id.identify(docs, model).select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")


@_query
def op10_pfair_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents")).select("doc_id", "source", "slot", "position")


@_query
def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.detect(_table(spark, folder, "documents").select("doc_id", "text")).drop("text")
    return pii.digest(found).select("doc_id", *[f"n_{kind}" for kind in pii.KINDS], "base_sha256", "spans")


@_query
def op3_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


@_query
def op5_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return digests.fingerprints(_table(spark, folder, "documents"))


@_query
def op9_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return passages.repeated(_table(spark, folder, "documents"))


@_query
def op8_language_model_scores(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.train_and_score(_table(spark, folder, "documents"))


@_query
def op6_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return licences.scan(docs, licences.train(docs))


@_query
def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.audit(conversations.damaged(_table(spark, folder, "conversations")))


@_query
def op12_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@_query
def op13_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(_table(spark, folder, "documents"))


SQL["op13_phrase_collocations"] = r"""
WITH pieces AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents WHERE text IS NOT NULL)),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM pieces, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase),
total AS (SELECT lang, sum(f)::HUGEINT AS n FROM f WHERE k = 1 GROUP BY lang),
frequent AS (SELECT * FROM f WHERE f >= 100),
covered AS (
  SELECT DISTINCT s.lang, s.phrase FROM frequent s JOIN frequent q ON s.lang = q.lang AND q.k > s.k
  WHERE contains(' ' || q.phrase || ' ', ' ' || s.phrase || ' ') AND 100 * q.f >= 100 * s.f),
cuts AS (
  SELECT lang, phrase, f AS a, i, array_to_string(string_split(phrase, ' ')[1:i], ' ') AS lp, array_to_string(string_split(phrase, ' ')[i + 1:], ' ') AS rp
  FROM frequent, (SELECT unnest([1, 2, 3, 4]) AS i) WHERE k >= 2 AND i < k),
scored AS (
  SELECT c.lang, c.phrase, c.i, c.a, l.f AS l, r.f AS r, t.n, (1000::HUGEINT * c.a * t.n) // (l.f::HUGEINT * r.f) AS score
  FROM cuts c JOIN frequent l ON l.lang = c.lang AND l.phrase = c.lp JOIN frequent r ON r.lang = c.lang AND r.phrase = c.rp JOIN total t ON t.lang = c.lang),
weakest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) AS place FROM scored),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
  FROM weakest WHERE place = 1 AND NOT EXISTS (SELECT 1 FROM covered c WHERE c.lang = weakest.lang AND c.phrase = weakest.phrase))
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""
