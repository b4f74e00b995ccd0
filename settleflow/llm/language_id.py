"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased and framed by spaces; its character n-grams (``ORDERS``) are hashed into ``BUCKETS`` buckets.
Training counts them per language in all training rows: tasks count their rows, Spark adds the
counts, and the smoothed log-probabilities, a matrix of buckets by languages, are broadcast. Its size
is bounded by the number of language codes. Scoring runs over batches: a sparse matrix of counts, texts by
buckets, is multiplied by the weights.

The language predicted is the one with the highest posterior over all n-grams of the text. The score is the predicted
language's probability at softened evidence: n-grams of one text are far from independent, so for the score, and for
it alone, they count as ``EVIDENCE`` n-grams at most.

Defined results: ``und`` with score 0 for a null text, a text without a letter, and every text if
there are no training rows; ties go to the language first in order. Texts of any length are
cut into pieces that overlap, so no n-gram is lost or counted twice. Rows do not depend on each other,
so repeated rows get equal results, and further columns change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
EVIDENCE = 64
SMOOTHING = 0.5
PIECE = 1 << 18  # characters


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    weights: np.ndarray  # (BUCKETS + 1, languages); the last row is zero
    prior: np.ndarray


def _pieces(texts: list[str]) -> Iterator[tuple[list[int], list[str], list[int]]]:
    """Groups of pieces of about PIECE characters: number of the text, piece with overlap, n-gram starts that count."""
    which, pieces, starts, size, over = [], [], [], 0, max(ORDERS) - 1
    for k, text in enumerate(texts):
        framed = f" {text.lower()} "
        for at in range(0, len(framed), PIECE):
            which.append(k)
            pieces.append(framed[at:at + PIECE + over])
            starts.append(min(PIECE, len(framed) - at))
            size += starts[-1]
            if size >= PIECE:
                yield which, pieces, starts
                which, pieces, starts, size = [], [], [], 0
    if pieces:
        yield which, pieces, starts


def _buckets(pieces: list[str], starts: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram, one row per order, BUCKETS where none begins; and the offset of each piece."""
    codes = np.frombuffer("".join(pieces).encode("utf-32-le", "surrogatepass"), "<u4")
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    room = np.repeat(offsets[1:], lengths) - np.arange(len(codes))  # characters from here to the end of the piece
    counted = np.repeat(offsets[:-1] + np.array(starts), lengths) > np.arange(len(codes))
    out = np.full((len(ORDERS), len(codes)), BUCKETS, dtype=np.int64)
    for row, n in zip(out, ORDERS):
        if len(codes) < n:
            continue
        h = np.full(len(codes) - n + 1, n, dtype=np.uint32)
        for k in range(n):
            h = (h ^ codes[k:len(codes) - n + 1 + k]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
        fits = counted[:len(h)] & (room[:len(h)] >= n)
        row[:len(h)] = np.where(fits, h & np.uint32(BUCKETS - 1), BUCKETS)
    return out, offsets[:-1]


def train(rows: DataFrame, *, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Learn from all rows that have a language and a text."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[str, np.ndarray] = {}
        seen: dict[str, int] = {}
        for batch in batches:
            for code, group in batch.groupby("_lang"):
                mine = counts.setdefault(code, np.zeros(BUCKETS + 1, dtype=np.int64))
                seen[code] = seen.get(code, 0) + len(group)
                for _, pieces, starts in _pieces(group["_text"].tolist()):
                    mine += np.bincount(_buckets(pieces, starts)[0].ravel(), minlength=BUCKETS + 1)
        for code, mine in counts.items():
            mine[BUCKETS] = seen[code]  # the spare place carries the number of texts
            full = np.flatnonzero(mine)
            yield pd.DataFrame({"lang": code, "bucket": full.astype(np.int32), "n": mine[full]})

    learn = rows.select(F.col(lang).cast("string").alias("_lang"), F.col(text).alias("_text")).dropna()
    found = learn.mapInPandas(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = tuple(sorted(found["lang"].unique()))
    counts = np.zeros((BUCKETS + 1, len(languages)))
    counts[found["bucket"], found["lang"].map({v: k for k, v in enumerate(languages)}).astype(int)] = found["n"]
    texts, counts[BUCKETS] = counts[BUCKETS].copy(), 0
    weights = np.log(counts + SMOOTHING) - np.log(counts.sum(axis=0) + SMOOTHING * BUCKETS)
    weights[BUCKETS] = 0
    return LanguageModel(languages, weights.astype(np.float32), np.log(texts / max(texts.sum(), 1)) if languages else texts)


def _score(model: LanguageModel, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Language of the highest posterior of each text, and its probability at softened evidence."""
    sums, grams = np.zeros((len(texts), len(model.languages))), np.zeros(len(texts))
    for which, pieces, starts in _pieces(texts):
        found, _ = _buckets(pieces, starts)
        owner = np.repeat(np.array(which, np.int64), np.fromiter(map(len, pieces), np.int64, len(pieces)))
        # the sparse matrix of counts, text by bucket, in order of its cells, times the weights
        cells, n = np.unique((owner * (BUCKETS + 1) + found)[found < BUCKETS], return_counts=True)
        if not len(cells):
            continue
        row, bucket = np.divmod(cells, BUCKETS + 1)
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        sums[row[first]] += np.add.reduceat(model.weights[bucket] * n[:, None].astype(np.float64), first, axis=0)
        grams[row[first]] += np.add.reduceat(n, first)
    best = (sums + model.prior).argmax(axis=1)
    evidence = sums * (np.minimum(grams, EVIDENCE) / np.maximum(grams, 1))[:, None] + model.prior
    evidence -= evidence.max(axis=1, keepdims=True)
    chance = np.exp(evidence)
    return best, chance[np.arange(len(texts)), best] / chance.sum(axis=1)


def predict_column(model: LanguageModel, text: Column, context) -> Column:
    """Struct ``lang``, ``score``; ``context`` is the SparkContext that broadcasts the matrix."""
    if not model.languages:
        return F.struct(F.lit("und").alias("lang"), F.lit(0.0).alias("score"))
    shared = context.broadcast((model.languages, model.weights, model.prior))  # plain values: read without this package

    @pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = LanguageModel(*shared.value)
        for batch in batches:
            texts = batch.tolist()
            some = [k for k, t in enumerate(texts) if t is not None and any(map(str.isalpha, t))]
            lang, score = np.full(len(texts), "und", dtype=object), np.zeros(len(texts))
            if some:
                best, chance = _score(model, [texts[k] for k in some])
                lang[some], score[some] = np.array(model.languages, dtype=object)[best], chance
            yield pd.DataFrame({"lang": lang, "score": score})

    return predict(text)


def identify(docs: DataFrame, model: LanguageModel, *, text: str = "text") -> DataFrame:
    """All rows and columns with ``lang_pred`` and ``score``."""
    found = docs.withColumn("_found", predict_column(model, F.col(text), docs.sparkSession.sparkContext))
    return found.withColumns({"lang_pred": F.col("_found.lang"), "score": F.col("_found.score")}).drop("_found")
