"""Quality classifier by compression: a text is compared with dictionaries of good and of bad text.

Two zstandard dictionaries are trained, one from texts labelled 1 and one from texts labelled 0. A
text is compressed with each of them and without any. The difference of the two sizes, normalised by
the sizes themselves, is the evidence; a logistic fit on other labelled rows, which also sees how well
the text compresses alone and how long it is, turns it into a calibrated probability of label 1.

Training uses a bounded sample of the labelled rows (``Bounds``): the ids come first in the order of
their hash, half of all ids is for the dictionaries and the other half for the calibration. Everything
else, scoring above all, covers every row and the whole text.

Defined results: a null text counts as empty; an empty text gets its calibrated score like any
other; without labels of both kinds all scores are the share of label 1 (0.5 without any label).
Repeated labels count once. Rows are scored one by one, so ties, repeated rows and further columns
change nothing; a column that has the name of a new one is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

LEVEL = 3


@dataclass(frozen=True)
class Bounds:
    """Most rows and bytes of text that come to the driver for training."""

    dictionary_rows: int = 1500  # of each label
    calibration_rows: int = 4000
    sample_bytes: int = 48 << 20
    dictionary_bytes: int = 110 << 10


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]


def train(docs: DataFrame, labels: DataFrame, bounds: Bounds = Bounds(), *, doc_id: str = "doc_id",
          text: str = "text", label: str = "quality") -> QualityModel:
    """Fit the model. ``labels`` holds ``doc_id`` and a label of 0 or 1, already limited to training rows."""
    marked = (labels.where(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1))
              .select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_label")).distinct()
              .withColumn("_order", F.xxhash64("_id")).withColumn("_pool", F.shiftright(F.xxhash64("_order"), 5) % 2 == 0))
    parts = [marked.where(F.col("_pool") & (F.col("_label") == k)).orderBy("_order", "_id").limit(bounds.dictionary_rows) for k in (0, 1)]
    parts.append(marked.where(~F.col("_pool")).orderBy("_order", "_id", "_label").limit(bounds.calibration_rows))
    chosen = parts[0].union(parts[1]).union(parts[2])
    rows = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text"))
    # the chosen ids are bounded by the numbers above
    sized = rows.join(F.broadcast(chosen), "_id").select("_id", "_label", "_pool", "_order", F.length("_text").alias("_n")).distinct().collect()
    allowed, ids = {True: bounds.sample_bytes // 2, False: bounds.sample_bytes // 2}, []
    for row in sorted(sized, key=lambda r: (r["_order"], r["_id"], r["_label"], r["_n"])):
        if allowed[row["_pool"]] >= row["_n"]:
            allowed[row["_pool"]] -= row["_n"]
            ids.append((row["_id"], row["_label"], row["_pool"], row["_order"], row["_n"]))
    if not ids:
        return QualityModel(b"", b"", (0.0,))
    picked = docs.sparkSession.createDataFrame(ids, f"_id {docs.schema[doc_id].dataType.simpleString()}, _label int, _pool boolean, _order long, _n int")
    taken = rows.join(F.broadcast(picked), "_id").where(F.length("_text") == F.col("_n")).drop("_n").distinct().collect()
    taken.sort(key=lambda r: (r["_order"], r["_label"], bytes(r["_text"])))
    return _fit([(bytes(r["_text"]), r["_label"], r["_pool"]) for r in taken], bounds.dictionary_bytes)


def _fit(rows: list[tuple[bytes, int, bool]], size: int) -> QualityModel:
    share = float(np.mean([r[1] for r in rows]))
    share = min(max(share, 1e-3), 1 - 1e-3)
    flat = (float(np.log(share / (1 - share))),)
    samples = {k: [t for t, label, pool in rows if pool and label == k and t] for k in (0, 1)}
    held = [(t, label) for t, label, pool in rows if not pool]
    if not samples[0] or not samples[1] or len({label for _, label in held}) < 2:
        return QualityModel(b"", b"", flat)
    good, bad = (_dictionary(samples[k], size) for k in (1, 0))
    measure = _measure(good, bad)
    x = np.array([measure(t) for t, _ in held])
    x = np.c_[np.ones(len(x)), x]
    y = np.array([float(label) for _, label in held])
    w, ridge = np.zeros(x.shape[1]), 1e-2 * np.eye(x.shape[1])
    ridge[0, 0] = 1e-6
    for _ in range(50):  # Newton steps of the logistic fit
        p = _sigmoid(x @ w)
        w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (p - y) + ridge @ w)
    return QualityModel(good, bad, tuple(float(v) for v in w))


def _dictionary(samples: list[bytes], size: int) -> bytes:
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: their end serves as raw content
        return b"\n".join(samples)[-size:]


def _measure(good: bytes, bad: bytes):
    """Function from a text to its features."""
    plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
    with_good, with_bad = (_compressor(d) for d in (good, bad))

    def features(data: bytes) -> tuple[float, ...]:
        g, b, own = (len(c.compress(data)) for c in (with_good, with_bad, plain))
        long, ratio = np.log1p(len(data)), own / (len(data) + 9)
        d = (b - g) / (b + g)
        return d, d * long, (b - g) / (len(data) + 9), long, ratio, ratio * ratio

    return features


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_dict_id=False)


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def score_column(model: QualityModel, text: Column) -> Column:
    """Calibrated probability that a text has label 1."""
    if len(model.weights) == 1:
        return F.lit(float(_sigmoid(model.weights[0])))

    @pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        measure, weights = _measure(model.good, model.bad), np.array(model.weights)
        for batch in batches:
            x = np.array([measure(t) for t in batch]).reshape(len(batch), len(weights) - 1)
            yield pd.Series(_sigmoid(weights[0] + x @ weights[1:]))

    return score(F.coalesce(text, F.lit("")).cast("binary"))


def classify(docs: DataFrame, model: QualityModel, threshold: float = 0.3, *, text: str = "text") -> DataFrame:
    """All rows and columns with ``score`` (0 to 1) and ``predicted`` (1 from the threshold on)."""
    scored = docs.withColumn("score", score_column(model, F.col(text)))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
