"""Licence scans: a trained paragraph classifier whose predictions are confirmed by template comparison.

Training. Examples are the templates and variants of them with words left out, one class for each licence family. The class ``unknown`` has
notices of no family and paragraphs of a bounded number of documents that share no three words in a row with a template. A
multinomial logistic regression learns from sparse word n-grams (two and three words), those of the family examples. On other variants and other paragraphs the
margin between the best family and ``unknown`` is calibrated into a probability; below ``threshold`` a paragraph is unknown.

Scan. A paragraph (line) without any n-gram of the vocabulary is unknown by the intercepts alone, so n-grams are looked up in the
weights, and only paragraphs with a hit are scored. A prediction is confirmed when one of the family's templates has at least
``similarity`` of its word shingles (five words) in the paragraph.

Everything is DataFrame operations and Spark's own machine learning. The weights that are broadcast are bounded by ``VOCABULARY`` n-grams.

Defined results: null and empty texts have no rows, nor have paragraphs that are unknown. Rows with null ids take part; a
row that repeats with equal id and text is reported once. Of equally likely families the first in order is
taken, of equally similar templates the first. Texts are read whole.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from settleflow.llm.common import stored
from settleflow.llm.decontaminate import words_of

VOCABULARY = 1 << 14
SAMPLE_DOCUMENTS = 400
VARIANTS = 24
UNKNOWN = "unknown"

# fixed values: notices and opening sentences by which licences are recognised
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
        "Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
        "Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "LGPL": [
        "This library is licensed under the GNU Lesser General Public License.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
    ],
    "AGPL-3.0": [
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ],
    "BSD": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Released into the public domain under CC0 1.0.",
    ],
}
NO_FAMILY = [
    "Licensed under the terms of a commercial agreement with the publisher.",
    "All rights reserved. No part of this work may be reproduced without permission.",
    "This software is licensed to the customer under a separate contract.",
    "You may not use this driving license except in the country of issue.",
    "The general public may use the library free of charge.",
]


def _runs(words: Column, sizes: tuple[int, ...]) -> Column:
    """All runs of so many words as text, each once."""
    def of(size: int) -> Column:
        last = F.size(words) - size
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.concat_ws(" ", *[
            F.get(words, i + k) for k in range(size)]))).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*[of(s) for s in sizes]))


def _shingles(words: Column) -> Column:
    """Five-word shingles; the whole sequence if it is shorter."""
    return F.when(F.size(words) < 5, F.array(F.concat_ws(" ", words))).otherwise(_runs(words, (5,)))


def _paragraphs(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("_text"), F.posexplode_outer(F.split(text, "\n")).alias("paragraph", "_line")).select(
        "doc_id", "_text", "paragraph", words_of(F.col("_line")).alias("_words"))


class LicenceModel:
    """Weights of the n-grams for every class, intercepts, and the calibration of the margin."""

    def __init__(self, families: list[str], grams: list[tuple[str, list[float]]], intercepts: list[float], slope: float, offset: float) -> None:
        self.families, self.grams, self.intercepts, self.slope, self.offset = families, grams, intercepts, slope, offset


def _examples(spark: SparkSession) -> DataFrame:
    """Templates and variants with words left out; ``pool`` tells training from calibration."""
    listed = [(f, t) for f, ts in TEMPLATES.items() for t in ts] + [(UNKNOWN, t) for t in NO_FAMILY]
    base = spark.createDataFrame(listed, "family string, _line string").select("family", words_of(F.col("_line")).alias("_all"))
    variants = base.withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(2 * VARIANTS - 1))))
    kept = F.filter("_all", lambda w, i: (F.col("v") < 2) | (F.pmod(F.xxhash64(F.col("_all"), F.col("v"), i), F.lit(12)) > 0))
    return variants.select("family", kept.alias("_words"), (F.col("v") % 2).alias("pool"))


def train(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> LicenceModel:
    spark = docs.sparkSession
    families = [*TEMPLATES, UNKNOWN]
    examples = _examples(spark)
    known = examples.where(F.col("family") != UNKNOWN).select(F.explode(_runs(F.col("_words"), (3,))).alias("_g")).distinct()
    known = [r[0] for r in known.collect()]  # from the templates alone
    sample = docs.where(F.col(text).isNotNull()).orderBy(F.xxhash64(doc_id), F.xxhash64(text)).limit(SAMPLE_DOCUMENTS)
    # stored, or the filter below would split a paragraph again for each of its words
    sampled = stored(_paragraphs(sample, doc_id, text).where(F.size("_words") > 0), "licence-sample")
    plain = sampled.where(~F.arrays_overlap(_runs(F.col("_words"), (3,)), F.lit(known)))
    plain = plain.select(F.lit(UNKNOWN).alias("family"), "_words", F.pmod(F.xxhash64("doc_id", "paragraph"), F.lit(2)).cast("int").alias("pool"))
    label = F.array_position(F.lit(families), F.col("family")).cast("double") - 1
    data = examples.union(plain).select(label.alias("label"), _runs(F.col("_words"), (2, 3)).alias("grams"), "pool")
    vectors = CountVectorizer(inputCol="grams", outputCol="features", vocabSize=VOCABULARY, minDF=2, binary=True).fit(
        data.where((F.col("pool") == 0) & (F.col("label") < len(families) - 1)))
    made = vectors.transform(data).cache()
    model = LogisticRegression(family="multinomial", regParam=1e-3, maxIter=60).fit(made.where("pool = 0").coalesce(1))
    matrix, intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    grams = [(g, [float(x) for x in matrix[:, k]]) for k, g in enumerate(vectors.vocabulary)]

    raw = model.transform(made.where("pool = 1")).withColumn("_raw", vector_to_array("rawPrediction"))
    margin = F.array_max(F.slice("_raw", 1, len(families) - 1)) - F.element_at("_raw", len(families))
    held = raw.select((F.col("label") < len(families) - 1).cast("double").alias("label"), margin.alias("margin"))
    held = VectorAssembler(inputCols=["margin"], outputCol="features").transform(held)
    calibration = LogisticRegression(regParam=1e-2, maxIter=50).fit(held.select("label", "features"))
    made.unpersist()
    return LicenceModel(families, grams, [float(x) for x in intercepts], float(calibration.coefficients[0]), float(calibration.intercept))


def scan(docs: DataFrame, model: LicenceModel, *, threshold: float = 0.5, similarity: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``paragraph`` (number of the line, from 0), ``family``, ``probability``, ``similarity``, ``confirmed``."""
    spark = docs.sparkSession
    weights = spark.createDataFrame(model.grams, "_gram string, _weights array<double>").select(F.xxhash64("_gram").alias("_g"), "_weights")
    hashed = _paragraphs(docs, doc_id, text).withColumn("_grams", F.transform(_runs(F.col("_words"), (2, 3)), lambda g: F.xxhash64(g)))
    # outer: else Spark infers a filter that makes the n-grams once more
    hits = hashed.select("doc_id", "_text", "paragraph", "_words", F.explode_outer("_grams").alias("_g")).join(F.broadcast(weights), "_g")
    grouped = hits.groupBy("doc_id", "_text", "paragraph").agg(F.collect_set(F.struct("_g", "_weights")).alias("_hits"), F.first("_words").alias("_words"))
    start = F.lit(model.intercepts)
    logits = grouped.withColumn("_z", F.aggregate("_hits", start, lambda z, h: F.zip_with(z, h["_weights"], lambda a, b: a + b)))
    n = len(model.families)
    best = F.array_max(F.slice("_z", 1, n - 1))
    margin = best - F.element_at("_z", n)
    chance = 1 / (1 + F.exp(-(F.lit(model.slope) * margin + F.lit(model.offset))))
    named = logits.select("doc_id", "paragraph", "_words", F.element_at(F.lit(model.families), F.array_position(F.slice("_z", 1, n - 1), best).cast("int")).alias("family"), chance.alias("probability")).where(
        F.col("probability") >= threshold)
    templates = spark.createDataFrame([(f, t) for f, ts in TEMPLATES.items() for t in ts], "family string, _line string")
    templates = templates.withColumn("_s", _shingles(words_of(F.col("_line")))).groupBy("family").agg(F.collect_list("_s").alias("_templates"))
    compared = named.join(F.broadcast(templates), "family").withColumn("_own", F.concat(_shingles(F.col("_words")), _runs(F.col("_words"), (3, 4))))
    share = F.array_max(F.transform("_templates", lambda t: F.size(F.array_intersect(t, F.col("_own"))) / F.size(t)))
    return compared.select("doc_id", "paragraph", "family", "probability", share.alias("similarity")).withColumn("confirmed", F.col("similarity") >= similarity)
