"""Benchmark decontamination: passages of documents that repeat an item of a benchmark.

A document contains an item when a window of the item's size is similar to it: the multisets of word
shingles (five words, lower-cased, without punctuation) have a weighted similarity, sum of minima over sum of
maxima, of ``threshold`` or more. A document smaller than the item is one window.

1. Windows. For the threshold a window must share at least ``threshold * n`` of an item's ``n`` shingles,
   so it holds one of the item's ``n - ceil(threshold * n) + 1`` rarest ones (counted over the benchmark). Windows of
   an item's size are taken wherever a document has such a shingle, each once. No similar window is missed.
2. SimHash. Each window and item gets a 64-bit SimHash of its shingles. Fingerprints are indexed in eight blocks of
   eight bits; items also stand under every block value one bit away. Two fingerprints within
   ``RADIUS`` = 15 bits agree up to one bit in at least one block, so the index finds all of them.
3. Candidates within the radius are verified by the exact weighted similarity.

Similar windows expect about ten differing bits at a similarity of 0.8 and fewer above it.

All steps are DataFrame operations. The tables that are broadcast (rare shingles and block index) are
cut into parts of ``PART_ITEMS`` items, one pass over the documents for each, so that no broadcast grows with the
benchmark. Copies of a text are reduced to one before windows are compared.

Defined results: null or empty texts and items never match. An item with fewer words than a shingle
is one shingle as a whole. Rows with null ids take part; repeated rows each have their matches, repeated items count once.
Of equally similar windows the first is reported. Further columns are left alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from settleflow.llm.common import stored

RADIUS = 15
PART_ITEMS = 50_000
_KEY = ["_k1", "_k2"]


def words_of(text: Column) -> Column:
    """Lower-case words of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _shingles(words: Column, size: int) -> Column:
    """Hash of every run of ``size`` words."""
    last = F.size(words) - size
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(
        *[F.get(words, i + k) for k in range(size)]))).otherwise(F.array().cast("array<bigint>"))


def _simhash(hashes: Column) -> Column:
    """Bit k is set when it is set in over half of the hashes."""
    half = F.size(hashes)

    def bit(k: Column) -> Column:
        return F.aggregate(hashes, F.lit(0), lambda a, h: a + F.getbit(h, k).cast("int"))

    ones = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda k: F.when(bit(k) * 2 > half, F.call_function("shiftleft", F.lit(1).cast("long"), k)).otherwise(F.lit(0).cast("long")))
    return F.aggregate(ones, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))


def _similarity(left: Column, right: Column) -> Column:
    """Weighted similarity of two multisets given as arrays."""
    def count(array: Column, x: Column) -> Column:
        return F.size(F.filter(array, lambda y: y == x))

    shared = F.aggregate(F.array_distinct(left), F.lit(0), lambda a, x: a + F.least(count(left, x), count(right, x)))
    return shared / (F.size(left) + F.size(right) - shared)


def _block(fp: Column, k: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * k).bitwiseAND(F.lit(255)).cast("int")


def _key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("_k1"), F.xxhash64(F.lit(1), text).alias("_k2")]


def _passages(texts: DataFrame, items: DataFrame, size: int, threshold: float) -> DataFrame:
    """Similar windows of one part of the items, all with shingles of ``size`` words."""
    listed = items.select("item_id", F.size("_item").alias("_n"), "_item")
    every = listed.select("item_id", "_n", F.posexplode("_item").alias("_o", "_h"))
    ranked = every.withColumn("_df", F.count(F.lit(1)).over(W.partitionBy("_h"))).withColumn(
        "_rank", F.row_number().over(W.partitionBy("item_id", "_n").orderBy("_df", "_h", "_o")))
    rare = ranked.where(F.col("_rank") <= F.col("_n") - F.ceil(F.col("_n") * threshold - 1e-9) + 1).select("_h", "_n").distinct()

    hashed = texts.select(*_KEY, words_of(F.col("_text")).alias("_words")).where(F.size("_words") >= size)
    hashed = hashed.select(*_KEY, _shingles(F.col("_words"), size).alias("_hashes"))
    exploded = hashed.select(*_KEY, "_hashes", F.posexplode_outer("_hashes").alias("_pos", "_h"))  # outer: else Spark infers a filter that hashes once more
    first = F.greatest(F.lit(0), F.col("_pos") - F.col("_n") + 1)
    hits = exploded.join(F.broadcast(rare), "_h").select(
        *_KEY, "_n", "_pos", F.size("_hashes").alias("_all"), first.alias("_first"),
        F.slice("_hashes", first + 1, F.col("_pos") + F.col("_n") - first).alias("_around"))
    hits = stored(hits.dropDuplicates([*_KEY, "_n", "_pos"]), "hits")
    before = F.lag("_pos", 1, -1).over(W.partitionBy(*_KEY, "_n").orderBy("_pos"))
    # starts after the hit before this one: windows that begin earlier hold that hit and come from it
    low = F.greatest(F.col("_first"), before + 1)
    high = F.greatest(F.lit(0), F.least(F.col("_pos"), F.col("_all") - F.col("_n")))
    spread = hits.withColumn("_low", low).withColumn("_high", high).where("_low <= _high")
    windows = spread.select(*_KEY, "_n", "_first", "_around", F.explode(F.sequence("_low", "_high")).alias("_start")).select(
        *_KEY, "_n", "_start", F.slice("_around", F.col("_start") - F.col("_first") + 1, F.col("_n")).alias("_window"))
    windows = windows.withColumn("_fp", _simhash(F.col("_window")))

    prints = listed.withColumn("_print", _simhash(F.col("_item")))
    near = F.array(F.lit(0), *[F.lit(1 << b) for b in range(8)])
    index = prints.select("item_id", "_n", "_print", "_item", F.posexplode(F.array(*[_block(F.col("_print"), k) for k in range(8)])).alias("_b", "_v0"))
    index = index.select("item_id", "_n", "_print", "_item", "_b", F.explode(F.transform(near, lambda x: F.col("_v0").bitwiseXOR(x))).alias("_v"))
    probes = windows.select("*", F.posexplode(F.array(*[_block(F.col("_fp"), k) for k in range(8)])).alias("_b", "_v"))
    differ = F.col("_fp").bitwiseXOR(F.col("_print"))
    first_block = reduce(lambda later, k: F.when(F.bit_count(_block(differ, k)) <= 1, F.lit(k)).otherwise(later), range(7, -1, -1), F.lit(None).cast("int"))
    met = probes.join(F.broadcast(index), ["_n", "_b", "_v"]).where(F.col("_b") == first_block).withColumn("distance", F.bit_count(differ).cast("int"))
    verified = met.where(F.col("distance") <= RADIUS).withColumn("similarity", _similarity(F.col("_window"), F.col("_item"))).where(F.col("similarity") >= threshold)
    return verified.select(*_KEY, "item_id", F.col("_start").alias("start_word"), (F.col("_n") + size - 1).alias("n_words"), "similarity", "distance")


def passages(docs: DataFrame, benchmark: DataFrame, *, threshold: float = 0.8, shingle_words: int = 5, text: str = "text",
             item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Best window of each (text, item) found: key of the text, ``item_id``, ``start_word``, ``n_words``, ``similarity``, ``distance``."""
    texts = docs.select(*_key(F.col(text)), F.col(text).alias("_text")).where(F.col("_text").isNotNull())
    items = benchmark.select(F.col(item_id).alias("item_id"), words_of(F.col(item_text)).alias("_words")).where(F.size("_words") > 0).distinct()
    items = stored(items.withColumn("_size", F.least(F.size("_words"), F.lit(shingle_words)))
                   .withColumn("_part", F.pmod(F.xxhash64("item_id", "_words"), F.lit(1 << 30))), "items")
    parts = -(-items.count() // PART_ITEMS)
    found = []
    for size in sorted(r[0] for r in items.select("_size").distinct().collect()):  # at most shingle_words values
        hashed = items.where(F.col("_size") == size).select("item_id", _shingles(F.col("_words"), size).alias("_item"), "_part")
        for part in range(parts):
            found.append(_passages(texts, hashed.where(F.col("_part") % parts == part), size, threshold))
    if not found:
        return texts.select(*_KEY).limit(0).selectExpr(
            *_KEY, "cast(null as bigint) item_id", "0 start_word", "0 n_words", "0D similarity", "0 distance")
    best = reduce(DataFrame.union, found).groupBy(*_KEY, "item_id").agg(
        F.min(F.struct((-F.col("similarity")).alias("s"), "start_word", "n_words", "distance")).alias("_best"))
    return stored(best.select(*_KEY, "item_id", "_best.start_word", "_best.n_words", (-F.col("_best.s")).alias("similarity"), "_best.distance"), "passages")


def contaminated(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``doc_id``, ``item_id`` and the best window of every pair found."""
    found = passages(docs, benchmark, text=text, **options)
    rows = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("doc_id"), *_key(F.col(text)))
    return rows.join(found, _KEY).drop(*_KEY)


def clean(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no item of the benchmark."""
    found = passages(docs, benchmark, text=text, **options).select(*_KEY).distinct()
    k1, k2 = _key(F.col(text))
    return docs.withColumns({"_k1": k1, "_k2": k2}).join(found, _KEY, "left_anti").drop(*_KEY)
