"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A text's fingerprint has 64 bits: each is set when it is set in over half of the XXH64 hashes of the
text's word shingles. Texts link when their fingerprints differ in at most ``max_bits`` bits.

The eight bytes of a fingerprint are its postings, each a pair of position and value. ``max_bits``
differing bits touch at most so many bytes, so a pair must share at least ``8 - max_bits`` positional
bytes, the guaranteed minimum. A list for one single (position, value) would hold 1/256 of all
documents, so a posting list here stands for a whole choice of that minimum number of positions with
their values: every pair that can reach the minimum meets in at least one list, and lists stay short.
For each pair that meets, the shared positional bytes are tallied; pairs that reach the minimum are
then verified bit by bit. A pair is taken in the first list it shares only.

Equal fingerprints are reduced to one before the index, so copies cost nothing. A list can hold at
most ``256 ** max_bits`` fingerprints, all different; one longer than ``LONG_LIST`` is not paired up:
its members go to every fingerprint one bit away, and two of them meet there exactly when they differ
in two bits or fewer.

Defined results: null and empty texts, and texts of whitespace only, have fingerprint zero and link
like any other. A text with fewer words than a shingle counts as one shingle. Rows with a null id take
part; a component's id is the smallest id in it that is not null. Repeated rows fall into one
component. Further columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from settleflow.llm.common import stored, word_blocks
from settleflow.llm.graph import components

LONG_LIST = 400
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def simhash(data: bytes, shingle_words: int = 3, seed: int = 42) -> int:
    """Fingerprint of a UTF-8 text as an unsigned number."""
    votes, total = np.zeros(64, dtype=np.int64), 0
    short: list[bytes] = []
    for words in word_blocks(data.translate(_LOWER), keep=shingle_words - 1):
        if len(words) < shingle_words:
            short = words
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = [0, *(ends[:-shingle_words] + 1).tolist()]
        hashes = [xxhash.xxh64_intdigest(joined[i:j], seed) for i, j in zip(starts, ends[shingle_words - 1:].tolist())]
        total += len(hashes)
        for at in range(0, len(hashes), 1 << 14):
            part = np.array(hashes[at:at + (1 << 14)], dtype="<u8").view(np.uint8).reshape(-1, 8)
            votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    if not total:
        if not short:
            return 0
        return xxhash.xxh64_intdigest(b" ".join(short), seed)
    return int(np.packbits(2 * votes > total, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle_words: int = 3, seed: int = 42) -> Column:
    """The fingerprint as a long with the same bits."""

    @pandas_udf("long")
    def fingerprint(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(np.array([simhash(t, shingle_words, seed) for t in batch], dtype=np.uint64).view(np.int64))

    return fingerprint(F.coalesce(text, F.lit("")).cast("binary"))


def links(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """Edges ``a``, ``b`` whose components are those of all pairs within ``max_bits``; ``prints`` has distinct ``_fp``."""
    if max_bits not in (0, 1, 2):
        raise ValueError("max_bits must be 0, 1 or 2")
    if max_bits == 0:
        return prints.select(F.col("_fp").alias("a"), F.col("_fp").alias("b"))
    masks = [sum(0xFF << (8 * p) for p in kept) for kept in combinations(range(8), 8 - max_bits)]
    masks = [m - (1 << 64) if m >> 63 else m for m in masks]
    postings = prints.select("_fp", F.posexplode(F.array(*[F.col("_fp").bitwiseAND(F.lit(m)) for m in masks])).alias("_mask", "_key"))
    lists = stored(postings.groupBy("_mask", "_key").agg(F.array_sort(F.collect_list("_fp")).alias("_members")).where(F.size("_members") > 1), "postings")

    def first_shared(differ: Column) -> Column:
        """Number of the first choice of positions in which two fingerprints agree."""
        out = F.lit(None).cast("int")
        for k, m in reversed(list(enumerate(masks))):
            out = F.when(differ.bitwiseAND(F.lit(m)) == 0, F.lit(k)).otherwise(out)
        return out

    short = lists.where(F.size("_members") <= LONG_LIST)
    ordered = short.select("_mask", "_members", F.posexplode("_members").alias("_at", "a"))
    met = ordered.select("_mask", "a", F.explode(F.expr(
        f"filter(slice(_members, _at + 2, {LONG_LIST}), y -> bit_count(a ^ y) <= {max_bits})")).alias("b"))
    differ = F.col("a").bitwiseXOR(F.col("b"))
    tally = sum((F.when(F.shiftright(differ, 8 * p).bitwiseAND(F.lit(0xFF)) == 0, 1).otherwise(0) for p in range(8)), F.lit(0))
    pairs = met.where(tally >= 8 - max_bits).where(F.bit_count(differ) <= max_bits).where(F.col("_mask") == first_shared(differ)).select("a", "b")
    long = lists.where(F.size("_members") > LONG_LIST).select(F.explode("_members").alias("a")).distinct()
    one_bit = F.array(*[F.col("a").bitwiseXOR(F.lit((1 << k) - (1 << 64) if k == 63 else 1 << k)) for k in range(64)])
    if max_bits == 2:
        return pairs.union(long.select("a", F.explode(one_bit).alias("b")))
    near = long.select("a", F.explode(one_bit).alias("b"))
    return pairs.union(near.join(long.select(F.col("a").alias("b")), "b").select("a", "b"))


def grouped(rows: DataFrame, max_bits: int = 2, *, doc_id: str = "doc_id") -> DataFrame:
    """``_fp`` and ``component_id`` for every fingerprint of ``rows`` (columns ``doc_id``, ``_fp``)."""
    prints = rows.groupBy("_fp").agg(F.min(doc_id).alias("_low"))
    roots = stored(components(links(prints.select("_fp"), max_bits)).select(F.col("node").alias("_fp"), F.col("root").alias("_root")), "roots")
    named = prints.join(roots, "_fp", "left").select("_fp", "_low", F.coalesce("_root", "_fp").alias("_root"))
    lows = named.groupBy("_root").agg(F.min("_low").alias("component_id"))
    return named.join(lows, "_root").select("_fp", "component_id", "_root")


def cluster(docs: DataFrame, shingle_words: int = 3, max_bits: int = 2, seed: int = 42, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` for every row."""
    rows = stored(docs.select(F.col(doc_id).alias("doc_id"), fingerprint_column(F.col(text), shingle_words, seed).alias("_fp")), "fingerprints")
    named = grouped(rows, max_bits)
    return rows.join(named, "_fp").select("doc_id", F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle_words: int = 3, max_bits: int = 2, seed: int = 42, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row with the smallest id stays.

    Rows are numbered once and written with their fingerprints, so that of repeated rows exactly one
    stays; a row without an id stays only if its component has no row with one.
    """
    fp, row = "_near_fp", "_near_row"
    marked = stored(docs.withColumn(fp, fingerprint_column(F.col(text), shingle_words, seed)).withColumn(row, F.monotonically_increasing_id()), "marked")
    narrow = marked.select(F.col(doc_id).alias("doc_id"), F.col(fp).alias("_fp"), F.col(row).alias("_row"))
    named = narrow.join(grouped(narrow, max_bits), "_fp")
    first = named.groupBy("_root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row")).alias("_first"), F.count(F.lit(1)).alias("_n"))
    # only groups of several rows lose any
    gone = (named.join(first.where("_n > 1"), "_root").where(F.col("_row") != F.col("_first._row")).select(F.col("_row").alias(row)))
    return marked.join(gone, row, "left_anti").drop(fp, row)
