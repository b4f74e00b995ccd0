"""Document fingerprints: digests of a text's most improbable byte windows.

Every window of 64 bytes has an entropy. Over the whole corpus the entropies are counted, and the rarer
a window's entropy, the better its rank; windows of hardly any entropy are left out. In
every run of 64 neighbouring windows the one with the best rank gets a point, and windows with ``POINTS`` points or more
are the text's features. Feature hashes go into Bloom filters of 256 bytes with five bits each; after 160 features
the next filter of the chain begins. Two digests are compared filter by filter: the bits they share, less those expected by
chance, as a part of the most they could share. Each filter of the shorter chain takes its best partner.

Points depend on the neighbourhood of a window only, so texts that share a passage share its features.

Defined results: a null text counts as empty and has an empty digest, which is like another empty one (1.0)
and like nothing else (0.0). In texts of less than 256 bytes too few windows stand out, so all their windows of eight bytes are
features. A longer text without features (of low entropy) has itself as its only one. Equal texts have equal digests. Very long texts are worked in overlapping segments with the
same result. The document after the last one is the first; a single document follows itself; documents
with equal ids go by a hash of the text, documents without an id come last.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

WINDOW = 64
POINTS = 16
SHORT = 256  # bytes
SHORT_WINDOW = 8
FILTER_BITS = 2048
FILTER_FEATURES = 160
LOWEST_BIN = 100  # of 1001 steps of entropy
BINS = 1002
SEGMENT = 1 << 16  # windows
BLOCK_ROWS = 1000
MAX_BLOCKS = 10_000
_REST = WINDOW - 1
_SCALE = 1 << 20
_NONE = 1 << 20  # rank of what is no window

_counts = np.arange(WINDOW + 1) / WINDOW
_G = np.rint(-_counts * np.log2(np.where(_counts > 0, _counts, 1)) * _SCALE).astype(np.int64)
_DROP = _G[:-1] - _G[1:]  # by how often the byte stays
_ADD = _G[1:] - _G[:-1]  # by how often it was there


def _segments(texts: list[bytes]) -> Iterator[tuple[list[int], list[bytes], list[tuple[int, int]]]]:
    """Groups of slices: number of the text, bytes, and the windows of the slice that count."""
    which, parts, cores, size = [], [], [], 0
    for k, text in enumerate(texts):
        windows = len(text) - _REST
        for a in range(0, max(windows, 0), SEGMENT):
            b, left = min(a + SEGMENT, windows), max(0, a - _REST)
            which.append(k)
            parts.append(text[left:b + 2 * _REST])
            cores.append((a - left, b - left))
            size += len(parts[-1])
            if size > SEGMENT:
                yield which, parts, cores
                which, parts, cores, size = [], [], [], 0
    if parts:
        yield which, parts, cores


def _bins(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entropy step of the window at every byte; whether it lies in one part; and the parts' offsets."""
    x = np.frombuffer(b"".join(parts) + bytes(WINDOW), np.uint8)
    back, ahead = np.zeros(len(x), np.uint8), np.zeros(len(x), np.uint8)
    for lag in range(1, WINDOW):  # how often a byte occurs in the 63 before and the 63 after it
        same = (x[lag:] == x[:-lag]).view(np.uint8)
        back[lag:] += same
        ahead[:-lag] += same
    steps = _DROP[ahead[:-WINDOW]] + _ADD[back[WINDOW:]]
    first = _G[np.bincount(x[:WINDOW], minlength=256)].sum()
    entropy = np.concatenate([[first], first + np.cumsum(steps)])[:len(x) - WINDOW]
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths)
    inside = np.repeat(ends, lengths) - np.arange(len(entropy)) >= WINDOW
    return (entropy * 10667) >> 26, inside, ends - lengths


def entropy_counts(docs: DataFrame, *, text: str = "text") -> np.ndarray:
    """How many windows of the corpus have each step of entropy."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(BINS, np.int64)
        for batch in batches:
            for _, parts, cores in _segments(batch["_t"].tolist()):
                bins, inside, offsets = _bins(parts)
                counted = np.zeros(len(bins), bool)
                for o, (a, b) in zip(offsets, cores):
                    counted[o + a:o + b] = True
                total += np.bincount(bins[inside & counted], minlength=BINS)
        yield pd.DataFrame({"bin": np.arange(BINS, dtype=np.int32), "n": total})

    rows = docs.select(F.col(text).cast("binary").alias("_t")).where(F.col("_t").isNotNull())
    out = np.zeros(BINS, np.int64)
    for bin_, n in rows.mapInPandas(count, "bin int, n long").groupBy("bin").agg(F.sum("n")).collect():  # BINS rows
        out[bin_] = n
    return out


def ranks_of(counts: np.ndarray) -> np.ndarray:
    """Rank of each step of entropy, the rarest first; steps of hardly any entropy have none."""
    ranks = np.empty(BINS, np.int64)
    ranks[np.lexsort((np.arange(BINS), counts))] = np.arange(BINS)
    ranks[:LOWEST_BIN] = _NONE
    return ranks


def _features(texts: list[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    """Feature hashes of each text, in order, each once."""
    found: list[list[int]] = [[] for _ in texts]
    for which, parts, cores in _segments(texts):
        bins, inside, offsets = _bins(parts)
        keys = np.full(len(bins) + 3 * _REST, _NONE << 32, np.int64)
        keys[_REST:_REST + len(bins)] = np.where(inside, ranks[bins], _NONE) << 32
        keys |= np.arange(len(keys))
        reach = 1
        while reach < WINDOW:  # least key of 64 neighbours, by doubling
            keys = np.minimum(keys[:-reach], keys[reach:])
            reach *= 2
        edges = np.flatnonzero(np.diff(keys & 0xFFFFFFFF, prepend=-1, append=-1))
        best, points = keys[edges[:-1]], np.diff(edges)
        at = (best[(points >= POINTS) & (best >> 32 < _NONE)] & 0xFFFFFFFF) - _REST
        part = np.searchsorted(offsets, at, side="right") - 1
        local = at - offsets[part]
        limits = np.array(cores)
        good = (local >= limits[part, 0]) & (local < limits[part, 1])
        for p, i in zip(part[good].tolist(), local[good].tolist()):
            found[which[p]].append(xxhash.xxh64_intdigest(parts[p][i:i + WINDOW], 0))
    out = []
    for text, hashes in zip(texts, found):
        if len(text) < SHORT:
            hashes = [xxhash.xxh64_intdigest(text[i:i + SHORT_WINDOW], 2) for i in range(max(1, len(text) - SHORT_WINDOW + 1))] if text else []
        elif not hashes:
            hashes = [xxhash.xxh64_intdigest(text, 1)]
        out.append(np.array(list(dict.fromkeys(hashes)), dtype=np.uint64))
    return out


def _filters(features: np.ndarray) -> np.ndarray:
    """The chain of Bloom filters, a row of 32 words each."""
    count = -(-len(features) // FILTER_FEATURES)
    bits = np.zeros((count, FILTER_BITS), np.uint8)
    chain = np.arange(len(features)) // FILTER_FEATURES
    for k in range(5):
        bits[chain, (features >> np.uint64(11 * k)).astype(np.int64) & (FILTER_BITS - 1)] = 1
    return np.packbits(bits, axis=1).view(np.uint64)


def digests(texts: list[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    return [_filters(f) for f in _features(texts, ranks)]


def encode(digest: np.ndarray) -> str:
    return base64.b64encode(digest.tobytes()).decode()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """From 0 (no more in common than by chance) to 1."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) > len(b):
        a, b = b, a
    n_b = np.bitwise_count(b).sum(axis=1, dtype=np.int64)
    total = weight = 0.0
    for row in a:
        shared = np.bitwise_count(row & b).sum(axis=1, dtype=np.int64)
        n_a = int(np.bitwise_count(row).sum())
        most = np.minimum(n_a, n_b)
        chance = n_a * n_b / FILTER_BITS
        floor = chance + 0.2 * (most - chance)
        best = float(np.max((shared - floor) / np.maximum(most - floor, 1e-9)))
        total += n_a * min(max(best, 0.0), 1.0)
        weight += n_a
    return total / weight


def _in_blocks(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows in blocks of descending id, and behind each block a copy of the row that follows it."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    blocks = min(MAX_BLOCKS, -(-rows.count() // BLOCK_ROWS)) or 1
    marks = rows.agg(F.percentile_approx("doc_id", [k / blocks for k in range(1, blocks)] or [0.5], 100_000)).first()[0] or []
    bounds = np.unique(np.array(marks[:blocks - 1], dtype=np.int64))

    @pandas_udf("int")
    def block(ids: pd.Series) -> pd.Series:
        return pd.Series(len(bounds) - np.searchsorted(bounds, ids.to_numpy(np.int64), side="left"))

    rows = rows.withColumn("_block", F.when(F.col("doc_id").isNull(), F.lit(len(bounds))).otherwise(block(F.coalesce("doc_id", F.lit(0)).cast("long"))))
    rows = rows.withColumn("_tie", F.xxhash64("text"))
    heads = rows.groupBy("_block").agg(F.max(F.struct("doc_id", "_tie")).alias("h")).orderBy("_block").collect()  # MAX_BLOCKS rows
    if not heads:
        return rows.withColumn("_copy", F.lit(False))
    follows = [(h["_block"], h["h"]["doc_id"], h["h"]["_tie"], heads[k - 1]["_block"]) for k, h in enumerate(heads)]
    kind = docs.schema[doc_id].dataType.simpleString()
    table = F.broadcast(docs.sparkSession.createDataFrame(follows, f"_b int, _id {kind}, _t long, _before int"))
    joined = rows.join(table, F.col("_block") == F.col("_b"))
    is_head = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_tie") == F.col("_t"))
    place = F.struct(F.col("_block").alias("b"), F.lit(False).alias("c"))
    copy = F.struct(F.col("_before").alias("b"), F.lit(True).alias("c"))
    return (joined.withColumn("_p", F.explode(F.when(is_head, F.array(place, copy)).otherwise(F.array(place))))
            .select("doc_id", "text", "_tie", F.col("_p.b").alias("_block"), F.col("_p.c").alias("_copy")))


def fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Digest of every text and of its edited text, whose last third comes from the next document in descending order."""
    ranks = ranks_of(entropy_counts(docs, text=text))
    ordered = _in_blocks(docs, doc_id, text).repartition("_block").sortWithinPartitions("_block", "_copy", F.desc_nulls_last("doc_id"), F.desc("_tie"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[tuple] = []  # rows that are not answered yet: block, copy, id, text
        size = 0
        for batch in batches:
            for row in zip(batch["_block"], batch["_copy"], batch["doc_id"], batch["text"]):
                waiting.append(row)
                size += len(row[3])
                if size > SEGMENT and len(waiting) > 1:
                    yield from answer(waiting)
                    waiting, size = waiting[-1:], len(waiting[-1][3])
        yield from answer(waiting)

    def answer(rows: list[tuple]) -> Iterator[pd.DataFrame]:
        """Results of all rows but the last, each with the one behind it; nothing where all of these are copies of heads."""
        mine = [k for k in range(len(rows) - 1) if not rows[k][1]]
        if not mine:
            return
        edited = []
        for k in mine:
            own, after = rows[k][3], rows[k + 1][3]
            cut = len(own) // 3
            edited.append(own[:len(own) - cut] + after[:cut])
        plain = [r[3].encode() for r in rows]
        changed = [e.encode() for e in edited]
        made = digests(plain + changed, ranks)
        out = {"doc_id": [rows[k][2] for k in mine], "n_chars": [len(rows[k][3]) for k in mine],
               "edited_sha256": [hashlib.sha256(e).hexdigest() for e in changed],
               "fingerprint": [encode(made[k]) for k in mine], "edited_fingerprint": [encode(d) for d in made[len(plain):]],
               "near_edited": [likeness(made[k], d) for k, d in zip(mine, made[len(plain):])], "near_next": [likeness(made[k], made[k + 1]) for k in mine]}
        yield pd.DataFrame(out)

    # ids go as text: pandas would turn whole numbers with a null among them into floats
    found = ordered.select("_block", "_copy", F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(
        run, "doc_id string, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    return found.withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))
