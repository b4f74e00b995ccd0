"""Mixing sources to target weights by Pfair scheduling.

The rows of each source are put in a random but fixed order and cut into blocks. A source with weight
``w`` must have its block ``j`` (from 0) placed in the window from slot ``floor(j / w)`` to slot
``ceil((j + 1) / w)``; in every slot the released block with the earliest deadline goes first. So after any
number of slots a source is less than one block away from its weight, however long the mixture gets: windows come from the
weights themselves. When a source has no blocks left, a new phase begins with the weights of the others scaled up;
every row is placed exactly once, none is dropped or repeated.

The schedule is worked out on the driver and sent to the tasks. It has at most ``MAX_BLOCKS`` slots whatever the size of the
data: blocks have ``LEAST_ROWS`` rows, or as many as that takes. The ``MAX_LANES - 1`` sources with the most rows have a lane
each, and should there be more sources, the others share one more lane with the sum of their weights. Without given weights a lane's weight
is its number of rows to the power ``temperature``.

Rows are numbered within a lane by buckets of their hash, so a hot source is spread over many tasks.

Defined results: a null source is a lane like any other; sources without a given weight, or with one of
zero or less, come last, behind all weighted blocks, in proportion to their rows; null and repeated ids and texts are placed like any
other row (identical rows are interchangeable); an empty table gives an empty result. Columns that have
the names of new ones are replaced, all others stay as they are.
"""

from __future__ import annotations

import heapq
import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

LEAST_ROWS = 64
MAX_BLOCKS = 1 << 18
MAX_LANES = 4096
BUCKET_ROWS = 4_000


def earliest_deadline_first(blocks: list[int], weights: list[float], most: int | None = None) -> tuple[list[int], list[int]]:
    """Lanes of the slots until a lane has no blocks left (or of the first ``most``), and the blocks that are left over of each."""
    exact = [Fraction(repr(float(w))) for w in weights]  # the decimal number as given
    scale = math.lcm(*(w.denominator for w in exact))
    whole = [int(w * scale) for w in exact]
    period = sum(whole)
    coming = [(0, k) for k in range(len(blocks))]  # release times
    ready: list[tuple[int, int]] = []  # deadlines
    placed, slots, left = [0] * len(blocks), [], list(blocks)
    while True:
        while coming and coming[0][0] <= len(slots):
            k = heapq.heappop(coming)[1]
            heapq.heappush(ready, (-(-(placed[k] + 1) * period // whole[k]), k))
        k = heapq.heappop(ready)[1]
        slots.append(k)
        placed[k] += 1
        left[k] -= 1
        if not left[k] or len(slots) == most:
            return slots, left
        heapq.heappush(coming, (placed[k] * period // whole[k], k))


def schedule(blocks: list[int], weights: list[float]) -> list[int]:
    """Lanes of all slots; lanes of weight zero come when all others have ended, by their size."""
    out: list[int] = []
    for chosen, pull in (([k for k, w in enumerate(weights) if w > 0], weights), ([k for k, w in enumerate(weights) if w <= 0], blocks)):
        left = {k: blocks[k] for k in chosen if blocks[k]}
        while left:
            live = list(left)
            slots, rest = earliest_deadline_first([left[k] for k in live], [pull[k] for k in live])
            out += [live[k] for k in slots]
            left = {k: n for k, n in zip(live, rest) if n}
    return out


def _table(rows: list[int], size: int, lanes: list[int]) -> pa.Table:
    """Per slot its lane, the number of its block in the lane and the rows before it."""
    lane = np.array(lanes, np.int64)
    order = np.argsort(lane, kind="stable")
    firsts = np.r_[0, np.cumsum(np.bincount(lane, minlength=len(rows)))[:-1]]
    block = np.empty(len(lane), np.int64)
    block[order] = np.arange(len(lane)) - firsts[lane[order]]
    held = np.minimum(np.array(rows, np.int64)[lane] - block * size, size)
    return pa.table({"lane": lane, "block": block, "slot": np.arange(len(lane)), "start": np.cumsum(held) - held})


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, *, block_rows: int | None = None, temperature: float = 0.5,
        seed: int = 42, source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """All rows and columns with ``slot`` (number of the row's block) and ``position`` (place in the mixture, from 0)."""
    spark = docs.sparkSession
    docs = docs.drop("slot", "position")
    own = "_mix"
    while any(c.lower().startswith(own) for c in docs.columns):
        own += "_"
    per_source = docs.groupBy(F.col(source).cast("string").alias("name")).agg(F.count(F.lit(1)).alias("rows"))
    lanes = [tuple(r) for r in per_source.orderBy(F.desc("rows"), F.asc_nulls_first("name")).limit(MAX_LANES - 1).collect()]
    total = per_source.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    if not total:
        return docs.withColumns({"slot": F.lit(None).cast("long"), "position": F.lit(None).cast("long")})
    sizes = [n for _, n in lanes]
    pull = [float(n) ** temperature for n in sizes] if weights is None else [max(0.0, float(weights.get(v, 0))) for v, _ in lanes]
    rest = total - sum(sizes)
    if rest:
        sizes.append(rest)
        pull.append(float(rest) ** temperature if weights is None else max(0.0, sum(v for v in weights.values() if v > 0) - sum(pull)))
    size = block_rows or max(LEAST_ROWS, -(-total // (MAX_BLOCKS - len(sizes))))
    slots = _table(sizes, size, schedule([-(-n // size) for n in sizes], pull))

    # bounded by MAX_BLOCKS (or the block size asked for) and MAX_LANES
    slot_table = F.broadcast(spark.createDataFrame(slots).select(
        F.col("lane").alias(f"{own}_at"), F.col("block").alias(f"{own}_b"), "slot", F.col("start").alias(f"{own}_start")))
    lane_table = F.broadcast(spark.createDataFrame(
        [(k, v, max(1, -(-n // BUCKET_ROWS))) for k, (v, n) in enumerate(lanes)], f"{own}_lane long, {own}_name string, {own}_parts long"))
    col = lambda name: F.col(f"{own}_{name}")
    rows = (docs.join(lane_table, F.col(source).cast("string").eqNullSafe(col("name")), "left")
            .withColumn(f"{own}_lane", F.coalesce(col("lane"), F.lit(len(lanes)))).withColumn(f"{own}_parts", F.coalesce(col("parts"), F.lit(max(1, -(-rest // BUCKET_ROWS)))))
            .withColumn(f"{own}_order", F.xxhash64(F.lit(seed), F.col(doc_id))).withColumn(f"{own}_tie", F.xxhash64(*docs.columns))
            .withColumn(f"{own}_bucket", F.pmod(F.xxhash64(col("order"), col("tie")), col("parts"))))
    counts = rows.groupBy(col("lane").alias(f"{own}_l"), col("bucket").alias(f"{own}_k")).agg(F.count(F.lit(1)).alias(f"{own}_n"))
    before = F.sum(col("n")).over(W.partitionBy(col("l")).orderBy(col("k")).rowsBetween(W.unboundedPreceding, -1))  # one row per bucket
    offsets = counts.withColumn(f"{own}_before", F.coalesce(before, F.lit(0)))
    place = F.row_number().over(W.partitionBy(col("lane"), col("bucket")).orderBy(col("order"), col("tie"))) - 1
    numbered = rows.withColumn(f"{own}_place", place).join(offsets, (col("lane") == col("l")) & (col("bucket") == col("k")))
    number = col("before") + col("place")
    blocked = numbered.withColumns({f"{own}_block": F.floor(number / size).cast("long"), f"{own}_inside": number % size})
    timed = blocked.join(slot_table, (col("lane") == col("at")) & (col("block") == col("b")))
    return timed.select(*docs.columns, "slot", (col("start") + col("inside")).cast("long").alias("position"))
