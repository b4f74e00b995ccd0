"""Packing an ordered list of amounts under a ceiling (next-fit).

The running total starts again whenever the next amount would take it above the ceiling, so a group
number depends on all rows before it. To keep one long list from ending up in one task the rows are placed
by range (see ``numbering``) and walked in pieces of ``PIECE`` rows.

Only the first list of a piece depends on the piece before, and only through the total it starts with: the more
that is, the earlier the first group ends, and from there on the starting total no longer matters. So a piece is
summed up as a step function: for each row that may end the first group the least starting total that
makes it so, the total at the end and the number of groups opened. Two walks that start at different rows
mostly fall into step, and neighbouring steps with the same end are one. The pieces of a list are then put together in
order, in one pass over the steps, which gives every piece's starting total; a last pass numbers the rows.
Walks inside a piece use cumulative sums and one search for all rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settleflow.operators.numbering import join_null_safe, places, small
from settleflow.sources.work import stored

# functions go to the executors by value, so that the library need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIECE = 100_000  # rows of a piece
# least: from this starting total on; moves: the total at the end is the starting total plus ``ends``, NULL where a list begins inside of a piece
STEPS = ["_list", "_piece", "least", "ends", "opened", "moves"]


def next_fit(frame: DataFrame, key: str, order: list[str], amount: Column, ceiling, name: str = "group_no", piece: int = PIECE) -> DataFrame:
    """Group number per row of each ``key``, in ``order`` (which identifies a row of a key).

    ``amount`` has two decimals; sums are kept in whole cents. A NULL amount counts as nothing. The first
    group is 1; a first amount above the ceiling opens group 2. Rows without a key are one list.
    """
    limit = int(round(float(ceiling) * 100))
    cents = F.coalesce((amount.cast("decimal(18,2)") * 100).cast("long"), F.lit(0))
    columns, keys = frame.columns, [key, *order]
    placed = places(frame.withColumn("_cents", cents), keys, ["_cents"])
    rows = placed.withColumn("_piece", F.shiftleft(F.col("_part").cast("long"), 33) + F.floor(F.col("_at") / piece)).withColumn(
        "_list", F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit("")))
    walked = rows.join(small(_entries(rows, limit)), "_piece", "left")

    def number(table: pa.Table) -> pa.Table:
        table = table.sort_by("_at")
        total, opened = (table.column(c)[0].as_py() for c in ("total", "opened"))
        groups = _groups(_starts(table.column("_list")), table.column("_cents").to_numpy(), limit, total, opened)
        return table.select(keys).append_column(name, pa.array(groups, pa.int64()))

    kept = walked.select("_piece", "_at", *keys, "_list", "_cents", "total", "opened")
    schema = placed.select(*keys).withColumn(name, F.lit(1).cast("long")).schema
    numbers = kept.groupBy("_piece").applyInArrow(number, schema)
    return join_null_safe(frame.drop(name), numbers, keys).select(*columns, name)


def _entries(rows: DataFrame, limit: int) -> DataFrame:
    """Per piece that goes on with a list: the total it starts with and the groups opened before."""

    def steps(table: pa.Table) -> pa.Table:
        table = table.sort_by("_at")
        starts, cents = _starts(table.column("_list")), table.column("_cents").to_numpy()
        names, here = table.column("_list"), table.column("_piece")[0].as_py()
        out = [(names[0].as_py(), here, *s) for s in _steps(cents[:starts[1] if len(starts) > 1 else None], limit)]
        if len(starts) > 1:  # the last list begins here
            groups = _groups(starts[:1], cents[starts[-1]:], limit)
            last = cents[starts[-1]:][groups == groups[-1]].sum()
            out.append((names[int(starts[-1])].as_py(), here, 0, int(last), int(groups[-1]), None))
        return pa.Table.from_arrays([pa.array(c) for c in zip(*out)], names=STEPS)

    narrow = rows.select("_piece", "_at", "_list", "_cents")
    found = narrow.groupBy("_piece").applyInArrow(steps, "_list string, _piece long, least long, ends long, opened long, moves boolean")
    ordered = found.repartition("_list").sortWithinPartitions("_list", "_piece", "least")
    return stored(ordered.mapInArrow(_put_together, "_piece long, total long, opened long"), "entries")


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Follow each list through its pieces; of a piece's steps the last one with ``least`` up to the total counts."""
    now = piece = taken = None
    total, opened = 0, None
    out: list[tuple] = []

    def leave() -> None:
        nonlocal total, opened
        if taken is not None:
            ends, more, moves = taken
            total = total + ends if moves else ends
            opened = more if opened is None else opened + more

    for batch in batches:
        for name, at, least, ends, more, moves in zip(*(c.to_pylist() for c in batch.columns)):
            if (name, at) != (now, piece):
                leave()
                if name != now:
                    total, opened = 0, None
                now, piece, taken = name, at, None
                if moves is not None and opened is not None:
                    out.append((at, total, opened))
            if moves is None:  # the list begins inside of this piece
                taken, opened = (ends, more, False), None
            elif opened is None:
                if least <= 0:  # it begins with this piece
                    taken = (ends, more + 1, moves)
            elif least <= total:
                taken = (ends, more, moves)
        yield _entry_batch(out)
        out = []


def _entry_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["_piece", "total", "opened"])


def _starts(lists: pa.ChunkedArray) -> np.ndarray:
    """Row numbers at which a list begins."""
    values = lists.combine_chunks().dictionary_encode().indices.to_numpy()
    return np.r_[0, np.flatnonzero(values[1:] != values[:-1]) + 1]


def _next_begins(cents: np.ndarray, limit: int, ends: np.ndarray) -> list[int]:
    """For each row, if a group begins there, the row at which the next one does: at the end of its list (``ends``) at the latest."""
    rows = np.arange(len(cents))
    if len(cents) and cents.min() < 0:  # sums that also fall: step on from each row
        found, values, last = [], cents.tolist(), ends.tolist()
        for i, total in enumerate(values):
            j = i + 1
            while j < last[i] and total + values[j] <= limit:
                total += values[j]
                j += 1
            found.append(j)
        return found
    sums = np.cumsum(cents)
    return np.minimum(np.maximum(np.searchsorted(sums, sums - cents + limit, "right"), rows + 1), ends).tolist()


def _steps(cents: np.ndarray, limit: int) -> list[tuple[int, int, int, bool]]:
    """A list's stretch as a function of its starting total: least total, total at the end, groups opened, whether the total moves on.

    Rows at which the first group can end are those where the sum so far is higher than ever before.
    """
    sums, n = np.cumsum(cents), len(cents)
    follow, opened, ends = _next_begins(cents, limit, np.full(n, n)), [0] * n, [0] * n
    whole = int(sums[-1])
    for i in range(n - 1, -1, -1):
        j = follow[i]
        opened[i], ends[i] = (1, whole - int(sums[i]) + int(cents[i])) if j >= n else (opened[j] + 1, ends[j])
    highest = np.maximum.accumulate(sums)
    peaks = np.flatnonzero(np.r_[True, highest[1:] > highest[:-1]])
    # the first group ends at row i from a total of limit - sum + 1 on
    steps = [(limit - int(sums[i]) + 1, ends[i], opened[i], False) for i in peaks]
    steps.append((-(1 << 62), whole, 0, True))
    steps.reverse()
    kept = [steps[0]]
    for step in steps[1:]:
        if step[1:] != kept[-1][1:]:
            kept.append(step)
    return kept


def _groups(starts: np.ndarray, cents: np.ndarray, limit: int, total: int | None = None, opened: int | None = None) -> np.ndarray:
    """Group numbers of a piece's rows; the first list goes on from ``total`` and ``opened`` groups if these are given."""
    n, lengths = len(cents), np.diff(np.r_[starts, len(cents)])
    follow = _next_begins(cents, limit, np.repeat(starts + lengths, lengths))
    begins, i = np.zeros(n, np.int64), 0
    base = 1 + (cents[starts] > limit)  # a first amount above the ceiling opens the second group
    if opened is not None:
        above = np.flatnonzero(np.cumsum(cents[:lengths[0]]) + total > limit)
        i = int(above[0]) if len(above) else int(lengths[0])
    while i < n:
        begins[i] = 1
        i = follow[i]
    count = np.cumsum(begins)
    before = count[starts]
    if opened is not None:
        base[0], before[0] = opened, 0
    return count - np.repeat(before - base, lengths)
