"""Aggregation forms used by several jobs.

Everything here aggregates map-side first; per-key results that keep one row use aggregate
functions or a ranked filter, which Spark also limits before the shuffle.
"""

from __future__ import annotations

import io
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from settleflow.operators.numbering import keyed_row_number

# functions go to the executors by value, so that the library need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def first_row_per_group(frame: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each group that comes first in ``order`` (which identifies a row)."""
    rest = [c for c in frame.columns if c not in keys]
    best = frame.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    )
    return best.select(*keys, "_row.*").select(*frame.columns)


def latest_per_key(frame: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order) = 1``.

    The rank filter is pushed below the shuffle, so a large key sends one row per task.
    """
    window = W.partitionBy(*keys).orderBy(*order)
    return frame.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def sum_when(test: Column, value: Column) -> Column:
    return F.sum(F.when(test, value))


def count_when(test: Column) -> Column:
    return F.count(F.when(test, 1))


def all_true(test: Column) -> Column:
    """1 when the test holds on every row of the group."""
    return F.when(F.count(F.when(test, 1)) == F.count(F.lit(1)), 1).otherwise(0)


def ordered_lines(frame: DataFrame, keys: list[str], order: list[str], name: str = "line_no") -> DataFrame:
    """The rows of each key numbered in ``order``: a history as rows, of any length, spread over many tasks."""
    return keyed_row_number(frame, keys, order, name)


def text_list(frame: DataFrame, keys: list[str], value: str, order: list[str], sep: str, name: str) -> DataFrame:
    """Ordered values as one text per key, whole; NULL values are left out.

    Rows are sorted by key and ``order`` on disk if need be, and each key's text grows row by row, so a task holds the
    text it is about to hand out, never a list of a key's rows. Where a text may be too long for one cell, ask for
    ``ordered_lines``.
    """
    kept = frame.filter(F.col(value).isNotNull()).select(*keys, *[F.col(c).alias(f"_order{i}") for i, c in enumerate(order)], F.col(value).cast("string").alias("_value"))
    ordered = kept.repartition(*keys).sortWithinPartitions(*keys, *[f"_order{i}" for i in range(len(order))]).select(*keys, "_value")
    schema = kept.select(*keys).withColumn(name, F.lit("")).schema

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = None
        now, text = None, io.StringIO()

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*(pa.array([v], t) for v, t in zip(now, types)), pa.array([text.getvalue()], pa.string())], names=[*keys, name])

        for batch in batches:
            types = [batch.column(k).type for k in keys]
            for *key, line in zip(*(batch.column(c).to_pylist() for c in [*keys, "_value"])):
                if now != key:
                    if now is not None:
                        yield row()
                    now, text = key, io.StringIO()
                else:
                    text.write(sep)
                text.write(line)
        if now is not None:
            yield row()

    return ordered.mapInArrow(join, schema)


def distinct_text(frame: DataFrame, keys: list[str], value: str, sep: str, name: str) -> DataFrame:
    """Distinct values of each group in ascending order as one text.

    Meant for values from a small code list; duplicates go away while sets are built, on both sides of the one shuffle.
    """
    listed = frame.groupBy(*keys).agg(F.collect_set(value).alias("_list"))
    return listed.select(*keys, F.array_join(F.array_sort("_list"), sep).alias(name))


def pivot_values(frame: DataFrame, keys: list[str], column: str, codes: dict, value: Column, how=F.max) -> DataFrame:
    """One output column per listed code, as conditional aggregates in a single pass."""
    return frame.groupBy(*keys).agg(
        *[how(F.when(F.col(column) == code, value)).alias(name) for code, name in codes.items()]
    )
