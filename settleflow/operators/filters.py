"""Filters built from optional parameters."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def half_open(column: str, start: str | dt.date | None, end: str | dt.date | None) -> Column:
    """``start <= column < end + 1 day``; a missing bound leaves that side open.

    The bounds are plain literals, so the comparison reaches the Parquet scan.
    """
    tests = []
    if start is not None:
        tests.append(F.col(column) >= F.lit(str(start)).cast("timestamp_ntz"))
    if end is not None:
        after = dt.date.fromisoformat(str(end)) + dt.timedelta(days=1)
        tests.append(F.col(column) < F.lit(str(after)).cast("timestamp_ntz"))
    return reduce(Column.__and__, tests, F.lit(True))


def keep_where(frame: DataFrame, **wanted) -> DataFrame:
    """Equality on every parameter that is given; the others leave no trace in the plan."""
    for column, value in wanted.items():
        if value is None:
            continue
        many = isinstance(value, (list, tuple, set))
        frame = frame.filter(F.col(column).isin(*value) if many else F.col(column) == F.lit(value))
    return frame


def contains_text(column: str, text: str | None) -> Column:
    """Literal substring search; ``%`` and ``_`` in the text have no special meaning."""
    return F.lit(True) if not text else F.col(column).contains(text)


def code_list(frame_or_spark, text: str, name: str = "code") -> DataFrame:
    """Distinct, non-blank elements of a comma-separated list, one per row."""
    spark = getattr(frame_or_spark, "sparkSession", frame_or_spark)
    return split_codes(spark.range(1).select(F.lit(text).alias("_list")), "_list", name)


def split_codes(frame: DataFrame, column: str, name: str = "code") -> DataFrame:
    """Distinct, non-blank elements of a comma-separated text column."""
    return (
        frame.select(F.explode(F.split(F.col(column), ",")).alias(name))
        .select(F.trim(F.col(name)).alias(name))
        .filter(F.col(name) != "")
        .distinct()
    )
