"""Sorted pages with a total count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sort_columns(field: str | None, direction: str | None, allowed: dict[str, str],
                 default: list[Column], tiebreak: list[str]) -> list[Column]:
    """Order for a user-chosen field; the default applies unless both choices are given."""
    if field and direction:
        if field not in allowed:
            raise ValueError(f"cannot sort by {field!r}")
        column = F.col(allowed[field])
        wish = column.desc_nulls_last() if direction.upper() == "DESC" else column.asc_nulls_first()
        return [wish, *[F.col(c).asc_nulls_first() for c in tiebreak]]
    return [*default, *[F.col(c).asc_nulls_first() for c in tiebreak]]


def with_total(frame: DataFrame, name: str = "total_count") -> DataFrame:
    """Number of all rows on every row, as a scalar subquery."""
    total = frame.agg(F.count(F.lit(1)).alias(name))
    return frame.withColumn(name, total.scalar())


def page(frame: DataFrame, order: list[Column], start: int | None = None, size: int | None = None,
         total: str | None = "total_count") -> DataFrame:
    """Rows ``start`` … ``start + size - 1`` in ``order`` with the count of all rows.

    The counting subquery scans separately; the page itself is a top-k, never a full sort.
    """
    start = 0 if start is None else start
    size = 10 if size is None else size
    counted = with_total(frame, total) if total else frame
    return counted.orderBy(*order).offset(start).limit(size)
