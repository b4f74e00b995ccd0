"""Running codes: prefix, Buddhist-era year, optional month and a zero-padded number.

Codes are handed out for a whole set at once: the counters go in as a table and the raised
counters come out, so nothing has to be locked. How a counter table is keyed is known from the
callers only: one row per prefix, year and month, with month ``00`` for codes without a month.

A set often has one prefix only. Its rows are numbered by place (see ``numbering``), and the counters are
added to the small table of spans, so no step shuffles rows by their prefix.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settleflow.functions.scalars import join_text, zero_pad
from settleflow.operators.numbering import beside, numbered, places, spans


def period(as_of: dt.date, with_month: bool = True) -> tuple[str, str]:
    return f"{(as_of.year + 543) % 100:02d}", f"{as_of.month:02d}" if with_month else "00"


def code_text(prefix: Column, as_of: dt.date, number: Column, width: int, with_month: bool = True) -> Column:
    year, month = period(as_of, with_month)
    return join_text(prefix, F.lit(year + (month if with_month else "")), zero_pad(number, width))


def current_counters(counters: DataFrame, as_of: dt.date, with_month: bool = True) -> DataFrame:
    """``prefix`` and the last number used in the period of ``as_of``."""
    year, month = period(as_of, with_month)
    return counters.filter((F.col("year") == year) & (F.col("month") == month)).groupBy("prefix").agg(F.max("running").alias("running"))


def running_codes(rows: DataFrame, prefix: str, order: list[str], width: int, as_of: dt.date,
                  counters: DataFrame, name: str = "code", with_month: bool = True) -> tuple[DataFrame, DataFrame]:
    """Rows with their code, and the raised counters (prefix, year, month, running).

    ``order`` identifies a row of a prefix. A row without a prefix gets no code and raises no counter.
    """
    placed = places(rows, [prefix, *order], beside(rows, [prefix, *order], "_number"))  # whole, so that the rows are worked out once
    last = current_counters(counters, as_of, with_month).withColumnRenamed("prefix", prefix)
    used = spans(placed, [prefix], last)
    based = numbered(rows, placed, [prefix, *order], {"_number": ([prefix], used)})
    year, month = period(as_of, with_month)
    coded = based.select(*rows.columns, F.when(F.col(prefix).isNotNull(), code_text(F.col(prefix), as_of, F.col("_number"), width, with_month)).alias(name))
    raised = used.filter(F.col(prefix).isNotNull()).groupBy(F.col(prefix).alias("prefix")).agg(F.max(F.col("_span_before") + F.col("_span_n")).alias("running")).select(
        "prefix", F.lit(year).alias("year"), F.lit(month).alias("month"), "running")
    return coded, raised
