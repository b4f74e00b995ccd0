"""Join forms beyond a plain equi join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def values_table(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    """A literal table inside the plan; its size is fixed by the code that spells it out."""
    structs = [F.struct(*[F.lit(v).alias(c) for c, v in zip(columns, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def map_value(key: Column, pairs: dict) -> Column:
    """Look a key up in a handful of fixed pairs; NULL when it is not among them."""
    chosen = None
    for k, v in pairs.items():
        value = F.lit(v)
        chosen = F.when(key == F.lit(k), value) if chosen is None else chosen.when(key == F.lit(k), value)
    return chosen


def or_join(left: DataFrame, right: DataFrame, keys: list[str], right_key: str) -> DataFrame:
    """``left LEFT JOIN right ON right_key = key1 OR right_key = key2 …`` for a lookup on the right.

    ``right_key`` is unique on the right, so every key finds at most one row. One equi join per
    key replaces the nested-loop join a disjunction would need; equal keys match once, and a left
    row without any match stays with NULLs.
    """
    columns = right.columns
    wide = left
    hits = []
    for i, key in enumerate(keys):
        packed = right.select(
            F.col(right_key).alias(f"_k{i}"), F.struct(*columns).alias(f"_hit{i}")
        )
        earlier = [F.col(key).eqNullSafe(F.col(k)) for k in keys[:i]]
        repeated = F.lit(False)
        for test in earlier:
            repeated = repeated | test
        wide = wide.join(packed, F.col(key) == F.col(f"_k{i}"), "left").drop(f"_k{i}")
        hits.append(F.when(~repeated, F.col(f"_hit{i}")))
    found = F.array_compact(F.array(*hits))
    return wide.select(*left.columns, F.inline_outer(found))


def positional_pair(left: DataFrame, right: DataFrame, left_order: list[str], right_order: list[str]) -> DataFrame:
    """Pair the n-th row of one set with the n-th row of another."""
    from settleflow.operators.numbering import global_row_number

    a = global_row_number(left, left_order, "_n")
    b = global_row_number(right, right_order, "_n")
    return a.join(b, "_n").drop("_n")
