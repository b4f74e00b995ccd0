"""State changes as pure functions: old state and changes in, new state out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def assert_unique(changes: DataFrame, keys: list[str]) -> DataFrame:
    """``changes`` unchanged, failing at run time when a key occurs twice.

    The check rides on the partial aggregate the update needs anyway: one row per key comes out.
    """
    rest = [c for c in changes.columns if c not in keys]
    packed = changes.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.first(F.struct(*rest) if rest else F.lit(1)).alias("_row")
    )
    checked = packed.filter(
        F.when(F.col("_n") == 1, True).otherwise(
            F.raise_error(F.concat_ws(" ", F.lit("more than one change for key"), *[F.col(k).cast("string") for k in keys])).cast("boolean")
        )
    )
    return checked.select(*keys, "_row.*") if rest else checked.select(*keys)


def insert_rows(state: DataFrame, rows: DataFrame) -> DataFrame:
    return state.unionByName(rows, allowMissingColumns=True)


def update_rows(state: DataFrame, changes: DataFrame, keys: list[str], checked: bool = True) -> DataFrame:
    """Overwrite the columns that ``changes`` carries, on the keys it names.

    Matched rows take the new value even when it is NULL; other rows stay as they are.
    """
    changes = assert_unique(changes, keys) if checked else changes
    new = [c for c in changes.columns if c not in keys]
    side = changes.select(*[F.col(k).alias(f"_key_{k}") for k in keys], *[F.col(c).alias(f"_new_{c}") for c in new], F.lit(True).alias("_hit"))
    on = [F.col(k) == F.col(f"_key_{k}") for k in keys]
    joined = state.join(side, on, "left")
    return joined.select(*[
        F.when(F.col("_hit"), F.col(f"_new_{c}").cast(state.schema[c].dataType)).otherwise(F.col(c)).alias(c)
        if c in new else F.col(c)
        for c in state.columns
    ])


def set_where_key(state: DataFrame, keys_frame: DataFrame, keys: list[str], **values: Column) -> DataFrame:
    """Set columns to expressions on every row whose key occurs in ``keys_frame``."""
    side = keys_frame.select(*[F.col(k).alias(f"_key_{k}") for k in keys]).distinct().withColumn("_hit", F.lit(True))
    joined = state.join(side, [F.col(k) == F.col(f"_key_{k}") for k in keys], "left")
    return joined.select(*[
        F.when(F.col("_hit"), values[c].cast(state.schema[c].dataType)).otherwise(F.col(c)).alias(c)
        if c in values else F.col(c)
        for c in state.columns
    ])


def delete_rows(state: DataFrame, keys_frame: DataFrame, keys: list[str]) -> DataFrame:
    return state.join(keys_frame.select(*keys), keys, "left_anti")


def delete_then_insert(state: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Replace all rows of the keys that ``rows`` brings."""
    return insert_rows(delete_rows(state, rows, keys), rows)


def soft_delete(state: DataFrame, keys_frame: DataFrame, keys: list[str], flag: str = "is_active") -> DataFrame:
    return set_where_key(state, keys_frame, keys, **{flag: F.lit(False)})


def upsert_rows(state: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Update the keys that exist, insert those that do not."""
    fresh = rows.join(state.select(*keys), keys, "left_anti")
    return insert_rows(update_rows(state, rows, keys), fresh)


def consume_rows(staging: DataFrame, used: DataFrame, keys: list[str]) -> DataFrame:
    """Staging rows that are left after the used ones are taken out."""
    return delete_rows(staging, used, keys)
