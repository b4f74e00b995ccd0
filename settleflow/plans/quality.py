"""Data-quality probes and maintenance jobs."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal, InvalidOperation
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from settleflow.functions.scalars import flag
from settleflow.operators.filters import contains_text, half_open
from settleflow.operators.numbering import join_null_safe
from settleflow.operators.state import insert_rows, set_where_key, update_rows


def first_rows(frame: DataFrame, order: list, top: int | None) -> DataFrame:
    """The first ``top`` rows in an order for a look at the screen; all rows, unsorted, without ``top``."""
    return frame if top is None else frame.orderBy(*order).limit(top)


def duplicate_claims(links: DataFrame, top: int | None = None) -> DataFrame:
    """Claims paid back more than once; with ``top`` the most frequent ones."""
    found = links.groupBy("claim_code").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    return first_rows(found, [F.col("times").desc(), "claim_code"], top)


def claims_without_document(claims: DataFrame, paybacks: DataFrame, documents: DataFrame, since: str, skipped_type: int = 7, top: int | None = None) -> DataFrame:
    """Paid-back claims nobody filed a document for; with ``top`` those of the newest pay-backs."""
    heads = paybacks.filter((F.col("group_type") != skipped_type) & half_open("created_at", since, None)).select("payback_id", "payback_code", "transfer_id", "created_at")
    open_claims = claims.join(documents.select("claim_code"), "claim_code", "left_anti")
    found = open_claims.join(heads, "payback_id").select("claim_code", "payback_code", "transfer_id", "created_at")
    return first_rows(found, [F.col("created_at").desc(), "claim_code"], top)


def unanswered_items(items: DataFrame, results: DataFrame, received: DataFrame) -> DataFrame:
    """Billed items without a result, on bills nothing was received for."""
    return (items.join(results.select("item_code"), "item_code", "left_anti").join(received.select("bill_code"), "bill_code", "left_anti")
            .select("bill_code", "billing_date", "item_code", "amount_total").distinct())


def pending_import(details: DataFrame, claims: DataFrame, billed: DataFrame, insurer_id: int, product: int) -> DataFrame:
    """Pay-back details of one insurer and product with exactly one claim, not billed yet."""
    mine = details.filter((F.col("insurer_id") == insurer_id) & (F.col("group_type") == product)).join(billed.select("group_code"), "group_code", "left_anti")
    rows = mine.join(claims.select("group_code", "claim_code"), "group_code", "left")
    single = rows.groupBy("group_code").agg(F.count("claim_code").alias("claims")).filter("claims = 1").select("group_code")
    return rows.join(single, "group_code", "left_semi").select("group_code", "claim_code", "insurer_id", "amount", "created_at")


def codes_not_imported(codes: DataFrame, imported: DataFrame) -> DataFrame:
    """Listed group codes without an active import beyond the waiting state."""
    done = imported.filter(F.col("is_active") & (F.col("status_id") != 2)).select("group_code")
    return codes.join(done, "group_code", "left_anti").select("group_code")


def transfer_conflicts(transactions: DataFrame, subgroups: DataFrame, start: str, end: str | None = None) -> DataFrame:
    """Transactions of sub-groups that were both paid (5) and failed or returned (4, 6) in the period."""
    recent = transactions.filter(half_open("created_at", start, end)).filter(F.col("status_id").isin(4, 5, 6))
    odd = recent.groupBy("subgroup_id").agg(
        F.max(flag(F.col("status_id") == 5)).alias("paid"), F.max(flag(F.col("status_id") != 5)).alias("failed")).filter("paid = 1 AND failed = 1")
    return recent.join(odd.select("subgroup_id"), "subgroup_id", "left_semi").join(subgroups.select("subgroup_id", "subgroup_code"), "subgroup_id", "left")


def trace_claim_group(codes: DataFrame, details: DataFrame, claims: DataFrame, paybacks: DataFrame, transfers: DataFrame) -> DataFrame:
    """Every level a set of claim groups went through: detail, claim, pay-back, transfer."""
    mine = details.join(codes.select("group_code"), "group_code", "left_semi").select("group_code", "detail_code", "payback_id", "hospital_id")
    # pay-backs get their transfer before they meet the claims; those without one are spread by their own id, not gathered under NULL
    key = F.coalesce(F.concat(F.lit("t"), F.col("transfer_id").cast("string")), F.concat(F.lit("p"), F.col("payback_id").cast("string")))
    named = transfers.select(F.concat(F.lit("t"), F.col("transfer_id").cast(paybacks.schema["transfer_id"].dataType).cast("string")).alias("_transfer"), "transfer_code")
    moved = paybacks.select("payback_id", "payback_code", "transfer_id").withColumn("_transfer", key).join(named, "_transfer", "left").drop("_transfer")
    return (mine.join(claims.select("payback_id", "hospital_id", "claim_code"), ["payback_id", "hospital_id"], "left")
            .join(moved, "payback_id", "left").select("transfer_id", "payback_id", "hospital_id", "group_code", "detail_code", "claim_code", "payback_code", "transfer_code"))


def slice_tables(tables: dict[str, tuple[DataFrame, str]], keys: DataFrame, key: str) -> dict[str, DataFrame]:
    """Rows of every table that belong to a set of keys; ``tables`` gives frame and key column each."""
    return {name: frame.join(keys.select(F.col(key).alias(column)), column, "left_semi") for name, (frame, column) in tables.items()}


def claim_group_customers(details: DataFrame, claims: DataFrame, sources: list[DataFrame]) -> DataFrame:
    """Group, claim and customer name; sources: claim_code, customer_name."""
    names = reduce(lambda a, b: a.unionByName(b), sources)
    return details.select("group_code", "payback_id", "hospital_id").join(claims, ["payback_id", "hospital_id"], "left").join(names, "claim_code", "left").select("group_code", "claim_code", "customer_name")


def document_uploads(items: DataFrame, documents: DataFrame) -> DataFrame:
    """Uploaded and missing documents per billed claim."""
    counts = documents.groupBy("claim_code").agg(F.count(F.lit(1)).alias("documents"), F.sum(flag(F.col("is_uploaded"))).alias("uploaded"))
    return items.select("claim_code").distinct().join(counts, "claim_code", "left").withColumns({
        "documents": F.coalesce("documents", F.lit(0)), "uploaded": F.coalesce("uploaded", F.lit(0))})


def document_backfill(claims: list[DataFrame], documents: DataFrame, register: DataFrame, as_of: str, days: int = 30) -> dict[str, DataFrame]:
    """Documents of the last ``days`` whose claim is not in the register yet.

    Returns the new register rows and the documents with their upload flag set for those claims.
    """
    known = reduce(lambda a, b: a.unionByName(b), claims).select("claim_code").distinct()
    at = F.lit(as_of).cast("timestamp_ntz")
    recent = documents.filter((F.col("filed_at") > at - F.expr(f"INTERVAL {days} DAYS")) & (F.col("filed_at") <= at)).select("claim_code").distinct()
    due = recent.join(known, "claim_code", "left_semi").join(register.select("claim_code"), "claim_code", "left_anti")
    rows = documents.join(due, "claim_code", "left_semi").select("document_id", "claim_code", F.lit(2).alias("status_id"), at.alias("updated_at"), F.lit(True).alias("is_active"))
    return {"register": rows, "documents": set_where_key(documents, due, ["claim_code"], is_uploaded=F.lit(True))}


def repair_by_join(state: DataFrame, source: DataFrame, key: str, column: str) -> DataFrame:
    """Fill or correct a column from another table wherever that table has a value."""
    changes = source.filter(F.col(column).isNotNull()).select(key, column)
    return update_rows(state, changes, [key])


def log_search(log: DataFrame, start: str, end: str, text: str, top: int | None = None) -> DataFrame:
    """Log lines of a period that contain a text; with ``top`` the oldest ones."""
    rows = log.filter(half_open("logged_at", start, end)).filter(contains_text("message", text))
    return first_rows(rows, ["logged_at", "log_id"], top).select("log_id", "message", F.date_format("logged_at", "dd MM yyyy HH:mm").alias("stamp"))


def holds_value(column: str, kind: T.DataType, value: str) -> Column | None:
    """Test of a column for a value given as text, in the column's own type; None where the value can't be one of that type.

    Text columns are compared as they are, numbers by their amount, dates and times by their moment.
    """
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        return F.col(column) == value
    if isinstance(kind, T.NumericType):
        try:
            number = Decimal(value)
        except InvalidOperation:
            return None
        if not number.is_finite() or (isinstance(kind, T.IntegralType) and number != number.to_integral_value()):
            return None
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            return F.col(column) == F.lit(float(number))
        return F.col(column) == F.lit(number)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        try:
            moment = dt.datetime.fromisoformat(value)
        except ValueError:
            return None
        if isinstance(kind, T.DateType):
            return F.col(column) == F.lit(moment.date()) if moment.time() == dt.time() else None
        return F.col(column) == F.lit(moment.isoformat(sep=" ")).cast(kind)
    if isinstance(kind, T.BooleanType):
        return F.col(column) == F.lit(value.lower() == "true") if value.lower() in ("true", "false") else None
    return None


def find_value(tables: dict[str, DataFrame], value: str) -> DataFrame:
    """Where a value occurs: ``table_name, column_name, hits``, a row for each column that holds it.

    The columns to look at come from the tables' schemas. A table is read once, with those columns only.
    """
    parts = []
    for name, frame in tables.items():
        tests = {f.name: test for f in frame.schema.fields if (test := holds_value(f.name, f.dataType, value)) is not None}
        if tests:
            counts = frame.agg(*[F.count_if(test).alias(c) for c, test in tests.items()])
            pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("hits")) for c in tests]
            parts.append(counts.select(F.lit(name).alias("table_name"), F.inline(F.array(*pairs))))
    return reduce(lambda a, b: a.unionByName(b), parts).filter("hits > 0")
