"""Insurer results: preview, application and manual cover entries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settleflow.functions import messages as M
from settleflow.functions.codes import code_text, current_counters
from settleflow.functions.scalars import first_message, flag, money
from settleflow.operators.numbering import global_row_number
from settleflow.operators.state import insert_rows, set_where_key, update_rows

# fixed values: decisions
APPROVED, PARTIAL, REJECTED = 2, 3, 4
# fixed values: result codes start with this prefix and carry six digits
RESULT_PREFIX, RESULT_WIDTH = "TCB", 6


def chosen_bills(items: DataFrame, rejects: DataFrame, tmp_codes: DataFrame | None = None,
                 bill_codes: DataFrame | None = None) -> DataFrame:
    """Bills named directly, or having a rejection under one of the import codes: bill_code, tmp_code."""
    if tmp_codes is not None:
        hit = rejects.select("item_code", "tmp_code").join(tmp_codes.select("tmp_code"), "tmp_code", "left_semi")
        # one code per bill: an import that spans several codes files under the lowest
        return (items.select("item_code", "bill_code").join(hit, "item_code")
                .groupBy("bill_code").agg(F.min("tmp_code").alias("tmp_code")))
    return (items.select("bill_code").distinct().join(bill_codes.select("bill_code"), "bill_code", "left_semi")
            .withColumn("tmp_code", F.lit(None).cast("string")))


def classify(items: DataFrame, rejects: DataFrame) -> DataFrame:
    """Decision and amounts per bill item.

    Approved without a rejection, partial when something but not all remains, otherwise rejected;
    the cover is what remains of the claim, whichever way the item was decided.
    """
    per_item = rejects.groupBy("item_code").agg(
        money(F.sum("rejected_amount")).alias("rejected_amount"), F.max("rejected_remark").alias("rejected_remark"))
    remaining = F.coalesce("amount_total", F.lit(0)) - F.coalesce("rejected_amount", F.lit(0))
    decision = (F.when(F.col("rejected_amount").isNull(), APPROVED)
                .when((remaining > 0) & (remaining < F.col("amount_total")), PARTIAL).otherwise(REJECTED))
    out = items.join(per_item, "item_code", "left").withColumn("decision_id", decision)
    return out.withColumns({
        "result_cover": money(F.col("pay_total") - F.coalesce("rejected_amount", F.lit(0))),
        "result_uncover": money(F.coalesce("rejected_amount", F.lit(0))),
        "payment": money(F.when(F.col("decision_id") == PARTIAL, remaining).otherwise(F.col("amount_total"))),
    })


def apply_results(items: DataFrame, results: DataFrame, rejects: DataFrame, received: DataFrame, counters: DataFrame,
                  as_of: dt.date, payment_date: str, tmp_codes: DataFrame | None = None,
                  bill_codes: DataFrame | None = None) -> dict[str, DataFrame]:
    """Fold the insurer's answer into the result tables.

    ``results`` is the current state: item_code, bill_code, cover_amount, uncover_amount, remark,
    decision_id, estimated_on. The job applies to all chosen bills or to none: when one of them was
    received before (``received``: bill_code, status_id 2 or 3), ``check`` says so and nothing changes.
    """
    chosen = chosen_bills(items, rejects, tmp_codes, bill_codes)
    repeated = received.filter(F.col("status_id").isin(2, 3)).select("bill_code").distinct().join(chosen, "bill_code", "left_semi")
    blocked = repeated.agg(F.count(F.lit(1)).alias("n"))
    check = blocked.select(
        flag(F.col("n") == 0).alias("is_result"), F.when(F.col("n") > 0, M.ALREADY_IMPORTED).alias("message"), F.col("n").alias("repeated_bills"))
    allowed = chosen.withColumn("_blocked", blocked.scalar()).filter("_blocked = 0").drop("_blocked")
    if tmp_codes is None:
        # bills without an import code get a running one, in bill order
        used = current_counters(counters.filter(F.col("prefix") == RESULT_PREFIX), as_of).agg(F.max("running").alias("m"))
        allowed = global_row_number(allowed.drop("tmp_code"), ["bill_code"], "_n").withColumn("_used", used.scalar()).select(
            "bill_code", code_text(F.lit(RESULT_PREFIX), as_of, F.coalesce("_used", F.lit(0)) + F.col("_n"), RESULT_WIDTH).alias("tmp_code"))
    decided = classify(items.join(allowed, "bill_code"), rejects)
    stored = F.when(F.col("decision_id").isin(APPROVED, PARTIAL), APPROVED).otherwise(F.col("decision_id"))
    rows = decided.select(
        "item_code", "bill_code", F.col("result_cover").alias("cover_amount"), F.col("result_uncover").alias("uncover_amount"),
        F.col("rejected_remark").alias("remark"), stored.cast("int").alias("decision_id"), F.lit(payment_date).cast("date").alias("estimated_on"))
    fresh = rows.join(results.select("item_code"), "item_code", "left_anti")
    if tmp_codes is not None:
        changed = rows.select("item_code", "cover_amount", "uncover_amount", "decision_id", "estimated_on")
        state = update_rows(results, changed, ["item_code"], checked=False)
    else:
        state = results
    kept = decided.filter(F.col("decision_id") != REJECTED)
    return {
        "check": check,
        "receipts": kept.select("tmp_code", "item_code", "bill_code", "result_cover", "result_uncover", "decision_id", "payment"),
        "received": kept.select("tmp_code", "bill_code", "billing_date", "insurer_id", "claim_type_code").distinct(),
        "headers": fresh.select("bill_code").distinct(),
        "results": insert_rows(state, fresh),
        "rejects": set_where_key(rejects, decided, ["item_code"], is_active=F.lit(False)),
    }


def result_preview(items: DataFrame, bills: DataFrame, results: DataFrame, rejects: DataFrame, received: DataFrame,
                   tmp_codes: DataFrame | None = None, bill_codes: DataFrame | None = None) -> DataFrame:
    """Sums and counts per billing date for bills not received yet, from items to bills to dates in one pass.

    ``bill_list`` names the bills of the date (one per insurer and claim type); item count and total
    amount cover all previewed bills and stand on every row.
    """
    done = received.filter(F.col("status_id").isin(2, 3)).select("bill_code").distinct()
    refused = results.filter(F.col("decision_id") == REJECTED).select("item_code").distinct().withColumn("is_refused", F.lit(1))
    asked = F.lit(1)
    if tmp_codes is not None:  # rejections under one of the import codes
        rejects = rejects.join(tmp_codes.select("tmp_code").distinct().withColumn("is_asked", F.lit(1)), "tmp_code", "left")
        asked = F.coalesce("is_asked", F.lit(0))
    per_item = rejects.groupBy("item_code").agg(money(F.sum("rejected_amount")).alias("rejected_amount"), F.max(asked).alias("is_asked"))
    rows = items.select("item_code", "bill_code", "billing_date", "amount_total").join(per_item, "item_code", "left").join(refused, "item_code", "left")
    remaining = F.coalesce("amount_total", F.lit(0)) - F.coalesce("rejected_amount", F.lit(0))
    is_approved = F.col("rejected_amount").isNull()
    is_partial = ~is_approved & (remaining > 0) & (remaining < F.col("amount_total"))
    is_rejected = ~is_approved & ~F.coalesce(is_partial, F.lit(False))
    zero = F.lit(0)
    measures = {
        "approved_amount": F.when(is_approved, F.col("amount_total")).otherwise(zero), "rejected_amount": F.when(is_rejected, F.col("rejected_amount")).otherwise(zero),
        "partial_amount": F.when(is_partial, remaining).otherwise(zero), "partial_rejected": F.when(is_partial, F.col("rejected_amount")).otherwise(zero),
        "approved_items": flag(is_approved), "rejected_items": flag(is_rejected), "partial_items": flag(is_partial)}
    # items to bills: what a bill asks for and whether it is open (one of its items was not finally rejected)
    per_bill = rows.groupBy("bill_code", "billing_date").agg(
        F.max(F.coalesce("is_asked", F.lit(0)) if tmp_codes is not None else F.lit(1)).alias("is_asked"),
        F.max(F.col("is_refused").isNull().cast("int")).alias("is_open"), *[F.sum(m).alias(name) for name, m in measures.items()])
    wanted = per_bill.filter("is_asked = 1 AND is_open = 1").drop("is_asked", "is_open").join(done, "bill_code", "left_anti")
    if bill_codes is not None:
        wanted = wanted.join(bill_codes.select("bill_code"), "bill_code", "left_semi")
    # bills to dates
    heads = bills.select("bill_code", "item_count", "total_amount", F.col("billing_date").alias("bill_date"))
    shown = wanted.join(heads, "bill_code", "left")
    per_date = shown.groupBy("billing_date").agg(
        *[F.sum(name).alias(name) for name in measures],
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("bill_date").isNotNull(), F.col("bill_code")))), ",").alias("bill_list"))
    whole = shown.agg(F.struct(F.sum("item_count").alias("items"), F.sum("total_amount").alias("amount")).alias("whole"))
    return (per_date.withColumn("_whole", whole.scalar())
            .withColumns({"all_items": F.col("_whole.items"), "all_amount": F.col("_whole.amount")}).drop("_whole"))


def manual_cover_batch(entries: DataFrame, details: DataFrame, results: DataFrame) -> dict[str, DataFrame]:
    """Check and book manual cover entries.

    ``entries``: entry_id, detail_id, cover_amount, user_id, is_npl. ``details``: active imported
    claims with detail_id, claim_code, pay_total, bill_code. ``results``: current entries with
    detail_id, cover_amount, is_manual, is_manual_npl, on_bill. Of several entries for a claim the
    newest counts; the others come back as rejected.
    """
    # all joins are on the claim, so that entries are shuffled once
    newest = entries.filter("detail_id IS NOT NULL").groupBy("detail_id").agg(F.max("entry_id").alias("newest_id"))
    current = results.select("detail_id", F.col("cover_amount").alias("old_cover"), "is_manual", "on_bill", F.lit(True).alias("is_known"))
    rows = (entries.join(newest, "detail_id", "left").join(details.select("detail_id", "claim_code", "pay_total", "bill_code"), "detail_id", "left")
            .join(current, "detail_id", "left"))
    incomplete = F.col("detail_id").isNull() | F.col("user_id").isNull() | F.col("cover_amount").isNull()
    known = F.col("is_known").isNotNull()
    reason = first_message(
        (incomplete, M.INCOMPLETE), (~F.col("entry_id").eqNullSafe(F.col("newest_id")) | F.col("newest_id").isNull(), M.NO_UPDATE), (F.col("claim_code").isNull(), M.NO_IMPORTED_CLAIM),
        (F.col("bill_code").isNotNull(), M.ALREADY_BILLED), (known & (F.col("is_manual") == 0), M.NOT_EDITABLE),
        (known & (F.col("on_bill") == 1), M.NO_UPDATE), (known & (F.col("old_cover") == F.col("cover_amount")), M.VALUE_UNCHANGED),
        (F.col("cover_amount") >= F.coalesce("pay_total", F.lit(0)), M.CHECK_AMOUNT),
    )
    judged = rows.withColumn("reason", reason).withColumn("action", F.when(F.col("reason").isNull(), F.when(known, "update").otherwise("insert")))
    accepted = judged.filter("reason IS NULL")
    # accepted entries are worked out once: those without a current row are the new ones, so one full join updates and inserts
    booked = accepted.select(F.col("detail_id").alias("_detail"), F.col("cover_amount").alias("_cover"), F.col("is_npl").alias("_npl"), F.lit(True).alias("_hit"))
    state = results.withColumn("_old", F.lit(True)).join(booked, F.col("detail_id") == F.col("_detail"), "full")
    made = {"detail_id": F.col("_detail"), "cover_amount": F.col("_cover"), "is_manual": F.lit(1), "is_manual_npl": F.col("_npl"), "on_bill": F.lit(0)}
    changed = {c: made[c].cast(results.schema[c].dataType) for c in ("cover_amount", "is_manual_npl") if c in results.columns}
    state = state.select(*[
        F.when(F.col("_old").isNull(), made.get(c, F.lit(None))).when(F.col("_hit"), changed.get(c, F.col(c))).otherwise(F.col(c)).alias(c) for c in results.columns])
    return {
        "judged": judged.select("entry_id", "detail_id", "cover_amount", "action", "reason"),
        "results": state,
        "log": accepted.select("entry_id", "detail_id", "cover_amount", F.col("is_npl").alias("is_manual_npl"), "user_id"),
    }
