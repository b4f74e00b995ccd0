"""Reconciling imported groups and turning them into numbered bills."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settleflow.functions import messages as M
from settleflow.functions.codes import code_text, current_counters, period
from settleflow.functions.scalars import code_part, code_part_int, due_date, first_message, if_null, join_text, money, zero_pad
from settleflow.operators.aggregates import latest_per_key
from settleflow.operators.filters import half_open
from settleflow.operators.joins import map_value
from settleflow.operators.numbering import batch_number, beside, join_null_safe, keyed_row_number, numbered, places, small, spans
from settleflow.operators.state import set_where_key, update_rows
from settleflow.plans.columns import EXPORT, select_wide
from settleflow.sources.work import stored

# fixed values: bill group per header-group type (2, 4, 5 health; 3 accident; 6 miscellaneous)
BILL_GROUP = {2: 1, 3: 2, 4: 1, 5: 1, 6: 3}
# fixed value: items on one bill of an insurer without file transfer
BILL_SIZE = 20
# what an exported claim has of its bill
ON_BILL = ["bill_code", "item_code", "cover_amount", "new_billing_date", "due_date", "insurer_id", "group_type", "claim_type_code"]


def latest_cover_log(log: DataFrame) -> DataFrame:
    """Newest log entry per claim; the remaining columns make the choice unique."""
    newest = [F.col("created_at").desc_nulls_last(), *[F.col(f"tie{i}").asc() for i in (1, 2, 3, 4)]]
    return latest_per_key(log, ["detail_id"], newest).select("detail_id", "cover_amount", "is_manual_npl")


def billing_reconcile(imported: DataFrame, details: DataFrame, prior_result: DataFrame, cover_log: DataFrame,
                      online_pay: DataFrame, npl: DataFrame, start=None, end=None) -> DataFrame:
    """Claims of waiting groups whose amounts do not add up, with the first rule they break.

    The billing amount of a group is the sum of (group total - cover) over its claims. The newest
    cover entry of a claim counts as manual NPL or other cover. Date bounds are half-open.
    """
    waiting = imported.filter((F.col("status_id") == 2) & F.col("is_active")).filter(half_open("created_at", start, end))
    waiting = waiting.withColumn("bill_group", map_value(F.col("group_type"), BILL_GROUP)).filter("bill_group IS NOT NULL")
    claims = details.select("import_id", "detail_id", "claim_code", "pay_total")
    covers = prior_result.select("detail_id", F.col("cover_amount").alias("booked"), F.col("is_active").alias("booked_active"))
    # sums need the booked covers only; the log joins the claims afterwards, once
    booked = claims.join(covers, "detail_id", "left")
    sums = booked.groupBy("import_id").agg(
        F.count(F.lit(1)).alias("claims"), F.sum(F.coalesce("booked", F.lit(0))).alias("booked")
    )
    paid = online_pay.filter("payment_status_id = 4").groupBy(F.col("online_id").alias("import_id")).agg(
        F.sum("amount").cast("decimal(16,2)").alias("transfer_amount")
    )
    npls = npl.groupBy(F.col("online_id").alias("import_id")).agg(F.sum("amount").cast("decimal(16,2)").alias("npl_amount"))
    groups = (
        waiting.select("import_id", "group_code", "group_type", "total_amount")
        .join(sums, "import_id", "left").join(paid, "import_id", "left").join(npls, "import_id", "left")
        .withColumn("billing_amount", money(
            F.coalesce("claims", F.lit(1)) * F.col("total_amount") - F.coalesce("booked", F.lit(0))
        ))
    )
    per_claim = booked.drop("booked").join(latest_cover_log(cover_log), "detail_id", "left")
    rows = groups.drop("booked").join(per_claim, "import_id", "left")
    # a log entry counts only when an active result carries it
    cover = F.when(F.col("booked_active"), F.col("cover_amount"))
    kind = F.when(F.col("booked_active"), F.col("is_manual_npl"))
    zero = F.lit(0).cast("decimal(16,2)")
    out = rows.select(
        "group_code", "group_type", "claim_code", "billing_amount",
        if_null(F.col("pay_total"), 0, "decimal(16,2)").alias("amount"),
        if_null(F.col("transfer_amount"), 0, "decimal(16,2)").alias("transfer_amount"),
        # the NPL share hangs on the transfer, so it is seen only where one was paid
        if_null(F.when(F.col("transfer_amount").isNotNull(), F.col("npl_amount")), 0, "decimal(16,2)").alias("npl_amount"),
        F.when(kind == 1, F.coalesce(cover, zero)).otherwise(zero).alias("cover_npl"),
        F.when(kind == 0, F.coalesce(cover, zero)).otherwise(zero).alias("cover_other"),
    )
    return out.withColumn("finding", first_message(
        (F.col("amount") != F.col("billing_amount") + F.col("cover_npl") + F.col("cover_other"), M.AMOUNT_NOT_BILLED),
        (F.col("amount") + F.col("billing_amount") == 0, M.AMOUNT_AND_BILL_ZERO),
        ((F.col("transfer_amount") > 0) & (F.col("transfer_amount") != F.col("amount") + F.col("npl_amount")),
         M.TRANSFER_NOT_AMOUNT_NPL),
    ))


BILL_KEY = ["insurer_id", "bill_group", "claim_type_code", "billing_date", "group_type", "product_type"]


def generate_bills(imported: DataFrame, details: DataFrame, prior_result: DataFrame, compensated: DataFrame,
                   insurers: DataFrame, product_types: DataFrame, branches: DataFrame, counters: DataFrame,
                   new_billing_date: str, as_of: dt.date, start=None, end=None, banks: DataFrame | None = None,
                   widen: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> dict[str, DataFrame]:
    """Bills for all waiting groups at once.

    Claims are numbered in one pass over (item prefix, bill key, code parts, claim); the number
    within a bill and within the item prefix both follow from it. Insurers with file transfer get
    one bill per key, the others bills of ``BILL_SIZE`` claims. A group belongs to the bill of its
    first claim. Returns ``items``, ``bills``, ``export``, ``imported`` (new state) and ``counters``.

    ``insurers`` has one row per insurer: insurer_id, is_sftp. ``product_types`` names the product
    of miscellaneous groups (import_id, product_type); it is empty text for the other groups. ``details`` has the columns named
    below and what it has of ``columns.CLAIM``, which ``export`` shows; ``banks`` names the account of a claim type
    (claim_type_code, bank_id, bank_account). ``widen`` as in ``export_rows``.
    """
    waiting = (
        imported.filter((F.col("status_id") == 2) & F.col("is_active")).filter(half_open("created_at", start, end))
        .withColumn("bill_group", map_value(F.col("group_type"), BILL_GROUP)).filter("bill_group IS NOT NULL")
        .join(product_types, "import_id", "left")
        .withColumn("product_type", F.when(F.col("group_type") == 6, F.coalesce("product_type", F.lit(""))).otherwise(""))
        .select("import_id", *BILL_KEY)
    )
    claims = details.select("import_id", "detail_id", "claim_code", "group_code", "branch_id", "pay_total",
                            "hospital_id", "happened_at").join(waiting, "import_id")
    # earlier covers; outside health and compensate groups they lapse once the claim was compensated
    covers = prior_result.filter("is_active").groupBy("claim_code").agg(F.sum("cover_amount").alias("booked"))
    lapsed = compensated.select("claim_code").distinct().withColumn("was_compensated", F.lit(True))
    kept = F.col("group_type").isin(2, 4) | F.col("was_compensated").isNull()
    net = (
        claims.join(covers, "claim_code", "left").join(lapsed, "claim_code", "left")
        .withColumn("cover_amount", money(F.when(kept, F.coalesce("booked", F.lit(0))).otherwise(0)))
        .withColumn("amount_total", money(F.col("pay_total") - F.col("cover_amount")))
        .drop("booked", "was_compensated")
        .withColumn("item_prefix", F.when(F.col("bill_group") == 2, "BQIPA").otherwise("BQIPH"))
        .withColumn("p1", code_part(F.col("group_code"), 4))
        .withColumns({f"p{5 - n}": code_part_int(F.col("group_code"), n) for n in (3, 2, 1)})
    )
    order = ["item_prefix", *BILL_KEY, "p1", "p2", "p3", "p4", "claim_code"]
    # claims are worked out once: places hold whole rows, which all results start from
    placed = places(net, order, beside(net, order))
    counters = stored(counters, "counters")
    used_items = current_counters(counters, as_of).withColumnRenamed("prefix", "item_prefix")
    by_prefix, by_bill = spans(placed, ["item_prefix"], used_items), spans(placed, ["item_prefix", *BILL_KEY])
    ranked = numbered(net, placed, order, {"_number": (["item_prefix"], by_prefix), "row_no": (["item_prefix", *BILL_KEY], by_bill)})
    leads = placed.groupBy(*BILL_KEY).agg(F.min("group_code").alias("lead_code"))
    items = (
        ranked.join(small(insurers.select("insurer_id", "is_sftp")), "insurer_id", "left").withColumn("is_sftp", F.coalesce("is_sftp", F.lit(0)))
        .withColumn("batch_no", F.when(F.col("is_sftp") == 1, 0).otherwise(batch_number(F.col("row_no"), BILL_SIZE)).cast("long"))
        .withColumn("item_code", code_text(F.col("item_prefix"), as_of, F.col("_number"), 6))
    )
    hospital = (F.substring("lead_code", 4, 1) == "H") | (F.col("group_type") == 4)
    prefix = join_text(F.lit("BQG"), F.when(F.col("bill_group") == 2, "PA").when(F.col("bill_group") == 1, "PH").otherwise(F.col("product_type")),
                       F.right(zero_pad(F.col("insurer_id"), 12), F.lit(2)), F.when(hospital, "H").otherwise("B"))
    sums = join_null_safe(items.groupBy(*BILL_KEY, "batch_no", "is_sftp").agg(
        F.count(F.lit(1)).alias("item_count"), money(F.sum("pay_total")).alias("pay_total"),
        money(F.sum("cover_amount")).alias("cover_amount"), money(F.sum("amount_total")).alias("total_amount"),
    ), leads, BILL_KEY).withColumn("prefix", prefix)
    counted = keyed_row_number(sums, ["prefix", "is_sftp"], [*BILL_KEY, "batch_no"], "no", whole=True)
    # file-transfer bills count per month in three digits, the others per year in five
    used = current_counters(counters, as_of).withColumn("is_sftp", F.lit(1)).unionByName(
        current_counters(counters, as_of, with_month=False).withColumn("is_sftp", F.lit(0)))
    number = F.coalesce("running", F.lit(0)) + F.col("no")
    bills = counted.join(small(used), ["prefix", "is_sftp"], "left").withColumns({
        "number": number,
        "bill_code": F.when(F.col("is_sftp") == 1, code_text(F.col("prefix"), as_of, number, 3))
        .otherwise(code_text(F.col("prefix"), as_of, number, 5, with_month=False)),
        "status_id": F.lit(2), "new_billing_date": F.lit(new_billing_date).cast("date"),
        "due_date": due_date(F.lit(new_billing_date).cast("date")),
    }).drop("running", "no", "lead_code")
    heads = bills.select(*BILL_KEY, "batch_no", "bill_code", "due_date", "new_billing_date")
    coded = join_null_safe(items.drop("_number"), heads, [*BILL_KEY, "batch_no"])
    export = export_rows(coded, details, branches, banks, widen)
    billed = coded.groupBy("import_id").agg(F.min_by("bill_code", "row_no").alias("bill_code"))
    state = update_rows(
        imported.withColumn("bill_code", F.lit(None).cast("string")),
        billed.select("import_id", "bill_code", F.lit(3).alias("status_id"), F.lit(new_billing_date).cast("date").alias("billing_date")),
        ["import_id"], checked=False)
    year, month = period(as_of)
    item_counters = by_prefix.groupBy(F.col("item_prefix").alias("prefix")).agg(F.max(F.col("_span_before") + F.col("_span_n")).alias("running")).select(
        "prefix", F.lit(month).alias("month"), "running")
    bill_counters = bills.groupBy("prefix", F.when(F.col("is_sftp") == 1, month).otherwise("00").alias("month")).agg(
        F.max("number").alias("running"))
    raised = bill_counters.unionByName(item_counters).withColumn("year", F.lit(year))
    return {"items": coded, "bills": bills, "export": export, "imported": state,
            "counters": raised}


def export_rows(coded: DataFrame, details: DataFrame, branches: DataFrame, banks: DataFrame | None,
                widen: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """Rows an insurer receives, with all ``columns.EXPORT`` columns; amounts are net of what was covered before.

    ``details`` may be narrow: ``widen`` adds after the joins what else a claim shows.
    """
    keys = ["detail_id", *ON_BILL]
    own = details.drop(*ON_BILL, "branch")
    return shown_to_insurer(coded.select(*keys).join(own, "detail_id"), branches, banks, widen)


def shown_to_insurer(rows: DataFrame, branches: DataFrame, banks: DataFrame | None, widen: Callable[[DataFrame], DataFrame] = lambda rows: rows,
                     carried: list[str] = ()) -> DataFrame:
    """``export_rows`` of claims that have their bill's columns beside their own; ``carried`` columns come along."""
    rows = rows.join(branches.select("branch_id", "branch"), "branch_id", "left")
    if banks is not None:
        rows = rows.join(small(banks.select("claim_type_code", "bank_id", "bank_account")), "claim_type_code", "left")
    rows = widen(rows)
    given = {"pay": F.col("pay" if "pay" in rows.columns else "pay_total") - F.col("cover_amount"), "pay_total": F.col("pay_total") - F.col("cover_amount"), "document_link": F.lit("")}
    return rows.select(*select_wide(rows, EXPORT, given), *carried)


def undo_bills(imported: DataFrame, bills: DataFrame, items: DataFrame, codes: DataFrame, new_billing_date: str) -> dict[str, DataFrame]:
    """Take a set of bills back: their groups wait again, bills and items become inactive.

    ``codes`` has one column, bill_code. Groups are found through the bill they carry.
    """
    return {
        "imported": set_where_key(imported, codes, ["bill_code"], status_id=F.lit(2), bill_code=F.lit(None),
                                  billing_date=F.lit(new_billing_date).cast("date")),
        "bills": set_where_key(bills, codes, ["bill_code"], is_active=F.lit(False)),
        "items": set_where_key(items, codes, ["bill_code"], is_active=F.lit(False)),
    }
