"""Bank transfers: bundling pay-backs, splitting them into sub-groups and settling."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settleflow.functions import messages as M
from settleflow.functions.codes import running_codes
from settleflow.functions.scalars import first_message, flag, is_midnight, money
from settleflow.operators.packing import next_fit
from settleflow.operators.state import set_where_key, update_rows
from settleflow.sources.work import stored

HOSPITAL_TYPES = (4, 8)
# fixed values: transfer status when created (4: hospital), paid, partly paid, waiting for hospital details
OPEN, PAID, PARTLY_PAID, HOSPITAL_OPEN, HOSPITAL_PAID = 2, 3, 4, 5, 2
# fixed values: pay-back status once bundled and once paid
BUNDLED, PAYBACK_PAID = 3, 4


def create_transfers(requests: DataFrame, paybacks: DataFrame, as_of: dt.date, counters: DataFrame) -> dict[str, DataFrame]:
    """One transfer per request.

    ``requests`` has one row per listed pay-back: request_id, group_type, payback_ref (text, may be
    blank). A request with a blank entry or an already bundled pay-back is refused as a whole;
    entries that name no pay-back add nothing, and one listed twice counts once. Requests are served in the order of their
    ids: one that lists a pay-back of an earlier served request is refused like one with a bundled pay-back, and its other
    pay-backs are free for later requests.
    """
    entries = requests.withColumn("payback_id", F.col("payback_ref").try_cast("long"))
    listed = entries.filter("payback_id IS NOT NULL").select("request_id", "payback_id").distinct().join(
        paybacks.select("payback_id", "amount", F.col("transfer_id").isNotNull().alias("is_bundled")), "payback_id")
    blanks = entries.groupBy("request_id").agg(
        F.max("group_type").alias("group_type"), F.max(flag(F.coalesce(F.trim("payback_ref"), F.lit("")) == "")).alias("has_blank"))
    sums = listed.groupBy("request_id").agg(F.max(flag(F.col("is_bundled"))).alias("has_bundled"), money(F.sum("amount")).alias("amount"))
    state = stored(blanks.join(sums, "request_id", "left"), "requests")
    fit = state.filter("has_blank = 0 AND coalesce(has_bundled, 0) = 0").select("request_id")
    late = _too_late(stored(listed.join(fit, "request_id", "left_semi").select("request_id", "payback_id"), "listed")).withColumn("is_late", F.lit(True))
    judged = state.join(late, "request_id", "left").withColumn("message", first_message(
        (F.col("has_blank") == 1, M.UNKNOWN_ENTRY), ((F.col("has_bundled") == 1) | F.col("is_late"), M.PARTLY_TRANSFERRED)))
    accepted = judged.filter("message IS NULL").withColumn("prefix", F.lit("CPBT"))
    coded, raised = running_codes(accepted, "prefix", ["request_id"], 8, as_of, counters, "transfer_code")
    transfers = coded.select(
        "request_id", "transfer_code", "group_type", "amount", F.lit(0).cast("decimal(16,2)").alias("transfer_amount"),
        F.when(F.col("group_type") == 4, HOSPITAL_OPEN).otherwise(OPEN).alias("status_id"))
    marks = listed.join(transfers.select("request_id", "transfer_code"), "request_id").select(
        "payback_id", "transfer_code", F.lit(BUNDLED).alias("status_id"))
    new_state = update_rows(paybacks.withColumn("transfer_code", F.lit(None).cast("string")), marks, ["payback_id"])
    return {"check": judged.select("request_id", "message"), "transfers": transfers, "paybacks": new_state, "counters": raised}


def _too_late(listed: DataFrame) -> DataFrame:
    """Requests that list a pay-back which an earlier served request has (``listed``: request_id, payback_id, stored).

    In each round every request that comes first on all its pay-backs is served, and the others on those pay-backs are
    refused and leave the rest of theirs free. What is left goes on to the next round, so a round looks only at requests that
    still hang on each other; there are as many rounds as the longest chain of such requests.
    """
    refused = None
    while True:
        first = listed.groupBy("payback_id").agg(F.min("request_id").alias("first"), F.max("request_id").alias("last")).filter("first <> last")
        shared = stored(listed.join(first.select("payback_id", "first"), "payback_id"), "shared")
        if shared.isEmpty():
            break
        # a request is held up while another one comes first on any of its pay-backs
        held = shared.groupBy("request_id").agg(F.max(flag(F.col("first") < F.col("request_id"))).alias("held"))
        served = held.filter("held = 0").select("request_id")
        taken = shared.join(served, "request_id", "left_semi").select("payback_id").distinct()
        out = stored(shared.join(taken, "payback_id", "left_semi").join(served, "request_id", "left_anti").select("request_id").distinct(), "refused")
        refused = out if refused is None else refused.unionByName(out)
        left = shared.select("request_id", "payback_id").join(out, "request_id", "left_anti").join(served, "request_id", "left_anti")
        listed = stored(left, "listed")
    return listed.select("request_id").limit(0) if refused is None else refused


def subgroups_by_hospital(transfers: DataFrame, details: DataFrame, hospitals: DataFrame, as_of: dt.date, counters: DataFrame) -> dict[str, DataFrame]:
    """One sub-group per hospital of each hospital transfer; other transfers are refused."""
    hospital_only = transfers.filter(F.col("group_type").isin(*HOSPITAL_TYPES)).select("transfer_id")
    refused = transfers.filter(~F.col("group_type").isin(*HOSPITAL_TYPES)).select("transfer_id", F.lit(M.HOSPITAL_ONLY).alias("message"))
    mine = details.join(hospital_only, "transfer_id", "left_semi")
    sums = mine.groupBy("transfer_id", "hospital_id").agg(
        F.count(F.lit(1)).alias("item_count"), money(F.sum("amount")).alias("amount")).withColumn("prefix", F.lit("HCG"))
    coded, raised = running_codes(sums, "prefix", ["transfer_id", "hospital_id"], 6, as_of, counters, "subgroup_code")
    subgroups = coded.drop("prefix").join(hospitals.select("hospital_id", "hospital_name"), "hospital_id", "left")
    linked = details.join(subgroups.select("transfer_id", "hospital_id", "subgroup_code"), ["transfer_id", "hospital_id"], "left")
    return {"subgroups": subgroups, "details": linked, "refused": refused, "counters": raised}


def subgroups_by_ceiling(lists: DataFrame, details: DataFrame, limit: float, as_of: dt.date, counters: DataFrame) -> dict[str, DataFrame]:
    """Split the pay-backs of each list of transfers into groups of at most ``limit``.

    ``lists``: list_id, transfer_id. ``details``: payback_id, transfer_id, amount. A list with a
    pay-back above the limit is refused. Groups fill in transfer order and give one sub-group per
    (transfer, group); when a whole list fits into one group it is one sub-group across its transfers.
    """
    per_payback = details.join(lists, "transfer_id").groupBy("list_id", "transfer_id", "payback_id").agg(
        money(F.sum("amount")).alias("amount"), F.count(F.lit(1)).alias("item_count"))
    too_large = per_payback.filter(F.col("amount") > F.lit(limit)).select("list_id").distinct().withColumn(
        "message", F.concat(F.lit(M.ABOVE_LIMIT), F.format_number(F.lit(float(limit)), 2)))
    fit = per_payback.join(too_large, "list_id", "left_anti")
    packed = next_fit(fit, "list_id", ["transfer_id", "payback_id"], F.col("amount"), limit)
    single = packed.groupBy("list_id").agg(F.max("group_no").alias("groups"))
    keyed = packed.join(single, "list_id").withColumn("owner_id", F.when(F.col("groups") > 1, F.col("transfer_id")))
    sums = keyed.groupBy("list_id", "group_no", "owner_id").agg(
        money(F.sum("amount")).alias("amount"), F.count(F.lit(1)).alias("paybacks"), F.count_distinct("transfer_id").alias("transfers"))
    # a single group counts its transfers, the others their pay-backs
    sums = sums.withColumn("item_count", F.when(F.col("owner_id").isNull(), F.col("transfers")).otherwise(F.col("paybacks"))).withColumn("prefix", F.lit("CPB"))
    coded, raised = running_codes(sums, "prefix", ["list_id", "owner_id", "group_no"], 6, as_of, counters, "subgroup_code")
    subgroups = coded.select("list_id", "group_no", F.col("owner_id").alias("transfer_id"), "subgroup_code", "amount", "item_count", F.lit(2).alias("transaction_type"))
    side = subgroups.select(F.col("list_id").alias("l"), F.col("group_no").alias("g"), F.col("transfer_id").alias("o"), "subgroup_code")
    linked = keyed.join(side, (F.col("list_id") == F.col("l")) & (F.col("group_no") == F.col("g")) & F.col("owner_id").eqNullSafe(F.col("o"))).select(
        "payback_id", "transfer_id", "amount", "subgroup_code")
    return {"subgroups": subgroups, "details": linked, "refused": too_large, "counters": raised}


def settle_transfers(settlements: DataFrame, transfers: DataFrame, paybacks: DataFrame, claims: DataFrame,
                     subgroups: DataFrame, subgroup_details: DataFrame) -> dict[str, DataFrame]:
    """Book paid transfers: transfer_id, paid_amount, paid_at, subgroup_id.

    Refused when the transfer is not known, when paid before, when the amount differs from the pay-backs or their claims, or
    when no time of day was given. A transfer is settled once all its sub-groups are paid, before that partly.
    """
    bundled = paybacks.filter("transfer_id IS NOT NULL")
    by_claim = claims.groupBy("payback_id").agg(F.sum("claim_pay").alias("claim_pay"))
    sums = bundled.join(by_claim, "payback_id", "left").groupBy("transfer_id").agg(
        money(F.sum("amount")).alias("payback_sum"), money(F.sum("claim_pay")).alias("claim_sum"))
    known = transfers.select("transfer_id", "status_id", "group_type", F.lit(True).alias("is_known"))
    rows = settlements.join(known, "transfer_id", "left").join(sums, "transfer_id", "left")
    message = first_message(
        (F.col("is_known").isNull(), M.UNKNOWN_ENTRY),
        (F.col("status_id") == PAID, M.ALREADY_TRANSFERRED),
        ((F.col("paid_amount") != F.col("payback_sum")) | (F.col("paid_amount") != F.col("claim_sum")), M.TRANSFER_AMOUNT_WRONG),
        (is_midnight(F.col("paid_at")), M.TRANSFER_TIME_MISSING),
    )
    judged = rows.withColumn("message", message)
    done = judged.filter("message IS NULL").select("transfer_id", "group_type", "paid_amount", "paid_at", "subgroup_id")
    # sub-groups named by an accepted settlement are paid now
    paid_groups = done.groupBy("subgroup_id").agg(F.max("paid_at").alias("paid_at"), F.lit(1).alias("is_paid"))
    new_subgroups = update_rows(subgroups.withColumn("paid_at", F.lit(None).cast("timestamp_ntz")), paid_groups, ["subgroup_id"], checked=False)
    pairs = subgroup_details.select("subgroup_id", "transfer_id").distinct()
    progress = pairs.join(new_subgroups.select("subgroup_id", "is_paid"), "subgroup_id").groupBy("transfer_id").agg(F.min("is_paid").alias("all_paid"))
    hospital = F.col("group_type") == 4
    complete = F.coalesce("all_paid", F.lit(0)) == 1
    changes = done.join(progress, "transfer_id", "left").select(
        "transfer_id",
        F.when(~hospital, F.col("paid_amount")).alias("transfer_amount"), F.when(~hospital, F.col("paid_at")).alias("transfer_at"),
        F.when(hospital, HOSPITAL_PAID).when(complete, PAID).otherwise(PARTLY_PAID).alias("status_id"),
        F.when(complete, 3).otherwise(6).alias("oop_status"), F.col("paid_amount").alias("oop_amount"))
    blank = transfers.withColumn("transfer_at", F.lit(None).cast("timestamp_ntz")).withColumn("oop_amount", F.lit(None).cast("decimal(16,2)"))
    in_group = subgroup_details.select("payback_id", "transfer_id", "subgroup_id").join(done.select("transfer_id", "subgroup_id"), ["transfer_id", "subgroup_id"], "left_semi")
    paid_backs = bundled.filter("group_type <> 4").join(in_group.select("payback_id"), "payback_id", "left_semi")
    covered = bundled.join(done.select("transfer_id"), "transfer_id", "left_semi")
    return {
        "check": judged.select("transfer_id", "message"),
        "transfers": update_rows(blank, changes, ["transfer_id"]),
        "paybacks": set_where_key(paybacks, paid_backs, ["payback_id"], status_id=F.lit(PAYBACK_PAID)),
        "claims": set_where_key(claims.withColumn("claim_transfer", F.lit(None).cast("decimal(16,2)")), covered, ["payback_id"], claim_transfer=F.col("claim_pay")),
        "subgroups": new_subgroups,
    }
