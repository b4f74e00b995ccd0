"""Claim groups ready to be paid back: candidates and amount validation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settleflow.functions import messages as M
from settleflow.functions.scalars import flag, messages, money
from settleflow.operators.aggregates import first_row_per_group, pivot_values
from settleflow.operators.filters import keep_where
from settleflow.operators.paging import page

# fixed values: first creation date a source is taken from, per rule
CUTOFFS = {
    "compensate": dt.date(2023, 12, 8), "opd": dt.date(2023, 12, 8), "ipd": dt.date(2023, 10, 26),
    "prepaid": dt.date(2024, 1, 9), "accident": dt.date(2023, 11, 27), "disability": dt.date(2025, 8, 18),
}
# fixed values: admit types of prepaid hospital claims and of death or disability
PREPAID_ADMIT = ("1001", "3001")
DEATH_ADMIT = ("4000", "4001", "5001", "5002")
# fixed values: accident claim kinds per claim-group type, styles of branch and hospital claims
ACCIDENT_ONLINE = ("4001", "4002", "4003", "4004")
ACCIDENT_DEATH = ("4006", "4006_2", "4007", "4008", "4009", "4010")
BRANCH_STYLE, HOSPITAL_STYLE = ("4130", "4140"), ("4110", "4120")
CLOSED_STATUS = ("3570", "3580")
# fixed values: miscellaneous product types paid by default, and the one never paid
MISC_DEFAULT, MOTOR_DEFAULT, MISC_EXCLUDED = (10, 27, 32, 33, 38, 41, 42), 11, 34
MISC_PRODUCTS = (4, 11)
# fixed values: policy states of customers in force; the last one is cancelled
IN_FORCE = ("3020", "3030", "3035", "3040")


def health_rule(kind: int, cut: dict) -> Column:
    """Health claims of one claim-group type: online, branch, hospital or death."""
    online = F.coalesce(F.col("is_online"), F.lit(0)) == 1
    prepaid = F.col("admit_type").isin(*PREPAID_ADMIT)
    death = F.col("admit_type").isin(*DEATH_ADMIT)
    since = lambda name: F.col("created_at") >= F.lit(cut[name])
    if kind == 2:
        return online & ~prepaid & ~death & since("opd")
    if kind == 3:
        return ~online & ~prepaid & (F.col("claim_type_code") == "2000") & since("opd")
    if kind == 6:
        return online & ~prepaid & death & since("opd")
    settled = F.coalesce(F.col("payback_status"), F.lit(0)) == 1
    return ~online & (F.col("claim_type_code") == "1000") & ((~prepaid & since("opd")) | (prepaid & settled & since("prepaid")))


def accident_rule(kind: int, cut: dict) -> Column:
    online = F.coalesce(F.col("is_online"), F.lit(0)) == 1
    since = lambda name: F.col("created_at") >= F.lit(cut[name])
    rules = {
        2: online & since("accident") & (F.col("admit_type").isin(*ACCIDENT_ONLINE) | ((F.col("admit_type") == "4005") & (F.col("claim_created_at") > F.lit(cut["disability"])))),
        3: ~online & F.col("style").isin(*BRANCH_STYLE) & since("accident"),
        4: ~online & F.col("style").isin(*HOSPITAL_STYLE) & since("ipd"),
        6: online & F.col("admit_type").isin(*ACCIDENT_DEATH) & since("ipd"),
    }
    return rules[kind] & ~F.col("claim_status").isin(*CLOSED_STATUS)


def misc_rule(product: int, kind: int | None, payment_type: int | None, product_type: int | None) -> Column:
    rule = (F.col("status") == 3) & F.col("group_code").isNotNull() & (F.col("product_type") != MISC_EXCLUDED)
    if product == 4:
        rule = rule & (F.col("payment_type") == payment_type if payment_type is not None else F.col("product_type") == MOTOR_DEFAULT)
    else:
        rule = rule & (F.col("product_type") == product_type if product_type is not None else F.col("product_type").isin(*MISC_DEFAULT))
    if kind is not None:
        rule = rule & (F.col("claim_kind") == {7: 3, 8: 2}[kind])
    return rule


def qualifications(modes: list[tuple[int, int | None]], cut: dict, created_by=None, payment_type=None, product_type=None) -> Column:
    """The products and claim-group types of ``modes`` a claim qualifies for, as an array of (product, kind)."""
    by = F.lit(True) if created_by is None else F.col("created_by") == created_by
    # prepaid hospital claims are filed under the user who settled them
    settled_by = F.lit(True) if created_by is None else F.when(
        F.col("admit_type").isin(*PREPAID_ADMIT), F.col("updated_by")).otherwise(F.col("created_by")) == created_by
    found = []
    for product, kind in modes:
        if product in MISC_PRODUCTS:
            test = (F.col("source") == "misc") & misc_rule(product, kind, payment_type, product_type) & by
        elif kind == 5:
            test = (F.col("source") == "compensate") & (F.col("group_items") > 0) & (F.col("created_at") >= F.lit(cut["compensate"])) & by
        elif product == 2:
            test = (F.col("source") == "health") & health_rule(kind, cut) & settled_by
        else:
            test = (F.col("source") == "accident") & accident_rule(kind, cut) & by
        found.append(F.when(test, F.struct(F.lit(product).alias("product"), F.lit(kind).cast("int").alias("kind"))))
    return F.array_compact(F.array(*found))


def intake_candidates(claims: DataFrame, documents: DataFrame, paid_claims: DataFrame, paid_groups: DataFrame,
                      modes: list[tuple[int, int | None]], cutoffs: dict | None = None, insurer_id=None, branch_id=None,
                      created_by=None, group_code=None, has_documents: bool | None = None,
                      payment_type=None, product_type=None) -> DataFrame:
    """Groups that can be paid back, for every product and claim-group type of ``modes`` in one pass.

    ``claims`` holds all sources (``source``: compensate, health, accident, misc). What a claim qualifies for is worked out
    row by row and exploded; claims paid before (``paid_claims``: claim_code, product, kind) go by one anti join on claim, product
    and type, miscellaneous groups with a pay-back by another on the group. Original groups only: their code ends in 0. A group is
    complete when every claim has a document; ``has_documents`` asks for complete (True), incomplete (False) or all groups.
    """
    cut = {**CUTOFFS, **(cutoffs or {})}
    misc = F.col("product").isin(*MISC_PRODUCTS)
    rows = keep_where(claims, insurer_id=insurer_id, branch_id=branch_id, group_code=group_code).filter(F.col("group_code").endswith("0"))
    rows = rows.select("group_code", "claim_code", F.when(F.col("source") == "compensate", F.col("origin_code")).otherwise(F.col("claim_code")).alias("paid_as"), "amount",
                       "branch_id", "created_by", "created_at", "insurer_id", "product_name",
                       F.inline(qualifications(modes, cut, created_by, payment_type, product_type)))
    paid = paid_claims.select(F.col("claim_code").alias("_claim"), F.col("product").alias("_product"), F.col("kind").alias("_kind"))
    rows = rows.join(paid, ~misc & (F.col("paid_as") == F.col("_claim")) & (F.col("product") == F.col("_product")) & (F.col("kind") == F.col("_kind")), "left_anti")
    if any(product in MISC_PRODUCTS for product, _ in modes):
        rows = rows.join(paid_groups.select(F.col("group_code").alias("_group")), misc & (F.col("group_code") == F.col("_group")), "left_anti")
    filed = documents.select("claim_code").distinct().withColumn("_filed", F.lit(1))
    # miscellaneous claims and type 4 have no document check
    rows = rows.join(filed, "claim_code", "left").withColumn("filed", F.when(~misc & ~F.col("kind").eqNullSafe(4), F.col("_filed")))
    groups = rows.groupBy("product", "kind", "group_code").agg(
        F.count("claim_code").alias("item_count"), money(F.sum(F.coalesce("amount", F.lit(0)))).alias("amount"),
        F.sum("filed").alias("doc_count"),
        F.min_by(F.struct("branch_id", "created_by", "created_at", "insurer_id", "product_name"), "claim_code").alias("head"),
    ).select("product", "kind", "group_code", "item_count", "amount", "doc_count", "head.*")
    complete = F.coalesce(F.col("item_count") == F.col("doc_count"), F.lit(False))
    groups = groups.withColumn("has_documents", flag(complete))
    if has_documents is not None:
        groups = groups.filter(F.col("has_documents") == int(has_documents))
    return groups


def intake_page(groups: DataFrame, branches: DataFrame, start: int | None = None, size: int | None = None) -> DataFrame:
    """A page of candidates by group code, with the total count."""
    named = groups.join(branches.select("branch_id", "branch"), "branch_id", "left")
    return page(named, [F.col("group_code").asc()], start, size)


def online_transfers(online_pay: DataFrame, npl: DataFrame) -> DataFrame:
    """Settled online transfers and NPL shares per online claim."""
    paid = online_pay.filter("payment_status_id = 4").groupBy("online_id").agg(money(F.sum("amount")).alias("transfer_amount"))
    shares = npl.groupBy("online_id").agg(money(F.sum("amount")).alias("npl_amount"))
    return paid, shares


def validate_amount_pay(product: int, kind: int, claims: DataFrame, codes: DataFrame, online_pay: DataFrame, npl: DataFrame,
                        own_company: int, policies: DataFrame | None = None, customers: DataFrame | None = None,
                        payments: DataFrame | None = None, open_payments: DataFrame | None = None,
                        online_status: DataFrame | None = None) -> DataFrame:
    """Amount checks of the chosen groups of one product, one row per distinct finding.

    Health and accident: ``claims`` has group_code, claim_code, online_id, amount, insurer_id (and
    app_id). Miscellaneous: misc_id, policy_no besides; ``payments`` (misc_id, payment_type, amount),
    ``open_payments`` (misc_id) and ``online_status`` (online_id, status) complete the picture.
    """
    zero = F.lit(0).cast("decimal(16,2)")
    chosen = claims.join(codes.select("group_code"), "group_code", "left_semi")
    paid, shares = online_transfers(online_pay, npl)
    amount, transfer, share = (F.coalesce(F.col(c), zero) for c in ("amount", "transfer_amount", "npl_amount"))
    if product > 3:
        kinds = payments.select("misc_id", "payment_type", "amount").distinct()
        wide = pivot_values(kinds, ["misc_id"], "payment_type", {2: "t2", 3: "t3", 4: "t4"}, F.col("amount"), F.sum)
        net = wide.select("misc_id", money(F.coalesce("t2", zero) + F.coalesce("t3", zero) - F.coalesce("t4", zero)).alias("transfer_amount"), F.lit(True).alias("is_paid"))
        rows = (chosen.join(net, "misc_id", "left").join(shares, "online_id", "left")
                .join(open_payments.select("misc_id").distinct().withColumn("is_open", F.lit(True)), "misc_id", "left")
                .join(online_status, "online_id", "left"))
        rules = [(amount == 0, M.AMOUNT_WRONG)]
        if kind != 8:
            rules.append((transfer != amount + share, M.TRANSFER_DIFFERS))
        rules.append((F.coalesce("policy_no", F.lit("")) == "", M.NO_POLICY))
        if kind != 8:
            rules.append((F.col("is_paid").isNull() | F.col("is_open").isNotNull(), M.PAYMENT_RUNNING))
        rules.append((F.col("online_state") == 4, M.ONLINE_CANCELLED))
        warning = messages(*rules, sep=" , ")
    else:
        rows = chosen.filter(F.col("insurer_id") != own_company).join(paid, "online_id", "left").join(shares, "online_id", "left")
        # an NPL share is seen through the transfer it belongs to
        rows = rows.withColumn("npl_amount", F.when(F.col("transfer_amount").isNotNull(), F.col("npl_amount")))
        differs = transfer != amount + share
        if product == 2:
            warning = F.when(amount == 0, M.AMOUNT_WRONG)
            warning = warning.when(differs, M.TRANSFER_DIFFERS).otherwise("") if kind in (2, 6) else warning.otherwise("")
        else:
            held = policies.filter("policy_type_id <> 9605").select("app_id").distinct().withColumn("has_policy", F.lit(True))
            active = customers.filter(F.col("state").isin(*IN_FORCE)).select("app_id", "state")
            rows = rows.join(held, "app_id", "left").join(active, "app_id", "left")
            rules = []
            if kind != 4:
                rules.append((F.col("has_policy").isNull() & F.col("state").isNull(), M.NO_POLICY))
            rules += [(F.col("state").isNull(), M.CHECK_POLICY_STATUS), (amount == 0, M.AMOUNT_WRONG)]
            if kind in (2, 6):
                rules.append((differs, M.TRANSFER_DIFFERS))
            if kind in (2, 3, 6):
                rules.append((F.col("state").isin(*IN_FORCE[:3]), M.CHECK_POLICY_STATUS))
            warning = messages(*rules, sep=" , ")
    out = rows.select("group_code", amount.alias("amount"), share.alias("npl_amount"), transfer.alias("transfer_amount"), warning.alias("warning"))
    return out.distinct().withColumn("is_valid", flag(F.col("warning") == ""))
