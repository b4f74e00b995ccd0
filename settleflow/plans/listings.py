"""Paged lists of the settlement desk.

Every list is a filtered frame; ``paging.page`` cuts the page and adds the total. Filters use only the
parameters that are given. Lists that were opened for one id take a set of ids instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settleflow.functions.scalars import flag, if_null, join_text, link_token, money
from settleflow.operators.aggregates import count_when, distinct_text
from settleflow.operators.filters import contains_text, half_open, keep_where
from settleflow.operators.joins import or_join
from settleflow.operators.paging import page, sort_columns

# fixed values: progress of a transfer (nothing, part, all done)
NONE, SOME, ALL = 1, 2, 3
# fixed values: fields a user can sort by, and the column each stands for
TRANSFER_SORT = {"ClaimPayBackTransferCode": "transfer_id", "Amount": "amount", "ClaimPayBackTransferStatus": "status",
                 "TransferDate": "transfer_at", "CreatedDate": "transfer_at"}
BILL_SORT = {"BillingRequestGroupCode": "bill_code", "ClaimHeaderGroupTypeName": "group_type_name", "InsuranceCompanyName": "insurer_name",
             "ItemCount": "item_count", "TotalAmount": "total_amount", "ClaimType": "claim_type", "BillingDate": "billing_date"}


def progress(done: str, count: str = "subgroups"):
    """None, some or all of a transfer's sub-groups; NULL without any sub-group."""
    n, all_ = F.col(done), F.col(count)
    return F.when(all_.isNull(), None).when((n > 0) & (n < all_), SOME).when(n == all_, ALL).otherwise(NONE)


def list_transfers(transfers: DataFrame, pairs: DataFrame, subgroups: DataFrame, start=None, end=None, status_id=None) -> DataFrame:
    """Hospital transfers with the progress of e-mails and document uploads."""
    states = pairs.select("transfer_id", "subgroup_id").distinct().join(subgroups.select("subgroup_id", "is_mailed", "is_uploaded"), "subgroup_id")
    counts = states.groupBy("transfer_id").agg(
        F.count("subgroup_id").alias("subgroups"), count_when(F.col("is_mailed") == 1).alias("mailed"), count_when(F.col("is_uploaded") == 1).alias("uploaded"))
    rows = keep_where(transfers.filter("group_type = 4").filter(half_open("created_at", start, end)), status_id=status_id)
    return rows.join(counts, "transfer_id", "left").withColumns({"mail_status": progress("mailed"), "upload_status": progress("uploaded")})


def transfer_page(rows: DataFrame, field=None, direction=None, start=None, size=None, statuses: DataFrame | None = None) -> DataFrame:
    """A page of transfers; sorting by status goes by its name, which ``statuses`` (status_id, status) gives."""
    if statuses is not None:
        rows = rows.join(statuses.select("status_id", "status"), "status_id", "left")
    return page(rows, sort_columns(field, direction, TRANSFER_SORT, [], ["transfer_id"]), start, size)


def list_transfer_monitor(transfers: DataFrame, start=None, end=None, status_id=None, group_type=None) -> DataFrame:
    """Transfers paid out of pocket."""
    return keep_where(transfers.filter(half_open("created_at", start, end)).filter("oop_status = 3"), status_id=status_id, group_type=group_type)


def list_out_of_pocket(transfers: DataFrame, pairs: DataFrame, limit: float, start=None, end=None, oop_status=None, group_type=None) -> DataFrame:
    """Transfers with an over-limit flag and a flag for existing sub-groups.

    ``pairs``: transfer_id, transaction_type of its sub-groups. Hospital transfers are listed once
    they have sub-groups of type 1.
    """
    rows = keep_where(transfers.filter(half_open("created_at", start, end)), oop_status=oop_status, group_type=group_type)
    marks = pairs.groupBy("transfer_id").agg(F.max(flag(F.col("transaction_type") == 1)).alias("has_transfer_group"), F.lit(1).alias("is_grouped"))
    return rows.join(marks, "transfer_id", "left").filter((F.col("group_type") != 4) | (F.col("has_transfer_group") == 1)).withColumns({
        "over_limit": flag(F.col("amount") > F.lit(limit)), "is_grouped": F.coalesce("is_grouped", F.lit(0))})


def list_paybacks(paybacks: DataFrame, transfers: DataFrame, branches: DataFrame, pairs: DataFrame | None = None, transfer_ids: DataFrame | None = None,
                  subgroup_id=None, start=None, end=None, group_type=None, waiting_only: bool = False) -> DataFrame:
    """Pay-backs of transfers, or those waiting for one. Type 4 asks for hospital claims of both types."""
    rows = paybacks.filter(half_open("created_at", start, end))
    if waiting_only:
        rows = rows.filter("status_id = 2")
    if group_type is not None:
        rows = keep_where(rows, group_type=[4, 8] if group_type == 4 else group_type)
    if transfer_ids is not None:
        rows = rows.join(transfer_ids.select("transfer_id"), "transfer_id", "left_semi")
    if pairs is not None:
        rows = keep_where(rows.join(pairs.select("payback_id", "subgroup_id"), "payback_id", "left"), subgroup_id=subgroup_id)
    dates = transfers.select("transfer_id", F.col("created_at").alias("transfer_created_at"))
    return rows.join(dates, "transfer_id", "left").join(branches.select("branch_id", "branch"), "branch_id", "left")


def claim_link(product, claim_code, links: dict[str, str], misc_id=None):
    """Deep link of a claim: Base64 of its code for health and accident, plain id for the rest."""
    token = link_token(claim_code)
    other = join_text(F.lit(links["misc"]), misc_id if misc_id is not None else claim_code)
    return (F.when(product == 2, F.concat(F.lit(links["health"]), token)).when(product == 3, F.concat(F.lit(links["accident"]), token))
            .when(product.between(4, 11), other).otherwise(""))


def list_payback_claims(claims: DataFrame, details: DataFrame, links: dict[str, str], detail_codes: DataFrame | None = None) -> DataFrame:
    """Claims of pay-back details with their link."""
    heads = details if detail_codes is None else details.join(detail_codes, "detail_code", "left_semi")
    rows = claims.join(heads.select("payback_id", "hospital_id", "detail_code", "group_type"), ["payback_id", "hospital_id"])
    return rows.withColumn("link", claim_link(F.col("group_type"), F.col("claim_code"), links))


def list_group_items(health: DataFrame, accident: DataFrame, misc: DataFrame, misc_admits: DataFrame, links: dict[str, str], codes: DataFrame | None = None) -> DataFrame:
    """Items of claim groups from three sources, without duplicates.

    Sources carry group_code, claim_code, product_name, hospital_name, admit_type. Miscellaneous claims
    list their distinct admit types (``misc_admits``: claim_code, admit_name).
    """
    names = distinct_text(misc_admits, ["claim_code"], "admit_name", ",", "admit_type")
    sources = {"health": health, "accident": accident, "misc": misc.drop("admit_type").join(names, "claim_code", "left")}
    out = None
    for name, frame in sources.items():
        token = F.col("claim_code") if name == "misc" else link_token(F.col("claim_code"))
        part = frame.withColumn("link", F.concat(F.lit(links[name]), token)).select("group_code", "claim_code", "product_name", "hospital_name", "admit_type", "link")
        if codes is not None:
            part = part.join(codes.select("group_code"), "group_code", "left_semi")
        out = part if out is None else out.unionByName(part)
    return out.distinct()


def list_subgroup_siblings(pairs: DataFrame, transfers: DataFrame, subgroups: DataFrame, transfer_ids: DataFrame) -> DataFrame:
    """Sub-groups that hold pay-backs of the asked transfers, with all transfers sharing them.

    The result grows with the sub-group memberships, not with their pairs.
    """
    asked = transfer_ids.select("transfer_id").distinct().withColumn("is_asked", F.lit(1))
    members = pairs.select("subgroup_id", "transfer_id").distinct()
    touched = members.join(asked.select("transfer_id"), "transfer_id", "left_semi").select("subgroup_id").distinct()
    rows = members.join(touched, "subgroup_id", "left_semi").join(asked, "transfer_id", "left").join(
        transfers.select("transfer_id", "transfer_code", "oop_status", F.col("status_id").alias("transfer_status")), "transfer_id")
    return rows.join(subgroups.select("subgroup_id", "subgroup_code", "amount", "is_paid"), "subgroup_id", "left").withColumn("is_asked", F.coalesce("is_asked", F.lit(0)))


def list_repay(transactions: DataFrame, subgroups: DataFrame, hospitals: DataFrame, accounts: DataFrame, organisations: DataFrame) -> DataFrame:
    """Failed or returned sub-group payments to be paid again.

    The configured account goes before the hospital's own; the bank is the sending or receiving
    organisation of that account, otherwise the hospital's bank. ``accounts``: subgroup_id,
    receiving_no, sending_bank, receiving_bank. ``organisations``: org_id, org_name.
    """
    failed = transactions.filter(F.col("status_id").isin(4, 6))
    rows = (failed.join(subgroups.select("subgroup_id", "subgroup_code", "amount", "item_count", "hospital_id"), "subgroup_id", "left")
            .join(hospitals.select("hospital_id", "hospital_name", "account_no", "bank_name"), "hospital_id", "left").join(accounts, "subgroup_id", "left"))
    named = or_join(rows, organisations, ["sending_bank", "receiving_bank"], "org_id")
    return named.withColumns({
        "bank_account": F.coalesce("receiving_no", F.replace(F.col("account_no"), F.lit("-"), F.lit(""))),
        "bank": F.coalesce("org_name", "bank_name")})


def list_imported_groups(imported: DataFrame, details: DataFrame, covers: DataFrame, group_branches: DataFrame, branches: DataFrame,
                         start=None, end=None, status_id=None, branch_id=None, search=None) -> DataFrame:
    """Imported groups with the amount left after covers. Status 4 is listed regardless of dates.

    ``covers``: detail_id, cover_amount of active results. ``group_branches`` is the union of the
    branch of each group over its sources.
    """
    rows = keep_where(imported.filter("is_active"), status_id=status_id)
    if status_id != 4:
        rows = rows.filter(half_open("created_at", start, end))
    rows = rows.filter(contains_text("group_code", search)).drop("branch_id")
    sums = details.select("import_id", "detail_id").join(covers, "detail_id").groupBy("import_id").agg(money(F.sum("cover_amount")).alias("covered"))
    named = rows.join(sums, "import_id", "left").join(group_branches, "group_code", "left").join(branches.select("branch_id", "branch"), "branch_id", "left")
    net = F.when(F.col("status_id").isin(2, 3, 4), F.col("total_amount") - F.coalesce("covered", F.lit(0))).otherwise(F.col("total_amount"))
    return keep_where(named.withColumn("net_amount", money(net)), branch_id=branch_id)


def import_detail_view(details: DataFrame, results: DataFrame, links: dict[str, str], detail_ids: DataFrame | None = None) -> DataFrame:
    """Imported claims with their cover, split into manual and other, and their links."""
    rows = details if detail_ids is None else details.join(detail_ids.select("detail_id"), "detail_id", "left_semi")
    booked = results.filter("is_active").select("detail_id", F.col("cover_amount").alias("booked"), "is_manual")
    zero = F.lit(0).cast("decimal(16,2)")
    value = F.coalesce("booked", zero)
    manual = F.col("is_manual") == 1
    token = link_token(F.col("claim_code"))
    kind = F.col("group_type")
    return rows.join(booked, "detail_id", "left").withColumns({
        "cover_amount": F.when(manual, zero).otherwise(value), "npl_amount": F.when(manual, value).otherwise(zero),
        "claim_link": F.when(kind.isin(2, 4, 5), F.concat(F.lit(links["health"]), token)).when(kind == 3, F.concat(F.lit(links["accident"]), token))
        .when(kind == 6, join_text(F.lit(links["misc"]), F.col("import_id"))).otherwise("")})


def list_bills(bills: DataFrame, insurers: DataFrame, sftp_config: DataFrame, sftp_products: DataFrame, export_products: DataFrame,
               insurer_id=None, billing_date=None, status_id=None, claim_type=None, group_type=None, search=None) -> DataFrame:
    """Bills with their file-transfer flag: insurer configured, unless its product says otherwise.

    A group type above 5 asks for a product type among the bill's exported claims.
    """
    rows = keep_where(bills, insurer_id=insurer_id, status_id=status_id, claim_type_code=claim_type).filter(contains_text("bill_code", search))
    if billing_date is not None:
        rows = rows.filter(F.col("billing_date") == F.lit(str(billing_date)).cast("date"))
    if group_type is not None:
        with_product = export_products.filter(F.col("product_type") == group_type).select("bill_code").distinct().withColumn("has_product", F.lit(True))
        rows = rows.join(with_product, "bill_code", "left").filter((F.col("group_type") == group_type) | (F.lit(group_type > 5) & F.col("has_product").isNotNull())).drop("has_product")
    named = (rows.join(insurers.select("insurer_id", "insurer_code"), "insurer_id", "left")
             .join(sftp_config.select("insurer_code").distinct().withColumn("configured", F.lit(1)), "insurer_code", "left")
             .join(sftp_products.select("insurer_code", "group_type", F.col("is_sftp").alias("product_sftp")), ["insurer_code", "group_type"], "left"))
    return named.withColumn("is_sftp", F.when(F.col("configured") == 1, F.coalesce("product_sftp", F.lit(1))).otherwise(0))


def bill_page(rows: DataFrame, field=None, direction=None, start=None, size=None, insurers: DataFrame | None = None,
              group_types: DataFrame | None = None, claim_types: DataFrame | None = None) -> DataFrame:
    """A page of bills; sorting by insurer, group type or claim type goes by their names, which the lookups give.

    ``insurers``: insurer_id, insurer_name; ``group_types``: group_type, group_type_name; ``claim_types``: claim_type_code, claim_type.
    """
    for names, key in ((insurers, "insurer_id"), (group_types, "group_type"), (claim_types, "claim_type_code")):
        if names is not None:
            rows = rows.join(names, key, "left")
    return page(rows, sort_columns(field, direction, BILL_SORT, [], ["bill_code"]), start, size)


def list_bill_items(items: DataFrame, imported: DataFrame, branches: DataFrame, bill_codes: DataFrame | None = None) -> DataFrame:
    """Items of bills net of cover; miscellaneous bills start from the amount of the group."""
    rows = items if bill_codes is None else items.join(bill_codes.select("bill_code"), "bill_code", "left_semi")
    totals = imported.select("import_id", "total_amount")
    base = F.when(F.col("group_type") == 6, F.coalesce("total_amount", F.lit(0))).otherwise(F.coalesce("pay_total", F.lit(0)))
    return rows.join(totals, "import_id", "left").join(branches.select("branch_id", "branch"), "branch_id", "left").withColumn(
        "net_amount", money(base - F.coalesce("cover_amount", F.lit(0))))
