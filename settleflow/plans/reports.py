"""Finance, billing and claim reports, export rows and dimensions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settleflow.functions import messages as M
from settleflow.functions.scalars import join_text, money
from settleflow.operators.aggregates import latest_per_key
from settleflow.operators.filters import half_open, keep_where
from settleflow.operators.joins import or_join
from settleflow.plans.columns import ACCIDENT_VIEW, HEALTH_VIEW, MISC_VIEW, select_wide

COMPENSATE = 5
REPORT_COLUMNS = ["insurer_name", "branch", "hospital", "product", "group_type", "group_code", "item_count", "amount", "compensate_code", "claim_code",
                  "online_code", "province", "customer_name", "bank_name", "account_no", "phone", "sent_at", "paid_at", "approved_by", "created_by",
                  "admit_type", "app_id", "policy_state", "school"]


def only_for(kind: int, kinds: tuple[int, ...], value: str, as_type: str = "string") -> Column:
    """A report column that only some claim-group types fill."""
    return F.col(value) if kind in kinds else F.lit(None).cast(as_type)


def claim_attributes(health: DataFrame, accident: DataFrame, misc: DataFrame) -> DataFrame:
    """Claims of three sources with insurer, admit type, customer and source-specific columns."""
    return (health.unionByName(accident.distinct(), allowMissingColumns=True).unionByName(misc, allowMissingColumns=True))


def payback_facts(paybacks: DataFrame, details: DataFrame, kind: int, products: DataFrame, product_of_group: DataFrame,
                  insurer_id=None, product_id=None) -> DataFrame:
    """The few pay-back details a report is about, with the name of their product.

    The product is found by the detail's product group or by the product type of the group.
    """
    heads = paybacks.filter(F.col("group_type") == kind)
    lines = keep_where(details, insurer_id=insurer_id)
    facts = heads.join(lines, "payback_id").join(product_of_group, "group_code", "left")
    named = or_join(facts, products, ["product_group", "product_type"], "product_key")
    return keep_where(named, product_group_id=product_id)


def report_noncomp(paybacks: DataFrame, details: DataFrame, claims: DataFrame, branches: DataFrame, hospitals: DataFrame, persons: DataFrame,
                   products: DataFrame, product_of_group: DataFrame, kind: int, start=None, end=None, insurer_id=None, product_id=None) -> DataFrame:
    """Pay-backs other than compensations before their transfer, one row per claim.

    Which columns are filled depends on the claim-group type.
    """
    heads = paybacks.filter(half_open("sent_at", start, end))
    return _noncomp(heads, details, claims, branches, hospitals, persons, products, product_of_group, kind, insurer_id, product_id)


def report_transferred(transfers: DataFrame, paybacks: DataFrame, details: DataFrame, claims: DataFrame, branches: DataFrame, hospitals: DataFrame,
                       persons: DataFrame, products: DataFrame, product_of_group: DataFrame, kind: int, start=None, end=None, insurer_id=None, product_id=None) -> DataFrame:
    """As ``report_noncomp`` for pay-backs whose transfer was paid in the period."""
    paid = transfers.filter(half_open("paid_at", start, end)).select("transfer_id", F.col("paid_at").alias("transfer_paid_at"))
    heads = paybacks.join(paid, "transfer_id").withColumn("paid_at", F.col("transfer_paid_at")).drop("transfer_paid_at")
    return _noncomp(heads, details, claims, branches, hospitals, persons, products, product_of_group, kind, insurer_id, product_id)


def _noncomp(heads, details, claims, branches, hospitals, persons, products, product_of_group, kind, insurer_id, product_id):
    facts = payback_facts(heads, details, kind, products, product_of_group, insurer_id, product_id)
    rows = (
        facts.join(claims, "group_code", "left")
        .join(branches.select("branch_id", "branch"), "branch_id", "left")
        .join(hospitals.select("hospital_id", F.col("hospital_name").alias("hospital"), "province", "bank_name", "account_no"), "hospital_id", "left")
        .join(persons.select(F.col("user_id").alias("created_by_id"), F.col("person_name").alias("created_by")), "created_by_id", "inner")
        .join(persons.select(F.col("user_id").alias("approved_by_id"), F.col("person_name").alias("approved_by")), "approved_by_id", "left")
    )
    bank = (4, 6, 8)
    product = F.col("product_name") if kind in (2, 4, 6) else F.col("product_type_name") if kind in (7, 8) else F.lit(None).cast("string")
    account = F.replace(F.col("account_no"), F.lit("-"), F.lit(""))
    shown = rows.withColumns({
        "product": product, "hospital": only_for(kind, (4, 6, 7, 8), "hospital"), "online_code": only_for(kind, (2, 6, 7, 8), "online_code"),
        "province": only_for(kind, (2, 4, 6, 7, 8), "province"), "customer_name": only_for(kind, (2, 4, 6, 7, 8), "customer_name"),
        "bank_name": only_for(kind, bank, "bank_name"), "account_no": account if kind in bank else F.lit(None).cast("string"),
        "app_id": only_for(kind, (2, 4), "app_id"), "policy_state": only_for(kind, (2, 4), "policy_state"), "school": only_for(kind, (2, 4), "school"),
        "compensate_code": F.lit(None).cast("string"), "phone": F.lit(None).cast("string")})
    return shown.select(*REPORT_COLUMNS)


def report_comp(paybacks: DataFrame, details: DataFrame, compensations: DataFrame, branches: DataFrame, persons: DataFrame,
                start=None, end=None, insurer_id=None, product_id=None, transfers: DataFrame | None = None) -> DataFrame:
    """Compensations, before their transfer or, with ``transfers``, those paid in the period."""
    heads = paybacks.filter(F.col("group_type") == COMPENSATE)
    if transfers is None:
        heads = heads.filter(half_open("sent_at", start, end))
    else:
        paid = transfers.filter(half_open("paid_at", start, end)).select("transfer_id", F.col("paid_at").alias("transfer_paid_at"))
        heads = heads.join(paid, "transfer_id").withColumn("paid_at", F.col("transfer_paid_at")).drop("transfer_paid_at")
    lines = keep_where(details, insurer_id=insurer_id, product_group=product_id)
    rows = (
        heads.join(lines.drop("hospital_id"), "payback_id").join(compensations, "group_code", "left").join(branches.select("branch_id", "branch"), "branch_id", "left")
        .join(persons.select(F.col("user_id").alias("created_by_id"), F.col("person_name").alias("created_by")), "created_by_id")
        .join(persons.select(F.col("user_id").alias("approved_by_id"), F.col("person_name").alias("approved_by")), "approved_by_id")
    )
    return rows.select("insurer_name", "branch", "hospital", "group_type", "group_code", "item_count", "amount", "compensate_code", "claim_code",
                       "province", "customer_name", "phone", "sent_at", "paid_at", "approved_by", "created_by", "admit_type")


def report_finance(kind: int, comp_inputs: dict, noncomp_inputs: dict, **period) -> DataFrame:
    """Compensations for type 5, everything else in the general report; only one plan is built."""
    if kind == COMPENSATE:
        return report_comp(**comp_inputs, **period)
    return report_noncomp(**noncomp_inputs, kind=kind, **period)


def report_noncomp_detail(claims: DataFrame, online_payments: DataFrame, misc_payments: DataFrame, branches: DataFrame, kind: int, misc_product: int = 38) -> DataFrame:
    """Claims with the payments of their beneficiaries (type 6, and type 7 for one product).

    Of repeated payments to the same beneficiary account, payment type and relation the newest counts.
    """
    keys = ["misc_id", "account_name", "payment_type", "relation"]
    order = [F.col("transfer_date").desc_nulls_last(), *[F.col(c).asc() for c in misc_payments.columns if c.startswith("tie")]]
    newest = latest_per_key(misc_payments, keys, order)
    rows = claims.join(branches.select("branch_id", "branch"), "branch_id", "left").join(newest, "misc_id", "left")
    if kind == 6:
        online = online_payments.select("claim_code", F.col("amount").alias("online_amount"), F.col("account_name").alias("online_account"))
        return rows.join(online, "claim_code", "left")
    return rows.filter(F.col("product_type") == misc_product).withColumns({
        "online_amount": F.lit(None).cast("decimal(16,2)"), "online_account": F.lit(None).cast("string")})


def hospital_claim_rows(paybacks: DataFrame, claims: DataFrame, hospitals: DataFrame, customers: DataFrame) -> DataFrame:
    """Prepared rows of the hospital claim report (types 4 and 8), appended whenever pay-backs are created."""
    return (paybacks.filter(F.col("group_type").isin(4, 8)).join(claims, "payback_id")
            .join(hospitals.select("hospital_id", "hospital_name"), "hospital_id", "left").join(customers, "customer_id", "left")
            .select("group_type", "hospital_name", "group_code", "claim_code", "customer_name", "claim_pay", "sent_at", "paid_at", F.lit(True).alias("is_active")))


def report_hospital_claims(prepared: DataFrame, kind: int, start=None, end=None) -> DataFrame:
    return prepared.filter((F.col("group_type") == kind) & F.col("is_active")).filter(half_open("sent_at", start, end)).drop("group_type", "is_active")


def report_billing(imported: DataFrame, details: DataFrame, results: DataFrame, compensated: DataFrame, search_type: int, start=None, end=None,
                   insurer_id=None, status_id=None) -> DataFrame:
    """Claims with manual NPL, all NPL and automatic covers and what is left to bill.

    Search type 1 goes by creation, 2 by billing date. Without a status, waiting and cancelled groups
    (2, 4) are listed. Each cover kind is summed per claim before it is joined.
    """
    column = {1: "created_at", 2: "billing_date"}[search_type]
    heads = keep_where(imported.filter("is_active").filter(half_open(column, start, end)), insurer_id=insurer_id, status_id=[2, 4] if status_id is None else status_id)
    lines = details.select("import_id", "detail_id", "claim_code", "pay_total", "happened_at")
    active = F.col("is_active")
    manual = results.filter(active & (F.col("is_manual_npl") == 1)).select("detail_id", F.col("cover_amount").alias("manual_npl"))
    all_npl = results.filter("is_manual_npl = 1").groupBy("claim_code").agg(money(F.sum("cover_amount")).alias("npl_total"))
    auto = (results.filter(active & (F.col("is_manual_npl") == 0)).join(compensated.select("claim_code"), "claim_code", "left_anti")
            .groupBy("claim_code").agg(money(F.sum("cover_amount")).alias("auto_total")))
    zero = F.lit(0).cast("decimal(16,2)")
    rows = (heads.select("import_id", "group_code", "group_type", "item_count", "insurer_id", "claim_type_code", "status_id", "created_at", "billing_date", "total_amount")
            .join(lines, "import_id", "left").join(manual, "detail_id", "left").join(all_npl, "claim_code", "left").join(auto, "claim_code", "left"))
    npl, auto_sum, all_sum = (F.coalesce(c, zero) for c in ("manual_npl", "auto_total", "npl_total"))
    return rows.withColumns({"manual_npl": npl, "npl_total": all_sum, "auto_total": auto_sum,
                             "net_total": money(F.col("pay_total") - auto_sum - all_sum),
                             # newer per-type form: the group total is the base of miscellaneous groups
                             "net_by_type": money(F.when(F.col("group_type") == 6, F.col("total_amount") - npl - auto_sum).otherwise(F.col("pay_total") - auto_sum - npl))})


def report_rejects(results: DataFrame, items: DataFrame, sources: list[DataFrame], branches: DataFrame, decision_id=None, start=None, end=None, insurer_id=None) -> DataFrame:
    """Rejected and partly approved items; decision 3 asks for the partly approved ones.

    ``sources``: claim_code, branch_id of the user who filed the claim; duplicates between sources count once.
    """
    partly = (F.col("decision_id") == 2) & (F.col("uncover_amount") > 0)
    rows = results.filter((F.col("decision_id") == 4) | partly).filter(half_open("decided_at", start, end))
    if decision_id == 3:
        rows = rows.filter(partly)
    elif decision_id is not None:
        rows = rows.filter(F.col("decision_id") == decision_id)
    filed = sources[0]
    for more in sources[1:]:
        filed = filed.unionByName(more)
    lines = keep_where(items, insurer_id=insurer_id).select("item_code", "bill_code", "billing_date", "group_code", "claim_code", "insurer_id", "amount_total")
    return (rows.select("item_code", "uncover_amount", "remark", "decision_id", "decided_at").join(lines, "item_code")
            .join(filed.distinct(), "claim_code", "left").join(branches.select("branch_id", "branch"), "branch_id", "left")
            .withColumn("decision", F.when(partly, M.PARTLY_APPROVED).otherwise(F.col("decision_id").cast("string"))))


def report_confirmed(items: DataFrame, results: DataFrame, confirmations: DataFrame, date_type: int, start=None, end=None, insurer_id=None, claim_type=None, group_type=None) -> DataFrame:
    """Billed claims with result and confirmation, by import date (1) or billing date (2)."""
    column = {1: "created_at", 2: "billing_date"}[date_type]
    rows = keep_where(items.filter(half_open(column, start, end)), insurer_id=insurer_id, claim_type_code=claim_type, group_type=group_type)
    known = results.select("item_code", "decision_id", "payment_ref", F.col("cover_amount").alias("result_cover"), "uncover_amount")
    paid = confirmations.filter("is_active").select("item_code", "payment", "confirmed_at")
    zero = F.lit(0)
    has_ref = F.col("payment_ref").isNotNull()
    return rows.join(known, "item_code", "left").join(paid, "item_code", "left").withColumns({
        "net_amount": money(F.coalesce("pay_total", zero) - F.coalesce("cover_amount", zero)),
        "shown_cover": F.when(has_ref, F.col("result_cover")), "shown_uncover": F.when(has_ref, F.col("uncover_amount"))})


def report_before_approval(claims: DataFrame, approvals: DataFrame, online_pay: DataFrame, own_company: int) -> DataFrame:
    """Online claims filed before their policy was approved, or without any approval."""
    paid = online_pay.filter("payment_status_id = 4").groupBy("online_id").agg(money(F.sum("amount")).alias("paid_amount"))
    rows = claims.filter((F.col("insurer_id") != own_company) & (F.col("is_online") == 1)).join(approvals, "app_id", "left")
    late = (F.col("approved_at") > F.col("filed_at")) | F.col("approved_at").isNull()
    return rows.filter(late).join(paid, "online_id", "left")


def insurer_view(kind: str, claims: DataFrame, export: DataFrame, bill_codes: DataFrame | None = None, documents: DataFrame | None = None,
                 widen: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """What an insurer sees of its exported claims: the ``accident``, ``health`` or ``misc`` form, a row for each claim and export row.

    ``claims`` is the claim view the accident and health forms start from: claims without an export row stay there with empty
    bill columns, unless ``bill_codes`` asks for certain bills; accident claims of people no longer insured (``is_insured``) are left out.
    The miscellaneous form starts from the export rows, with a row for each document of the claim (``documents``: claim_code, document_id,
    document_code). Columns nobody fills are NULL of their type. ``claims`` may be narrow: ``widen`` adds after the join what else a claim shows.
    """
    sent = export if bill_codes is None else export.join(bill_codes.select("bill_code"), "bill_code", "left_semi")
    if kind == "misc":
        misc = sent.filter("group_type = 6")
        rows = misc if documents is None else misc.join(documents.select("claim_code", "document_id", "document_code"), "claim_code", "left")
        return view_columns(kind, rows)
    billed = sent.select("claim_code", "bill_code", "item_code", F.col("document_link").alias("x_link"), F.col("province").alias("x_province"), F.col("organ").alias("x_organ"))
    return view_columns(kind, widen(claims.drop("bill_code", "item_code").join(billed, "claim_code", "left" if bill_codes is None else "inner")))


def view_columns(kind: str, rows: DataFrame) -> DataFrame:
    """The columns of ``insurer_view`` for claims that have met their export rows."""
    if kind == "misc":
        return rows.select(*select_wide(rows, MISC_VIEW, {"document_link": F.lit(None), "branch_name": F.lit(None)}))
    if kind == "health":
        return rows.select(*select_wide(rows, HEALTH_VIEW))
    rows = rows.filter("is_insured")
    return rows.select(*select_wide(rows, ACCIDENT_VIEW, {
        "remark": F.col("accident_detail"), "document_link": F.col("x_link"), "province": F.col("x_province"), "organ": F.col("x_organ")}))


def document_index(groups: DataFrame, filed: DataFrame, online: DataFrame, codes: DataFrame | None = None,
                   skipped_type: int = 3, skipped_subtype: int = 340) -> DataFrame:
    """Documents of claim groups with the index value their store uses.

    Documents filed with the claim are indexed by the claim number; online documents appear twice, by
    application and by their own code. Groups without documents stay with an empty index.
    """
    own = filed.filter(F.col("document_type") != skipped_type).select("misc_id", "document_id", "document_code", "document_type", F.lit("claim").alias("source"))
    from_online = online.filter(F.col("document_subtype") != skipped_subtype).select("misc_id", "document_id", "document_code", F.lit(None).cast("int").alias("document_type"))
    both = from_online.select("*", F.explode(F.array(F.lit("application"), F.lit("code"))).alias("source"))
    rows = groups if codes is None else groups.join(codes.select("group_code"), "group_code", "left_semi")
    index = F.when(F.col("source") == "claim", F.col("claim_no")).when(F.col("source") == "application", F.col("application_code")).when(F.col("source") == "code", F.col("document_code"))
    return rows.join(own.unionByName(both), "misc_id", "left").withColumn("main_index", index)


def person_dimension(users: DataFrame, persons: DataFrame, titles: DataFrame) -> DataFrame:
    """Active users with their full name; a missing part leaves no name."""
    return (users.filter("is_active").join(persons, "person_id", "left").join(titles, "title_id")
            .withColumn("person_name", F.concat("title", "first_name", F.lit(" "), "last_name")))


def organisation_dimension(organisations: DataFrame, companies: DataFrame, org_type: int = 2) -> DataFrame:
    """Insurers with the short names of the company register."""
    return organisations.filter((F.col("org_type") == org_type) & F.col("is_active")).join(companies, "org_code")
