"""Reports D30 to D41."""

from __future__ import annotations

from pyspark.sql import functions as F

from settleflow.catalogue.base import query
from settleflow.functions import messages as M
from settleflow.functions.scalars import join_text
from settleflow.operators.joins import values_table
from settleflow.plans import reports as R

PRODUCTS = [(1, "รอข้อมูล", 1), (2, "PH", 2), (3, "PA", 3), (4, "Motor", 4), (27, "PA 27", 11), (32, "Plus 32", 11), (33, "Travel 33", 11)]


def persons(r):
    return r.t("customer").select(F.col("c_custkey").alias("user_id"), F.concat("c_mktsegment", F.lit(" "), F.col("c_name")).alias("person_name"))


def heads(r):
    return r.payback.select("payback_id", "group_type", "branch_id", "transfer_id", F.col("created_at").alias("sent_at"), F.lit(None).cast("timestamp_ntz").alias("paid_at"),
                            F.col("customer_id").alias("created_by_id"))


def lines(r):
    return r.payback_detail.select("payback_id", "group_code", "insurer_id", "hospital_id", "item_count", "amount", F.col("group_type").alias("product_group"),
                                   join_text(F.lit("CO"), F.col("payback_id")).alias("online_code"))


def hospitals(r):
    return r.hospital.select("hospital_id", "hospital_name", join_text(F.lit("province "), F.col("nation_id")).alias("province"),
                             join_text(F.lit("bank "), F.col("nation_id")).alias("bank_name"), F.concat_ws("-", "nation_id", "hospital_id").alias("account_no"))


def attributes(r):
    d = r.import_detail.join(r.t("customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name")), "customer_id", "left")
    base = d.select("group_code", "group_type", "claim_code", join_text(F.lit("Insurer "), F.col("insurer_id")).alias("insurer_name"), F.col("rf").alias("admit_type"),
                    "customer_name", F.col("insurer_id").cast("long").alias("approved_by_id"), "customer_id", "line_no")
    none = F.lit(None).cast("string")
    health = base.filter("group_type IN (2, 4, 5)").select("group_code", "claim_code", "insurer_name", "admit_type", "customer_name", "approved_by_id", none.alias("product_type_name"))
    accident = base.filter("group_type = 3").select("group_code", "claim_code", "insurer_name", "admit_type", "customer_name", "approved_by_id",
                                                   join_text(F.lit("APP"), F.col("customer_id")).alias("app_id"), F.lit("active").alias("policy_state"), join_text(F.lit("School "), F.col("line_no")).alias("school"))
    misc = base.filter("group_type = 6").select("group_code", "claim_code", "insurer_name", "admit_type", "customer_name", "approved_by_id", F.lit("Misc").alias("product_type_name"))
    return R.claim_attributes(health, accident, misc)


def noncomp_inputs(r):
    groups = r.group.select("group_code", F.when(F.col("group_type") == 6, F.when(F.col("branch_id") % 3 == 0, 27).when(F.col("branch_id") % 3 == 1, 32)).alias("product_type"))
    return dict(paybacks=heads(r), details=lines(r), claims=attributes(r), branches=r.branch, hospitals=hospitals(r), persons=persons(r),
                products=values_table(r.spark, ["product_key", "product_name", "product_group_id"], PRODUCTS), product_of_group=groups)


REPORT = ("insurer_name:s branch:s hospital:s product:s group_code:s item_count:i amount:d claim_code:s online_code:s province:s customer_name:s bank_name:s account_no:s "
          "sent_at:t paid_at:t approved_by:s created_by:s admit_type:s app_id:s policy_state:s school:s")
VALUES_SQL = ", ".join(f"({k}, '{n}', {g})" for k, n, g in PRODUCTS)


def noncomp_sql(kind, source, where=""):
    """General report of one claim-group type, with the columns that type shows."""
    show = lambda kinds, text: text if kind in kinds else "CAST(NULL AS VARCHAR)"
    return f"""pers AS (SELECT c_custkey AS user_id, c_mktsegment || ' ' || c_name AS person_name FROM customer),
    prod(product_key, product_name, product_group_id) AS (VALUES {VALUES_SQL}),
    gt AS (SELECT group_code, CASE WHEN group_type=6 THEN CASE branch_id%3 WHEN 0 THEN 27 WHEN 1 THEN 32 END END AS product_type FROM r_group),
    cl AS (SELECT d.group_code, d.claim_code, 'Insurer ' || d.insurer_id AS insurer_name, d.rf AS admit_type, c.c_name AS customer_name, d.insurer_id AS approved_by_id,
      CASE WHEN group_type=6 THEN 'Misc' END AS product_type_name, CASE WHEN group_type=3 THEN 'APP' || d.customer_id END AS app_id, CASE WHEN group_type=3 THEN 'active' END AS policy_state,
      CASE WHEN group_type=3 THEN 'School ' || line_no END AS school FROM r_import_detail d LEFT JOIN customer c ON c.c_custkey=d.customer_id),
    src AS ({source}),
    x AS (SELECT cl.insurer_name, b.branch, {show((4, 6, 7, 8), 'h.hospital_name')} AS hospital, {'p.product_name' if kind in (2, 4, 6) else 'cl.product_type_name' if kind in (7, 8) else 'CAST(NULL AS VARCHAR)'} AS product,
      l.group_code, l.item_count, l.amount, cl.claim_code, {show((2, 6, 7, 8), "'CO' || l.payback_id")} AS online_code, {show((2, 4, 6, 7, 8), "'province ' || h.nation_id")} AS province,
      {show((2, 4, 6, 7, 8), 'cl.customer_name')} AS customer_name, {show((4, 6, 8), "'bank ' || h.nation_id")} AS bank_name, {show((4, 6, 8), "h.nation_id || '' || h.hospital_id")} AS account_no,
      src.sent_at, src.paid_at, a.person_name AS approved_by, u.person_name AS created_by, cl.admit_type, {show((2, 4), 'cl.app_id')} AS app_id, {show((2, 4), 'cl.policy_state')} AS policy_state, {show((2, 4), 'cl.school')} AS school
      FROM src JOIN r_payback_detail l ON l.payback_id=src.payback_id LEFT JOIN gt ON gt.group_code=l.group_code LEFT JOIN prod p ON p.product_key=l.group_type OR p.product_key=gt.product_type
      LEFT JOIN cl ON cl.group_code=l.group_code LEFT JOIN r_branch b ON b.branch_id=src.branch_id LEFT JOIN r_hospital h ON h.hospital_id=l.hospital_id
      JOIN pers u ON u.user_id=src.customer_id LEFT JOIN pers a ON a.user_id=cl.approved_by_id {where})
    ;; SELECT * FROM x"""


def sent_sql(kind):
    return f"""SELECT payback_id, customer_id, branch_id, created_at AS sent_at, CAST(NULL AS TIMESTAMP) AS paid_at FROM r_payback
        WHERE group_type={kind} AND created_at >= '1995-06-01' AND created_at < '2001-01-01'"""


PERIOD = dict(start="1995-06-01", end="2000-12-31")


@query("report_noncomp", REPORT, noncomp_sql(4, sent_sql(4)))
def _(r):
    return R.report_noncomp(**noncomp_inputs(r), kind=4, **PERIOD)


@query("report_noncomp_online", REPORT, noncomp_sql(2, sent_sql(2), "WHERE p.product_group_id=2 AND l.insurer_id=3"))
def _(r):
    return R.report_noncomp(**noncomp_inputs(r), kind=2, insurer_id=3, product_id=2, **PERIOD)


@query("report_noncomp_death", REPORT, noncomp_sql(6, sent_sql(6)))
def _(r):
    return R.report_noncomp(**noncomp_inputs(r), kind=6, **PERIOD)


def transfer_dates(r):
    return r.transfer.select("transfer_id", F.when(F.col("group_type").isin(2, 4, 5), F.col("created_at")).alias("paid_at"))


@query("report_transferred", REPORT,
       noncomp_sql(4, """SELECT payback_id, customer_id, branch_id, p.created_at AS sent_at, t.created_at AS paid_at FROM r_payback p JOIN r_transfer t ON t.transfer_id=p.transfer_id
          WHERE t.group_type IN (2,4,5) AND p.group_type=4 AND t.created_at >= '1995-06-01' AND t.created_at < '2001-01-01'"""))
def _(r):
    return R.report_transferred(transfer_dates(r), **noncomp_inputs(r), kind=4, **PERIOD)


def misc_inputs(r):
    """Pay-backs of type 6 as miscellaneous ones: even numbers type 7, odd ones (of hospitals) type 8."""
    kind = F.when(F.col("group_type") == 6, F.when(F.col("payback_id") % 2 == 0, 7).otherwise(8)).otherwise(F.col("group_type"))
    given = noncomp_inputs(r)
    return {**given, "paybacks": given["paybacks"].withColumn("group_type", kind)}


def misc_sql(kind):
    return noncomp_sql(kind, sent_sql(6) + f" AND payback_id%2={kind - 7}")


def paid_sql(kind, where):
    return noncomp_sql(kind, f"""SELECT payback_id, customer_id, branch_id, p.created_at AS sent_at, t.created_at AS paid_at FROM r_payback p JOIN r_transfer t ON t.transfer_id=p.transfer_id
          WHERE t.group_type IN (2,4,5) AND t.created_at >= '1995-06-01' AND t.created_at < '2001-01-01' AND {where}""")


@query("report_noncomp_misc", REPORT, misc_sql(7))
def _(r):
    return R.report_noncomp(**misc_inputs(r), kind=7, **PERIOD)


@query("report_noncomp_misc_hospital", REPORT, misc_sql(8))
def _(r):
    return R.report_noncomp(**misc_inputs(r), kind=8, **PERIOD)


@query("report_transferred_online", REPORT, paid_sql(2, "p.group_type=2"))
def _(r):
    return R.report_transferred(transfer_dates(r), **noncomp_inputs(r), kind=2, **PERIOD)


@query("report_transferred_death", REPORT, paid_sql(6, "p.group_type=6"))
def _(r):
    return R.report_transferred(transfer_dates(r), **noncomp_inputs(r), kind=6, **PERIOD)


@query("report_transferred_misc", REPORT, paid_sql(7, "p.group_type=6 AND payback_id%2=0"))
def _(r):
    return R.report_transferred(transfer_dates(r), **misc_inputs(r), kind=7, **PERIOD)


@query("report_transferred_misc_hospital", REPORT, paid_sql(8, "p.group_type=6 AND payback_id%2=1"))
def _(r):
    return R.report_transferred(transfer_dates(r), **misc_inputs(r), kind=8, **PERIOD)


COMP = "insurer_name:s branch:s hospital:s group_code:s item_count:i amount:d compensate_code:s claim_code:s province:s customer_name:s phone:s sent_at:t paid_at:t approved_by:s created_by:s"


def comp_inputs(r):
    d = (r.import_detail.filter("group_type = 5").join(hospitals(r).select("hospital_id", "hospital_name", "province"), "hospital_id", "left")
         .join(r.t("customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name")), "customer_id", "left"))
    comp = d.select("group_code", join_text(F.lit("Insurer "), F.col("insurer_id")).alias("insurer_name"), F.col("hospital_name").alias("hospital"), "province", join_text(F.lit("CC"), F.col("claim_code")).alias("compensate_code"),
                    "claim_code", "customer_name", join_text(F.lit("0"), F.col("customer_id")).alias("phone"), F.col("insurer_id").cast("long").alias("approved_by_id"), F.col("rf").alias("admit_type"))
    return dict(paybacks=heads(r), details=lines(r), compensations=comp, branches=r.branch, persons=persons(r))


def comp_sql(source):
    return f"""pers AS (SELECT c_custkey AS user_id, c_mktsegment || ' ' || c_name AS person_name FROM customer), src AS ({source})
    ;; SELECT 'Insurer ' || d.insurer_id AS insurer_name, b.branch, h.hospital_name AS hospital, l.group_code, l.item_count, l.amount, 'CC' || d.claim_code AS compensate_code, d.claim_code,
      'province ' || h.nation_id AS province, c.c_name AS customer_name, '0' || d.customer_id AS phone, src.sent_at, src.paid_at, a.person_name AS approved_by, u.person_name AS created_by
      FROM src JOIN r_payback_detail l ON l.payback_id=src.payback_id JOIN r_import_detail d ON d.group_code=l.group_code LEFT JOIN r_branch b ON b.branch_id=src.branch_id
      LEFT JOIN r_hospital h ON h.hospital_id=d.hospital_id LEFT JOIN customer c ON c.c_custkey=d.customer_id JOIN pers u ON u.user_id=src.customer_id JOIN pers a ON a.user_id=d.insurer_id"""


@query("report_comp", COMP, comp_sql(sent_sql(5)))
def _(r):
    return R.report_comp(**comp_inputs(r), **PERIOD)


@query("report_transferred_comp", COMP,
       comp_sql("""SELECT payback_id, customer_id, branch_id, p.created_at AS sent_at, t.created_at AS paid_at FROM r_payback p JOIN r_transfer t ON t.transfer_id=p.transfer_id
          WHERE t.group_type IN (2,4,5) AND p.group_type=5 AND t.created_at >= '1995-06-01' AND t.created_at < '2001-01-01'"""))
def _(r):
    return R.report_comp(**comp_inputs(r), **PERIOD, transfers=transfer_dates(r))


@query("report_finance", COMP, comp_sql(sent_sql(5)))
def _(r):
    return R.report_finance(5, comp_inputs(r), noncomp_inputs(r), **PERIOD)


@query("report_finance_general", REPORT, noncomp_sql(3, sent_sql(3)))
def _(r):
    return R.report_finance(3, comp_inputs(r), noncomp_inputs(r), **PERIOD)


DETAIL = "group_code:s claim_code:s branch:s account_name:s payment_type:i relation:s transfer_date:t amount:d online_amount:d"
DETAIL_SQL = """ben AS (SELECT * FROM (SELECT l_orderkey AS misc_id, 'acc' || (l_suppkey%3) AS account_name, l_linenumber%3 AS payment_type, l_returnflag AS relation, l_shipdate AS transfer_date,
      CAST(l_extendedprice AS DECIMAL(16,2)) AS amount, row_number() OVER (PARTITION BY l_orderkey, l_suppkey%3, l_linenumber%3, l_returnflag ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_linenumber, l_extendedprice) AS rn FROM lineitem) WHERE rn=1)
    ;; """


def beneficiaries(r):
    payments = r.t("lineitem").select(
        F.col("l_orderkey").alias("misc_id"), join_text(F.lit("acc"), F.col("l_suppkey") % 3).alias("account_name"), (F.col("l_linenumber") % 3).alias("payment_type"), F.col("l_returnflag").alias("relation"),
        F.col("l_shipdate").alias("transfer_date"), F.col("l_extendedprice").cast("decimal(16,2)").alias("amount"), F.col("l_partkey").alias("tie1"), F.col("l_suppkey").alias("tie2"), F.col("l_linenumber").alias("tie3"), F.col("l_extendedprice").alias("tie4"))
    online = r.item.filter("ls = 'F'").select("claim_code", "amount", F.lit("own").alias("account_name"))
    return payments, online


def detail_claims(r):
    return r.import_detail.select("group_code", "claim_code", "branch_id", "group_type", F.col("import_id").alias("misc_id"), F.when(F.col("branch_id") % 2 == 0, 38).otherwise(27).alias("product_type"))


@query("report_noncomp_detail", DETAIL,
       DETAIL_SQL + """SELECT d.group_code, d.claim_code, b.branch, ben.account_name, ben.payment_type, ben.relation, ben.transfer_date, ben.amount, CASE WHEN d.ls='F' THEN d.pay_total END AS online_amount
          FROM r_import_detail d LEFT JOIN r_branch b ON b.branch_id=d.branch_id LEFT JOIN ben ON ben.misc_id=d.import_id WHERE d.group_type=6""")
def _(r):
    payments, online = beneficiaries(r)
    return R.report_noncomp_detail(detail_claims(r).filter("group_type = 6"), online, payments, r.branch, 6)


@query("report_noncomp_detail_misc", DETAIL,
       DETAIL_SQL + """SELECT d.group_code, d.claim_code, b.branch, ben.account_name, ben.payment_type, ben.relation, ben.transfer_date, ben.amount, CAST(NULL AS DOUBLE) AS online_amount
          FROM r_import_detail d LEFT JOIN r_branch b ON b.branch_id=d.branch_id LEFT JOIN ben ON ben.misc_id=d.import_id WHERE d.group_type=6 AND d.branch_id%2=0""")
def _(r):
    payments, online = beneficiaries(r)
    return R.report_noncomp_detail(detail_claims(r).filter("group_type = 6"), online, payments, r.branch, 7)


@query("report_hospital_claims", "hospital_name:s group_code:s claim_code:s customer_name:s claim_pay:d sent_at:t",
       """SELECT h.hospital_name, p.group_code, c.claim_code, u.c_name AS customer_name, c.claim_pay, p.created_at AS sent_at FROM r_payback p JOIN r_payback_claim c ON c.payback_id=p.payback_id
          LEFT JOIN r_hospital h ON h.hospital_id=c.hospital_id LEFT JOIN customer u ON u.c_custkey=p.transfer_id WHERE p.group_type=4 AND p.created_at >= '1995-06-01' AND p.created_at < '2001-01-01'""")
def _(r):
    customers = r.t("customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"))
    sent = r.payback.withColumns({"sent_at": F.col("created_at"), "paid_at": F.lit(None).cast("timestamp_ntz"), "customer_id": F.col("transfer_id")})
    return R.report_hospital_claims(R.hospital_claim_rows(sent, r.payback_claim, r.hospital, customers), 4, **PERIOD)


@query("report_hospital_claims_misc", "hospital_name:s group_code:s claim_code:s customer_name:s claim_pay:d sent_at:t",
       """SELECT h.hospital_name, p.group_code, c.claim_code, u.c_name AS customer_name, c.claim_pay, p.created_at AS sent_at FROM r_payback p JOIN r_payback_claim c ON c.payback_id=p.payback_id
          LEFT JOIN r_hospital h ON h.hospital_id=c.hospital_id LEFT JOIN customer u ON u.c_custkey=p.transfer_id WHERE p.group_type=6 AND p.created_at >= '1995-06-01' AND p.created_at < '2001-01-01'""")
def _(r):
    customers = r.t("customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"))
    sent = r.payback.withColumns({"group_type": F.when(F.col("group_type") == 6, 8).otherwise(F.col("group_type")), "sent_at": F.col("created_at"),
                                  "paid_at": F.lit(None).cast("timestamp_ntz"), "customer_id": F.col("transfer_id")})
    return R.report_hospital_claims(R.hospital_claim_rows(sent, r.payback_claim, r.hospital, customers), 8, **PERIOD)


@query("report_billing", "group_code:s claim_code:s manual_npl:d npl_total:d auto_total:d pay_total:d net_total:d net_by_type:d",
       """cv AS (SELECT detail_id, sum(cover_amount) AS c FROM r_prior_result WHERE is_active AND is_manual_npl=1 GROUP BY 1), al AS (SELECT claim_code, sum(cover_amount) AS c FROM r_prior_result WHERE is_manual_npl=1 GROUP BY 1),
       au AS (SELECT claim_code, sum(cover_amount) AS c FROM r_prior_result WHERE is_active AND is_manual_npl=0 AND claim_code NOT IN (SELECT claim_code FROM r_item WHERE line_no%2=0) GROUP BY 1)
       ;; SELECT i.group_code, d.claim_code, coalesce(cv.c,0) AS manual_npl, coalesce(al.c,0) AS npl_total, coalesce(au.c,0) AS auto_total, d.pay_total, d.pay_total-coalesce(au.c,0)-coalesce(al.c,0) AS net_total,
          CASE WHEN i.group_type=6 THEN i.total_amount-coalesce(cv.c,0)-coalesce(au.c,0) ELSE d.pay_total-coalesce(au.c,0)-coalesce(cv.c,0) END AS net_by_type
          FROM r_imported i LEFT JOIN r_import_detail d ON d.import_id=i.import_id LEFT JOIN cv ON cv.detail_id=d.detail_id LEFT JOIN al ON al.claim_code=d.claim_code LEFT JOIN au ON au.claim_code=d.claim_code
          WHERE i.is_active AND i.status_id IN (2,4) AND i.billing_date >= '1995-06-01' AND i.billing_date < '2001-01-01'""")
def _(r):
    return R.report_billing(r.imported, r.import_detail, r.prior_result, r.item.filter("line_no % 2 = 0"), 2, **PERIOD)


def decided(r):
    """Results of all billed items: rejected ones by kind, the others approved."""
    j = r.bill_item.join(r.reject.select("item_code", "rejected_amount", "rejected_remark"), "item_code", "left")
    amount = F.coalesce("rejected_amount", F.lit(0))
    return j.select("item_code", amount.cast("decimal(16,2)").alias("uncover_amount"), F.col("rejected_remark").alias("remark"),
                    F.when(F.col("rejected_amount") == F.col("amount_total"), 4).otherwise(2).alias("decision_id"), F.col("happened_at").alias("decided_at"),
                    F.when(F.col("line_no") < 4, "-").alias("payment_ref"), (F.col("pay_total") - amount).cast("decimal(16,2)").alias("cover_amount"))


DECIDED_SQL = """dc AS MATERIALIZED (SELECT i.*, coalesce(rejected_amount,0) AS uncover_amount, rejected_remark AS remark, CASE WHEN rejected_amount=amount_total THEN 4 ELSE 2 END AS decision_id
    FROM r_bill_item i LEFT JOIN r_reject j ON i.item_code=j.item_code)"""
REJECTS = "item_code:s bill_code:s claim_code:s branch:s uncover_amount:d decision:s decided_at:t remark:s"


def rejects_sql(extra):
    return DECIDED_SQL + f""" ;; SELECT item_code, bill_code, claim_code, branch, uncover_amount, CASE WHEN decision_id=2 THEN '{M.PARTLY_APPROVED}' ELSE '4' END AS decision, happened_at AS decided_at, remark
       FROM dc LEFT JOIN r_branch b ON b.branch_id=dc.branch_id WHERE (decision_id=4 OR (decision_id=2 AND uncover_amount>0)) {extra}"""


def rejects(r, **choice):
    filed = [r.import_detail.filter("group_type <> 3").select("claim_code", "branch_id"), r.import_detail.filter("group_type IN (3, 4)").select("claim_code", "branch_id")]
    return R.report_rejects(decided(r), r.bill_item, filed, r.branch, **choice)


@query("report_rejects", REJECTS, rejects_sql("AND happened_at >= '1995-06-01' AND happened_at < '2001-01-01'"))
def _(r):
    return rejects(r, **PERIOD)


@query("report_rejects_partial", REJECTS, rejects_sql("AND decision_id=2 AND insurer_id=4"))
def _(r):
    return rejects(r, decision_id=3, insurer_id=4)


@query("report_confirmed", "item_code:s bill_code:s claim_code:s net_amount:d decision_id:i shown_cover:d shown_uncover:d payment:d confirmed_at:t",
       DECIDED_SQL + """ ;; SELECT item_code, bill_code, claim_code, pay_total-cover_amount AS net_amount, decision_id, CASE WHEN line_no<4 THEN pay_total-uncover_amount END AS shown_cover, CASE WHEN line_no<4 THEN uncover_amount END AS shown_uncover,
          CASE WHEN decision_id=2 THEN amount_total END AS payment, CASE WHEN decision_id=2 THEN happened_at END AS confirmed_at FROM dc WHERE created_at >= '1995-06-01' AND created_at < '2001-01-01' AND claim_type_code='1000'""")
def _(r):
    paid = decided(r).filter("decision_id = 2").select("item_code", F.col("decided_at").alias("confirmed_at")).join(r.bill_item.select("item_code", F.col("amount_total").alias("payment")), "item_code").withColumn("is_active", F.lit(True))
    return R.report_confirmed(r.bill_item, decided(r), paid, 1, **PERIOD, claim_type="1000")


@query("report_before_approval", "claim_code:s filed_at:t approved_at:t paid_amount:d",
       """ap AS (SELECT app_id, max(created_at) AS approved_at FROM r_policy WHERE policy_type_id=9602 GROUP BY app_id), pd AS (SELECT online_id, sum(amount) AS paid_amount FROM r_online_pay WHERE payment_status_id=4 GROUP BY 1)
       ;; SELECT claim_code, d.created_at AS filed_at, approved_at, paid_amount FROM r_import_detail d LEFT JOIN ap ON ap.app_id=d.customer_id LEFT JOIN pd ON pd.online_id=d.import_id
          WHERE group_type=3 AND insurer_id<>1 AND status_id=2 AND (approved_at > d.created_at OR approved_at IS NULL)""")
def _(r):
    claims = r.import_detail.filter("group_type = 3").select("claim_code", "insurer_id", F.when(F.col("status_id") == 2, 1).otherwise(0).alias("is_online"), F.col("customer_id").alias("app_id"),
                                                            F.col("created_at").alias("filed_at"), F.col("import_id").alias("online_id"))
    approvals = r.policy.filter("policy_type_id = 9602").groupBy("app_id").agg(F.max("created_at").alias("approved_at"))
    return R.report_before_approval(claims, approvals, r.online_pay, 1)


@query("document_index", "group_code:s document_id:s document_type:i source:s main_index:s",
       """docs AS (SELECT order_key AS misc_id, claim_code || '-24' AS document_id, CAST(line_no AS INT) AS document_type, 'claim' AS source, CAST(NULL AS VARCHAR) AS code FROM r_document JOIN r_item USING (claim_code, order_key) WHERE kind=24 AND line_no<>3
         UNION ALL SELECT order_key, claim_code || '-134', NULL, s, 'D' || claim_code FROM r_document JOIN r_item USING (claim_code, order_key), (VALUES ('application'),('code')) v(s) WHERE kind=134 AND 336+line_no<>340)
       ;; SELECT group_code, document_id, document_type, source, CASE source WHEN 'claim' THEN 'CM' || g.order_key WHEN 'application' THEN 'APP' || g.customer_id WHEN 'code' THEN code END AS main_index
          FROM r_group g LEFT JOIN docs ON docs.misc_id=g.order_key WHERE g.group_type=6""")
def _(r):
    groups = r.group.filter("group_type = 6").select("group_code", F.col("order_key").alias("misc_id"), join_text(F.lit("CM"), F.col("order_key")).alias("claim_no"), join_text(F.lit("APP"), F.col("customer_id")).alias("application_code"))
    docs = r.document.join(r.item.select("claim_code", "line_no"), "claim_code").select(
        F.col("order_key").alias("misc_id"), "kind", F.concat_ws("-", "claim_code", "kind").alias("document_id"), F.concat(F.lit("D"), F.col("claim_code")).alias("document_code"),
        F.col("line_no").alias("document_type"), (F.col("line_no") + 336).alias("document_subtype"))
    return R.document_index(groups, docs.filter("kind = 24"), docs.filter("kind = 134"))


@query("dim_person_org", "kind:s code:s name:s",
       """SELECT 'person' AS kind, CAST(c_custkey AS VARCHAR) AS code, c_mktsegment || c_name || ' ' || n_name AS name FROM customer JOIN nation ON n_nationkey=c_nationkey WHERE c_acctbal >= 0
          UNION ALL SELECT 'organisation', printf('%012d', s_suppkey), s_name || '/' || n_name FROM supplier JOIN nation ON n_nationkey=s_nationkey WHERE s_nationkey % 3 = 2 AND s_acctbal >= 0""")
def _(r):
    c = r.t("customer")
    users = c.select(F.col("c_custkey").alias("user_id"), F.col("c_custkey").alias("person_id"), (F.col("c_acctbal") >= 0).alias("is_active"))
    people = c.select(F.col("c_custkey").alias("person_id"), F.col("c_name").alias("first_name"), F.col("c_nationkey").alias("title_id"), F.col("c_mktsegment").alias("title"))
    names = r.t("nation").select(F.col("n_nationkey").alias("title_id"), F.col("n_name").alias("last_name"))
    persons_ = R.person_dimension(users, people, names)
    orgs = r.hospital.select(F.col("hospital_code").alias("org_code"), "hospital_name", (F.col("nation_id") % 3).alias("org_type"), (F.col("balance") >= 0).alias("is_active"), "nation_id")
    companies = r.hospital.join(r.branch, F.col("nation_id") == F.col("branch_id")).select(F.col("hospital_code").alias("org_code"), F.col("branch").alias("short_name"))
    organisations = R.organisation_dimension(orgs, companies)
    return persons_.select(F.lit("person").alias("kind"), F.col("user_id").cast("string").alias("code"), F.col("person_name").alias("name")).unionByName(
        organisations.select(F.lit("organisation").alias("kind"), F.col("org_code").alias("code"), F.concat_ws("/", "hospital_name", "short_name").alias("name")))
