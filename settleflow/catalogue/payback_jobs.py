"""Pay-back line: intake, validation, creation, transfers, settlement."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from settleflow.catalogue.base import query
from settleflow.catalogue.relational import REQUEST_SQL, code_requests
from settleflow.functions import messages as M
from settleflow.functions.scalars import join_text
from settleflow.operators.filters import split_codes
from settleflow.plans import creation, intake, transfers

AS_OF = dt.date(2002, 1, 15)
CUT = {"compensate": dt.date(1995, 6, 1), "opd": dt.date(1995, 6, 1), "ipd": dt.date(1995, 3, 1), "prepaid": dt.date(1996, 1, 1),
       "accident": dt.date(1995, 4, 1), "disability": dt.date(1999, 1, 1)}


def sources(r):
    """Claims of all sources in one frame; a column that a source lacks is NULL there."""
    d = r.import_detail.select(
        "group_code", "claim_code", F.col("claim_code").alias("origin_code"), "branch_id", "insurer_id", "created_at", "claim_type_code",
        F.when(F.col("group_type") == 4, "compensate").when(F.col("group_type") == 3, "accident").when(F.col("group_type") == 6, "misc").otherwise("health").alias("source"),
        F.col("pay_total").alias("amount"), join_text(F.lit("U"), F.col("insurer_id")).alias("created_by"), join_text(F.lit("U"), F.col("branch_id")).alias("updated_by"),
        join_text(F.lit("P"), F.col("group_type")).alias("product_name"), F.lit(1).alias("group_items"), F.col("happened_at").alias("claim_created_at"),
        F.when(F.col("status_id") == 2, 1).when(F.col("status_id") == 3, 0).alias("is_online"), "line_no", "rf", "ls")
    five, kind = F.col("branch_id") % 5, F.col("line_no")
    health_admit = F.when(five == 0, "4000").when(five == 1, "1001").otherwise("2001")
    accident_admit = F.when(kind == 1, "4001").when(kind == 2, "4005").when(kind == 3, "4009").otherwise("4003")
    of = lambda source, value: F.when(F.col("source") == source, value)
    return d.withColumns({
        "admit_type": F.coalesce(of("health", health_admit), of("accident", accident_admit)),
        "payback_status": of("health", F.when(F.col("rf") == "N", 1)),
        "style": of("accident", F.when(F.col("claim_type_code") == "1000", "4110").otherwise("4130")),
        "claim_status": of("accident", F.when(F.col("rf") == "A", "3570").otherwise("3500")),
        "status": of("misc", F.when(F.col("ls") == "O", 3).otherwise(2)),
        "product_type": of("misc", F.when(F.col("branch_id") < 5, 34).when(F.col("branch_id") < 15, 27).otherwise(11)),
        "payment_type": of("misc", F.when(F.col("line_no") < 4, 1).otherwise(2)),
        "claim_kind": of("misc", F.when(F.col("claim_type_code") == "1000", 2).otherwise(3))})


MODES = [(2, 5), (2, 2), (2, 3), (2, 4), (2, 6), (3, 2), (3, 3), (3, 4), (3, 6), (11, 7), (11, 8), (4, 7), (4, None)]


def candidates(r, modes, **choice):
    paid = r.import_detail.filter("rf = 'A' AND ls = 'F'").select("claim_code", F.when(F.col("line_no") < 5, 2).otherwise(3).alias("kind"),
                                                                  F.when(F.col("group_type") == 3, 3).otherwise(2).alias("product"))
    paid_groups = r.payback.filter("transfer_id IS NOT NULL").select("group_code")
    return intake.intake_candidates(sources(r), r.document, paid, paid_groups, modes, CUT, **choice)


CAND_SQL = """d AS (SELECT *, CASE status_id WHEN 2 THEN 1 ELSE 0 END AS online FROM r_import_detail WHERE group_code LIKE '%0'),
    paid AS (SELECT claim_code, CASE WHEN line_no<5 THEN 2 ELSE 3 END AS k, CASE WHEN group_type=3 THEN 3 ELSE 2 END AS p FROM r_import_detail WHERE rf='A' AND ls='F'),
    pg AS (SELECT group_code FROM r_payback WHERE transfer_id IS NOT NULL),
    h AS (SELECT *, branch_id%5=0 AS death, branch_id%5=1 AS prepaid FROM d WHERE group_type IN (2,5)),
    a AS (SELECT * FROM d WHERE group_type=3 AND rf<>'A'),
    m AS (SELECT *, CASE WHEN branch_id<5 THEN 34 WHEN branch_id<15 THEN 27 ELSE 11 END AS ptype FROM d WHERE group_type=6 AND ls='O' AND group_code NOT IN (SELECT group_code FROM pg)),
    pick AS (SELECT 2 AS product, 5 AS kind, claim_code FROM d WHERE group_type=4 AND created_at >= '1995-06-01'
      UNION ALL SELECT 2,2,claim_code FROM h WHERE online=1 AND NOT prepaid AND NOT death AND created_at >= '1995-06-01'
      UNION ALL SELECT 2,3,claim_code FROM h WHERE online=0 AND NOT prepaid AND claim_type_code='2000' AND created_at >= '1995-06-01'
      UNION ALL SELECT 2,4,claim_code FROM h WHERE online=0 AND claim_type_code='1000' AND ((NOT prepaid AND created_at >= '1995-06-01') OR (prepaid AND rf='N' AND created_at >= '1996-01-01'))
      UNION ALL SELECT 2,6,claim_code FROM h WHERE online=1 AND death AND created_at >= '1995-06-01'
      UNION ALL SELECT 3,2,claim_code FROM a WHERE online=1 AND created_at >= '1995-04-01' AND (line_no NOT IN (2,3) OR (line_no=2 AND happened_at > '1999-01-01'))
      UNION ALL SELECT 3,3,claim_code FROM a WHERE online=0 AND claim_type_code='2000' AND created_at >= '1995-04-01'
      UNION ALL SELECT 3,4,claim_code FROM a WHERE online=0 AND claim_type_code='1000' AND created_at >= '1995-03-01'
      UNION ALL SELECT 3,6,claim_code FROM a WHERE online=1 AND line_no=3 AND created_at >= '1995-03-01'),
    mp AS (SELECT 11 AS product, 7 AS kind, claim_code FROM m WHERE ptype=27 AND claim_type_code='2000' UNION ALL SELECT 11, 8, claim_code FROM m WHERE ptype=27 AND claim_type_code='1000'
      UNION ALL SELECT 4, 7, claim_code FROM m WHERE ptype=11 AND claim_type_code='2000' UNION ALL SELECT 4, NULL, claim_code FROM m WHERE ptype=11),
    chosen AS (SELECT * FROM pick WHERE NOT EXISTS (SELECT 1 FROM paid WHERE paid.claim_code=pick.claim_code AND paid.k=pick.kind AND paid.p=pick.product) UNION ALL SELECT * FROM mp),
    doc AS (SELECT DISTINCT claim_code FROM r_document),
    cand AS (SELECT product, kind, d.group_code, count(*) AS item_count, sum(pay_total) AS amount, max(created_at) AS created_at, max(insurer_id) AS insurer_id, max(branch_id) AS branch_id,
      CASE WHEN product IN (4,11) OR kind=4 THEN 0 WHEN count(*)=count(doc.claim_code) THEN 1 ELSE 0 END AS has_documents
      FROM chosen JOIN d USING (claim_code) LEFT JOIN doc USING (claim_code) GROUP BY product, kind, d.group_code)
    ;; """


@query("intake_candidates", "product:i kind:i group_code:s item_count:i amount:d created_at:t insurer_id:i has_documents:i", CAND_SQL + "SELECT * FROM cand")
def _(r):
    return candidates(r, MODES)


@query("intake_candidates_page", "group_code:s branch:s item_count:i amount:d total_count:i",
       CAND_SQL + """SELECT group_code, branch, item_count, amount, count(*) OVER () AS total_count FROM cand LEFT JOIN r_branch USING (branch_id)
          WHERE product=2 AND kind=2 AND has_documents=1 ORDER BY group_code LIMIT 10 OFFSET 10""")
def _(r):
    groups = candidates(r, [(2, 2)], has_documents=True)
    return intake.intake_page(groups, r.branch, 10, 10)


def wanted_codes(r):
    return split_codes(code_requests(r), "codes", "group_code")


def amounts(r, product, kind):
    claims = r.import_detail.select(
        "group_code", "claim_code", F.col("import_id").alias("online_id"), F.col("pay_total").alias("amount"), "insurer_id", F.col("customer_id").alias("app_id"),
        "group_type", F.col("import_id").alias("misc_id"), F.when(F.col("branch_id") > 5, join_text(F.lit("OWN"), F.col("branch_id"))).alias("policy_no"))
    extra = {}
    if product == 3:
        state = F.when(F.col("c_acctbal") < 0, "3090").when(F.col("c_acctbal") < 5000, "3040").otherwise("3020")
        extra = {"policies": r.policy, "customers": r.t("customer").select(F.col("c_custkey").alias("app_id"), state.alias("state"))}
    if product > 3:
        pay = r.import_detail.filter("group_type = 6").select(F.col("import_id").alias("misc_id"), (F.col("line_no") % 4 + 1).alias("payment_type"), F.col("pay_total").alias("amount"))
        extra = {"payments": pay.filter("payment_type > 1"), "open_payments": r.online_pay.filter("payment_status_id = 2").select(F.col("online_id").alias("misc_id")),
                 "online_status": r.imported.select(F.col("import_id").alias("online_id"), F.col("status_id").alias("online_state"))}
    of = {2: [2, 5], 3: [3], 4: [6], 11: [6]}[product]
    return intake.validate_amount_pay(product, kind, claims.filter(F.col("group_type").isin(*of)), wanted_codes(r), r.online_pay, r.npl, 1, **extra)


PAID_SQL = """pay AS (SELECT online_id, sum(amount) AS transfer_amount FROM r_online_pay WHERE payment_status_id=4 GROUP BY online_id),
    np AS (SELECT online_id, sum(amount) AS npl_amount FROM r_npl GROUP BY online_id)"""
AMOUNT_COLUMNS = "group_code:s amount:d npl_amount:d transfer_amount:d warning:s is_valid:i"


@query("validate_amount_pay", AMOUNT_COLUMNS,
       PAID_SQL + f""", x AS (SELECT group_code, pay_total AS amount, coalesce(npl_amount,0) AS npl_amount, coalesce(transfer_amount,0) AS transfer_amount
          FROM r_import_detail d LEFT JOIN pay ON pay.online_id=d.import_id LEFT JOIN np ON np.online_id=pay.online_id WHERE group_type IN (2,5) AND insurer_id<>1)
       ;; SELECT DISTINCT *, CASE WHEN warning='' THEN 1 ELSE 0 END AS is_valid FROM (SELECT *, CASE WHEN amount=0 THEN '{M.AMOUNT_WRONG}' WHEN transfer_amount<>amount+npl_amount THEN '{M.TRANSFER_DIFFERS}' ELSE '' END AS warning FROM x)""")
def _(r):
    return amounts(r, 2, 2)


@query("validate_amount_pay_accident", AMOUNT_COLUMNS,
       PAID_SQL + f""", cu AS (SELECT c_custkey, CASE WHEN c_acctbal<0 THEN NULL WHEN c_acctbal<5000 THEN '3040' ELSE '3020' END AS state FROM customer),
       x AS (SELECT group_code, pay_total AS amount, coalesce(npl_amount,0) AS npl_amount, coalesce(transfer_amount,0) AS transfer_amount, state,
          EXISTS (SELECT 1 FROM r_policy p WHERE p.app_id=d.customer_id AND policy_type_id<>9605) AS held
          FROM r_import_detail d LEFT JOIN cu ON cu.c_custkey=d.customer_id LEFT JOIN pay ON pay.online_id=d.import_id LEFT JOIN np ON np.online_id=pay.online_id WHERE group_type=3 AND insurer_id<>1)
       ;; SELECT DISTINCT group_code, amount, npl_amount, transfer_amount, warning, CASE WHEN warning='' THEN 1 ELSE 0 END AS is_valid FROM (SELECT *, concat_ws(' , ',
          CASE WHEN NOT held AND state IS NULL THEN '{M.NO_POLICY}' END, CASE WHEN state IS NULL THEN '{M.CHECK_POLICY_STATUS}' END, CASE WHEN amount=0 THEN '{M.AMOUNT_WRONG}' END,
          CASE WHEN transfer_amount<>amount+npl_amount THEN '{M.TRANSFER_DIFFERS}' END, CASE WHEN state='3020' THEN '{M.CHECK_POLICY_STATUS}' END) AS warning FROM x)""")
def _(r):
    return amounts(r, 3, 6)


@query("validate_amount_pay_misc", AMOUNT_COLUMNS,
       PAID_SQL + f""", kinds AS (SELECT DISTINCT import_id, line_no%4+1 AS t, pay_total FROM r_import_detail WHERE group_type=6 AND line_no%4+1>1),
       net AS (SELECT import_id, coalesce(sum(CASE WHEN t=2 THEN pay_total END),0)+coalesce(sum(CASE WHEN t=3 THEN pay_total END),0)-coalesce(sum(CASE WHEN t=4 THEN pay_total END),0) AS transfer_amount FROM kinds GROUP BY import_id),
       x AS (SELECT d.group_code, pay_total AS amount, coalesce(npl_amount,0) AS npl_amount, coalesce(net.transfer_amount,0) AS transfer_amount, net.import_id IS NOT NULL AS paid, d.branch_id, i.status_id AS online_state,
          EXISTS (SELECT 1 FROM r_online_pay o WHERE o.payment_status_id=2 AND o.online_id=d.import_id) AS running
          FROM r_import_detail d LEFT JOIN net ON net.import_id=d.import_id LEFT JOIN np ON np.online_id=d.import_id LEFT JOIN r_imported i ON i.import_id=d.import_id WHERE d.group_type=6)
       ;; SELECT DISTINCT group_code, amount, npl_amount, transfer_amount, warning, CASE WHEN warning='' THEN 1 ELSE 0 END AS is_valid FROM (SELECT *, concat_ws(' , ', CASE WHEN amount=0 THEN '{M.AMOUNT_WRONG}' END,
          CASE WHEN transfer_amount<>amount+npl_amount THEN '{M.TRANSFER_DIFFERS}' END, CASE WHEN branch_id<=5 THEN '{M.NO_POLICY}' END, CASE WHEN NOT paid OR running THEN '{M.PAYMENT_RUNNING}' END,
          CASE WHEN online_state=4 THEN '{M.ONLINE_CANCELLED}' END) AS warning FROM x)""")
def _(r):
    return amounts(r, 11, 7)


@query("validate_amount_pay_hospital", AMOUNT_COLUMNS,
       PAID_SQL + f""", x AS (SELECT group_code, pay_total AS amount, coalesce(npl_amount,0) AS npl_amount, coalesce(transfer_amount,0) AS transfer_amount
          FROM r_import_detail d LEFT JOIN pay ON pay.online_id=d.import_id LEFT JOIN np ON np.online_id=pay.online_id WHERE group_type IN (2,5) AND insurer_id<>1)
       ;; SELECT DISTINCT *, CASE WHEN amount=0 THEN '{M.AMOUNT_WRONG}' ELSE '' END AS warning, CASE WHEN amount=0 THEN 0 ELSE 1 END AS is_valid FROM x""")
def _(r):
    return amounts(r, 2, 4)


def accident_amounts_sql(*rules):
    return PAID_SQL + f""", cu AS (SELECT c_custkey, CASE WHEN c_acctbal<0 THEN NULL WHEN c_acctbal<5000 THEN '3040' ELSE '3020' END AS state FROM customer),
       x AS (SELECT group_code, pay_total AS amount, coalesce(npl_amount,0) AS npl_amount, coalesce(transfer_amount,0) AS transfer_amount, state,
          EXISTS (SELECT 1 FROM r_policy p WHERE p.app_id=d.customer_id AND policy_type_id<>9605) AS held
          FROM r_import_detail d LEFT JOIN cu ON cu.c_custkey=d.customer_id LEFT JOIN pay ON pay.online_id=d.import_id LEFT JOIN np ON np.online_id=pay.online_id WHERE group_type=3 AND insurer_id<>1)
       ;; SELECT DISTINCT group_code, amount, npl_amount, transfer_amount, warning, CASE WHEN warning='' THEN 1 ELSE 0 END AS is_valid
          FROM (SELECT *, concat_ws(' , ', {", ".join(f"CASE WHEN {test} THEN '{text}' END" for test, text in rules)}) AS warning FROM x)"""


NOT_HELD, NO_STATE, NOTHING, STARTING = ("NOT held AND state IS NULL", M.NO_POLICY), ("state IS NULL", M.CHECK_POLICY_STATUS), ("amount=0", M.AMOUNT_WRONG), ("state='3020'", M.CHECK_POLICY_STATUS)


@query("validate_amount_pay_accident_branch", AMOUNT_COLUMNS, accident_amounts_sql(NOT_HELD, NO_STATE, NOTHING, STARTING))
def _(r):
    return amounts(r, 3, 3)


@query("validate_amount_pay_accident_hospital", AMOUNT_COLUMNS, accident_amounts_sql(NO_STATE, NOTHING))
def _(r):
    return amounts(r, 3, 4)


@query("validate_amount_pay_misc_hospital", AMOUNT_COLUMNS,
       PAID_SQL + f""", kinds AS (SELECT DISTINCT import_id, line_no%4+1 AS t, pay_total FROM r_import_detail WHERE group_type=6 AND line_no%4+1>1),
       net AS (SELECT import_id, sum(CASE WHEN t=4 THEN -pay_total ELSE pay_total END) AS transfer_amount FROM kinds GROUP BY import_id),
       x AS (SELECT d.group_code, pay_total AS amount, coalesce(npl_amount,0) AS npl_amount, coalesce(net.transfer_amount,0) AS transfer_amount, d.branch_id, i.status_id AS online_state
          FROM r_import_detail d LEFT JOIN net ON net.import_id=d.import_id LEFT JOIN np ON np.online_id=d.import_id LEFT JOIN r_imported i ON i.import_id=d.import_id WHERE d.group_type=6)
       ;; SELECT DISTINCT group_code, amount, npl_amount, transfer_amount, warning, CASE WHEN warning='' THEN 1 ELSE 0 END AS is_valid FROM (SELECT *, concat_ws(' , ', CASE WHEN amount=0 THEN '{M.AMOUNT_WRONG}' END,
          CASE WHEN branch_id<=5 THEN '{M.NO_POLICY}' END, CASE WHEN online_state=4 THEN '{M.ONLINE_CANCELLED}' END) AS warning FROM x)""")
def _(r):
    return amounts(r, 4, 8)


def code_counters(r):
    used = r.payback.groupBy(F.substring("payback_code", 1, 4).alias("prefix")).agg(F.count(F.lit(1)).alias("running"))
    return used.select("prefix", F.lit("45").alias("year"), F.lit("01").alias("month"), "running")


def creation_of(r, kind, repeated=False):
    r.keep("line", "claim_line")
    claims = r.import_detail.filter("is_active AND group_type IN (2, 3)").select(
        "group_code", "claim_code", F.col("group_type").alias("product"), "branch_id", "insurer_id", "created_at", F.col("pay_total").alias("amount"), "hospital_id",
        F.when(F.col("status_id") == 2, 1).otherwise(0).alias("is_online"), join_text(F.lit("CO"), F.col("import_id")).alias("online_code"))
    existing = r.payback.filter("transfer_id IS NOT NULL" if repeated else "transfer_id < 0").select("group_code")
    online = r.import_detail.filter("rf <> 'A'").select("claim_code")
    return creation.create_payback(wanted_codes(r), claims, existing, kind, 1, "1997-01-01", AS_OF, code_counters(r), online)


def special_claims(r, group_type):
    return r.import_detail.filter(F.col("is_active") & (F.col("group_type") == group_type)).select(
        "group_code", "claim_code", F.col("detail_id").alias("misc_id"), F.when(F.col("insurer_id") == 4, 4).otherwise(11).alias("product"), "branch_id", "insurer_id", "created_at",
        "customer_id", F.col("pay_total").alias("amount"), "hospital_id", join_text(F.lit("CO"), F.col("import_id")).alias("online_code"))


def special_creation(r, kind):
    """Compensations (kind 5) or miscellaneous claims (7, 8): claims of flag A have no known payment type, those of flag R two."""
    r.keep("line", "claim_line")
    existing = r.payback.filter("transfer_id < 0").select("group_code")
    rows = special_claims(r, 4 if kind == 5 else 6)
    if kind == 5:
        rows = creation.compensate_claims(rows)
    else:
        kinds = F.when(F.col("rf") == "R", F.array(F.lit(1), F.lit(2))).when(F.col("rf") == "N", F.array((F.col("line_no") % 3 + 1).cast("int")))
        rows = creation.misc_claims(rows, r.item.select(F.col("detail_id").alias("misc_id"), F.explode(kinds).alias("payment_type")))
    codes = r.import_detail.select("group_code").distinct()
    online = r.import_detail.filter("rf <> 'A'").select("claim_code")
    return creation.create_payback(codes, rows, existing, kind, 1, "1997-01-01", AS_OF, code_counters(r), online, product=2 if kind == 5 else 11)


def special_sql(kind):
    kinds = """(SELECT detail_id, 1 AS payment_type FROM r_item WHERE rf='R' UNION ALL SELECT detail_id, 2 FROM r_item WHERE rf='R' UNION ALL SELECT detail_id, line_no%3+1 FROM r_item WHERE rf='N')"""
    rows = f"""SELECT d.*, CASE WHEN insurer_id=4 THEN 4 ELSE 11 END AS product, coalesce(k.payment_type, 3) AS payment_type FROM r_import_detail d LEFT JOIN {kinds} k ON k.detail_id=d.detail_id
        WHERE is_active AND group_type=6"""
    if kind == 5:
        rows = "SELECT * EXCLUDE (branch_id), 70 AS branch_id, 2 AS product, 3 AS payment_type FROM r_import_detail WHERE is_active AND group_type=4"
    place = "" if kind == 5 else " AND t.hospital_id=k.hospital_id"
    return f"""w AS MATERIALIZED ({rows}),
       pb AS (SELECT branch_id, sum(pay_total) AS amount, 'CPBG4501' || printf('%06d', (SELECT count(*) FROM r_payback) + row_number() OVER (ORDER BY branch_id)) AS payback_code FROM w GROUP BY branch_id),
       t AS (SELECT group_code{'' if kind == 5 else ', hospital_id'}, count(*) AS item_count, sum(pay_total) AS amount, max('CO' || import_id) AS online_code FROM w GROUP BY ALL),
       k AS (SELECT DISTINCT group_code, branch_id, product, insurer_id, payment_type, hospital_id FROM w),
       dt AS MATERIALIZED (SELECT k.*, t.item_count, t.amount, t.online_code, 'CPBH4501' || printf('%06d', row_number() OVER (ORDER BY k.group_code, branch_id, product, insurer_id, payment_type, k.hospital_id)) AS detail_code
          FROM k JOIN t ON t.group_code=k.group_code{place})
       ;; """


def creation_sql(kind):
    acc = f"CASE WHEN status_id=2 THEN {6 if kind == 6 else 2} ELSE {kind if kind in (3, 4) else 'NULL'} END"
    hosp = "" if kind == 2 else ", hospital_id"
    return f"""w AS (SELECT *, CASE WHEN group_type=3 THEN {acc} ELSE {kind} END AS gt, CASE WHEN insurer_id=1 AND created_at >= '1997-01-01' THEN 2 ELSE 1 END AS pay_group
          FROM r_import_detail WHERE is_active AND group_type IN (2,3)),
       pb AS (SELECT gt, branch_id, pay_group, sum(pay_total) AS amount, 'CPBG4501' || printf('%06d', (SELECT count(*) FROM r_payback) + row_number() OVER (ORDER BY gt NULLS FIRST, branch_id, pay_group)) AS payback_code
          FROM w GROUP BY gt, branch_id, pay_group),
       dt AS (SELECT group_code, gt, branch_id, pay_group, group_type AS product, insurer_id{hosp}, count(*) AS item_count, sum(pay_total) AS amount, max('CO' || import_id) AS online_code,
          'CPBH4501' || printf('%06d', row_number() OVER (ORDER BY group_code, gt NULLS FIRST, branch_id, pay_group, group_type, insurer_id{hosp})) AS detail_code FROM w GROUP BY group_code, gt, branch_id, pay_group, group_type, insurer_id{hosp})
       ;; """


@query("create_payback", "payback_code:s group_type:i branch_id:i pay_group:i amount:d status_id:i",
       creation_sql(4) + "SELECT payback_code, gt AS group_type, branch_id, pay_group, amount, CASE WHEN pay_group=2 THEN 5 ELSE 2 END AS status_id FROM pb")
def _(r):
    return creation_of(r, 4)["paybacks"]


@query("create_payback_details", "detail_code:s payback_code:s group_code:s hospital_id:i item_count:i amount:d online_code:s",
       creation_sql(4) + "SELECT dt.*, payback_code FROM dt JOIN pb ON dt.gt IS NOT DISTINCT FROM pb.gt AND dt.branch_id=pb.branch_id AND dt.pay_group=pb.pay_group")
def _(r):
    return creation_of(r, 4)["details"]


@query("create_payback_claims", "detail_code:s claim_code:s claim_pay:d",
       creation_sql(2) + "SELECT detail_code, claim_code, pay_total AS claim_pay FROM w JOIN dt ON w.group_code=dt.group_code WHERE rf<>'A'")
def _(r):
    return creation_of(r, 2)["claims"]


@query("create_payback_check", "is_result:i message:s repeated:i",
       f"SELECT CASE WHEN n=0 THEN 1 ELSE 0 END AS is_result, CASE WHEN n>0 THEN '{creation.DUPLICATE}' END AS message, n AS repeated FROM (SELECT count(*) AS n FROM r_payback WHERE transfer_id IS NOT NULL)")
def _(r):
    return creation_of(r, 4, repeated=True)["check"]


SPECIAL_DETAILS = "detail_code:s payback_code:s group_code:s branch_id:i product:i insurer_id:i payment_type:i hospital_id:i item_count:i amount:d online_code:s"
SPECIAL_DETAILS_SQL = "SELECT dt.*, payback_code FROM dt JOIN pb ON dt.branch_id=pb.branch_id"
LINKS_SQL = """SELECT detail_code, claim_code, pay_total AS claim_pay FROM w JOIN dt ON dt.group_code=w.group_code AND dt.payment_type=w.payment_type AND dt.hospital_id=w.hospital_id AND dt.insurer_id=w.insurer_id
    AND dt.branch_id=w.branch_id AND dt.product=w.product"""


@query("create_payback_compensate", "payback_code:s group_type:i branch_id:i pay_group:i amount:d status_id:i",
       special_sql(5) + "SELECT payback_code, 5 AS group_type, branch_id, 1 AS pay_group, amount, 2 AS status_id FROM pb")
def _(r):
    return special_creation(r, 5)["paybacks"]


@query("create_payback_compensate_details", SPECIAL_DETAILS, special_sql(5) + SPECIAL_DETAILS_SQL)
def _(r):
    return special_creation(r, 5)["details"]


@query("create_payback_misc", "payback_code:s group_type:i branch_id:i pay_group:i amount:d status_id:i",
       special_sql(8) + "SELECT payback_code, 8 AS group_type, branch_id, 1 AS pay_group, amount, 2 AS status_id FROM pb")
def _(r):
    return special_creation(r, 8)["paybacks"]


@query("create_payback_misc_details", SPECIAL_DETAILS, special_sql(7) + SPECIAL_DETAILS_SQL)
def _(r):
    return special_creation(r, 7)["details"]


@query("create_payback_misc_claims", "detail_code:s claim_code:s claim_pay:d", special_sql(8) + LINKS_SQL)
def _(r):
    return special_creation(r, 8)["claims"]


@query("create_payback_misc_online_claims", "detail_code:s claim_code:s claim_pay:d", special_sql(7) + LINKS_SQL + " WHERE rf<>'A'")
def _(r):
    return special_creation(r, 7)["claims"]


@query("create_payback_hospital_report", "group_code:s hospital_name:s claim_code:s customer_name:s amount:d sent_at:t paid_at:t group_type:i",
       special_sql(8) + """SELECT d.group_code, hospital_name, d.claim_code, c_name AS customer_name, pay_total AS amount, TIMESTAMP '2002-01-15 10:00:00' AS sent_at, CAST(NULL AS TIMESTAMP) AS paid_at, 8 AS group_type
          FROM r_import_detail d JOIN r_hospital h ON h.hospital_id=d.hospital_id JOIN customer c ON c.c_custkey=d.customer_id WHERE d.is_active AND d.group_type=6 AND d.group_code IN (SELECT group_code FROM dt)""")
def _(r):
    made = special_creation(r, 8)
    customers = r.t("customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"))
    return creation.hospital_report(made["mapping"], special_claims(r, 6), r.hospital, customers, 8, "2002-01-15 10:00:00")


@query("withdrawal_rounds", "claim_code:s amount:d round_no:i created_at:t is_active:i",
       """h AS (SELECT detail_id, claim_code, amount, line_no%5+1 AS round_no, happened_at AS created_at FROM r_item WHERE ls='F'),
       lastr AS (SELECT round_no FROM h ORDER BY created_at DESC, round_no DESC LIMIT 1),
       n AS (SELECT claim_code, pay_total AS amount, row_number() OVER (ORDER BY claim_code) AS n FROM r_import_detail WHERE group_type=2 AND rf<>'A')
       ;; SELECT claim_code, amount, round_no, created_at, CASE WHEN claim_code IN (SELECT claim_code FROM r_import_detail WHERE group_type=2) THEN 0 ELSE 1 END AS is_active FROM h
          UNION ALL SELECT claim_code, amount, ((SELECT round_no FROM lastr)+n-1)%5+1, TIMESTAMP '2002-01-15 10:00:00', 1 FROM n""")
def _(r):
    history = r.item.filter("ls = 'F'").select("claim_code", "amount", (F.col("line_no") % 5 + 1).alias("round_no"), F.col("happened_at").alias("created_at"), F.lit(True).alias("is_active"))
    claims = r.import_detail.filter("group_type = 2").select("claim_code", F.col("pay_total").alias("amount"))
    return creation.withdrawal_rounds(history, claims, r.item.filter("rf <> 'A'").select("claim_code"), "2002-01-15 10:00:00")


def rounds_of(r, group_type):
    """Withdrawal rounds of new pay-backs of deaths (accident claims) and of miscellaneous claims."""
    history = r.item.filter("ls = 'F'").select("claim_code", "amount", (F.col("line_no") % 5 + 1).alias("round_no"), F.col("happened_at").alias("created_at"), F.lit(True).alias("is_active"))
    claims = r.import_detail.filter(F.col("group_type") == group_type).select("claim_code", F.col("pay_total").alias("amount"))
    return creation.withdrawal_rounds(history, claims, r.item.filter("rf <> 'A'").select("claim_code"), "2002-01-15 10:00:00")


def rounds_sql(group_type):
    return f"""h AS (SELECT claim_code, amount, line_no%5+1 AS round_no, happened_at AS created_at FROM r_item WHERE ls='F'),
       lastr AS (SELECT round_no FROM h ORDER BY created_at DESC, round_no DESC LIMIT 1),
       n AS (SELECT claim_code, pay_total AS amount, row_number() OVER (ORDER BY claim_code) AS n FROM r_import_detail WHERE group_type={group_type} AND rf<>'A')
       ;; SELECT h.claim_code, amount, round_no, created_at, CASE WHEN d.claim_code IS NULL THEN 1 ELSE 0 END AS is_active FROM h LEFT JOIN (SELECT claim_code FROM r_import_detail WHERE group_type={group_type}) d ON d.claim_code=h.claim_code
          UNION ALL SELECT claim_code, amount, ((SELECT round_no FROM lastr)+n-1)%5+1, TIMESTAMP '2002-01-15 10:00:00', 1 FROM n"""


@query("withdrawal_rounds_death", "claim_code:s amount:d round_no:i created_at:t is_active:i", rounds_sql(3))
def _(r):
    return rounds_of(r, 3)


@query("withdrawal_rounds_misc", "claim_code:s amount:d round_no:i created_at:t is_active:i", rounds_sql(6))
def _(r):
    return rounds_of(r, 6)


def used_codes(r, letters):
    """Counters of the transfer codes in use, by their leading letters (four: CPBT; two: a prefix no job asks for)."""
    used = r.transfer.groupBy(F.substring("transfer_code", 1, letters).alias("prefix")).agg(F.count(F.lit(1)).alias("running"))
    return used.select("prefix", F.lit("45").alias("year"), F.lit("01").alias("month"), "running")


def bundling(r):
    """One request per customer over the waiting pay-backs; insurer 5 sends bundled ones along, insurer 7 a blank."""
    base = r.imported.filter("is_active").select(F.col("customer_id").alias("request_id"), "insurer_id", "status_id", F.col("import_id").cast("string").alias("payback_ref"))
    rows = base.filter("status_id = 2 OR (insurer_id = 5 AND status_id = 3)")
    blanks = base.filter("insurer_id = 7 AND status_id = 2").withColumn("payback_ref", F.lit(" "))
    kind = (F.col("request_id") % 5 + 2).cast("int").alias("group_type")
    counters = used_codes(r, 4)
    return transfers.create_transfers(rows.unionByName(blanks).select("request_id", kind, "payback_ref"), r.payback, AS_OF, counters)


BUNDLE_SQL = f"""rq AS (SELECT customer_id AS request_id, import_id, insurer_id, status_id FROM r_imported WHERE is_active AND (status_id=2 OR (insurer_id=5 AND status_id=3))),
    st AS (SELECT request_id, CAST(request_id%5+2 AS INT) AS group_type, sum(p.amount) AS amount, max(CASE WHEN rq.insurer_id=7 AND rq.status_id=2 THEN 1 ELSE 0 END) AS blank,
       max(CASE WHEN p.transfer_id IS NOT NULL THEN 1 ELSE 0 END) AS bundled FROM rq LEFT JOIN r_payback p ON p.payback_id=rq.import_id GROUP BY request_id),
    jd AS (SELECT *, CASE WHEN blank=1 THEN '{M.UNKNOWN_ENTRY}' WHEN bundled=1 THEN '{M.PARTLY_TRANSFERRED}' END AS message FROM st),
    tr AS (SELECT *, 'CPBT4501' || printf('%08d', (SELECT count(*) FROM r_transfer) + row_number() OVER (ORDER BY request_id)) AS transfer_code FROM jd WHERE message IS NULL)
    ;; """


@query("create_transfer", "request_id:i transfer_code:s group_type:i amount:d transfer_amount:d status_id:i",
       BUNDLE_SQL + "SELECT *, 0 AS transfer_amount, CASE WHEN group_type=4 THEN 5 ELSE 2 END AS status_id FROM tr")
def _(r):
    return bundling(r)["transfers"]


@query("create_transfer_check", "request_id:i message:s", BUNDLE_SQL + "SELECT request_id, message FROM jd")
def _(r):
    return bundling(r)["check"]


@query("create_transfer_state", "payback_id:i status_id:i transfer_code:s",
       BUNDLE_SQL + """SELECT p.payback_id, CASE WHEN t.transfer_code IS NULL THEN p.status_id ELSE 3 END AS status_id, t.transfer_code FROM r_payback p
          LEFT JOIN (SELECT import_id, transfer_code FROM rq JOIN tr ON rq.request_id=tr.request_id) t ON t.import_id=p.payback_id""")
def _(r):
    return bundling(r)["paybacks"]


def shared_bundling(r):
    """Late requests list the waiting pay-backs of every fourth customer again, and the first of them twice."""
    base = r.imported.filter("is_active AND status_id = 2").select("customer_id", "insurer_id", F.col("import_id").cast("string").alias("payback_ref"))
    first = base.select(F.col("customer_id").alias("request_id"), "insurer_id", "payback_ref")
    again = base.filter("customer_id % 4 = 0").select((F.col("customer_id") + 2000000).alias("request_id"), "insurer_id", "payback_ref")
    blanks = first.filter("insurer_id = 7").withColumn("payback_ref", F.lit(" "))
    kind = F.lit(3).alias("group_type")
    rows = first.unionByName(again).unionByName(again).unionByName(blanks).select("request_id", kind, "payback_ref")
    return transfers.create_transfers(rows, r.payback, AS_OF, used_codes(r, 4))


@query("create_transfer_shared", "request_id:i amount:d message:s",
       f"""base AS (SELECT customer_id, insurer_id, total_amount FROM r_imported WHERE is_active AND status_id=2),
       rq AS (SELECT customer_id AS request_id, max(CASE WHEN insurer_id=7 THEN 1 ELSE 0 END) AS blank, sum(total_amount) AS amount FROM base GROUP BY customer_id),
       lt AS (SELECT request_id+2000000 AS request_id, amount, CASE WHEN blank=1 THEN NULL ELSE '{M.PARTLY_TRANSFERRED}' END AS message FROM rq WHERE request_id%4=0)
       ;; SELECT request_id, CASE WHEN blank=0 THEN amount END AS amount, CASE WHEN blank=1 THEN '{M.UNKNOWN_ENTRY}' END AS message FROM rq
          UNION ALL SELECT request_id, CASE WHEN message IS NULL THEN amount END, message FROM lt""")
def _(r):
    out = shared_bundling(r)
    return out["check"].join(out["transfers"].select("request_id", "amount"), "request_id", "left")


HOSPITAL_SQL = """t AS (SELECT transfer_id, group_type FROM r_transfer),
    g AS (SELECT d.transfer_id, d.hospital_id, count(*) AS item_count, sum(d.amount) AS amount FROM r_payback_detail d JOIN t ON t.transfer_id=d.transfer_id WHERE t.group_type IN (4,8) GROUP BY 1,2),
    s AS (SELECT *, 'HCG4501' || printf('%06d', row_number() OVER (ORDER BY transfer_id, hospital_id)) AS subgroup_code FROM g)
    ;; """


@query("subgroup_by_hospital", "transfer_id:i hospital_id:i hospital_name:s subgroup_code:s item_count:i amount:d",
       HOSPITAL_SQL + "SELECT s.*, hospital_name FROM s LEFT JOIN r_hospital h ON h.hospital_id=s.hospital_id")
def _(r):
    return transfers.subgroups_by_hospital(r.transfer, r.payback_detail, r.hospital, AS_OF, used_codes(r, 2))["subgroups"]


@query("subgroup_by_hospital_details", "detail_code:s subgroup_code:s",
       HOSPITAL_SQL + "SELECT detail_code, subgroup_code FROM r_payback_detail d LEFT JOIN s ON s.transfer_id=d.transfer_id AND s.hospital_id=d.hospital_id")
def _(r):
    return transfers.subgroups_by_hospital(r.transfer, r.payback_detail, r.hospital, AS_OF, used_codes(r, 2))["details"]


LIMIT = 1500000


def ceiling(r):
    """Each region pays one list of its out-of-pocket transfers."""
    lists = r.transfer.filter("oop_status = 7").select((F.col("transfer_id") % 4).cast("long").alias("list_id"), "transfer_id")
    return transfers.subgroups_by_ceiling(lists, r.payback_detail.filter("transfer_id IS NOT NULL"), LIMIT, AS_OF, used_codes(r, 2))


CEILING_SQL = f"""pp AS (SELECT t.transfer_id%4 AS list_id, d.transfer_id, d.payback_id, sum(d.amount) AS amount FROM r_payback_detail d JOIN r_transfer t ON t.transfer_id=d.transfer_id WHERE t.oop_status=7 GROUP BY 1,2,3),
    s AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY list_id ORDER BY transfer_id, payback_id) AS n FROM pp WHERE list_id NOT IN (SELECT list_id FROM pp WHERE amount > {LIMIT})),
    walk AS (SELECT list_id, transfer_id, payback_id, amount, n, CAST(1 AS BIGINT) AS group_no, CAST(amount AS DECIMAL(18,2)) AS total FROM s WHERE n=1
      UNION ALL SELECT s.list_id, s.transfer_id, s.payback_id, s.amount, s.n, CASE WHEN w.total+s.amount > {LIMIT} THEN w.group_no+1 ELSE w.group_no END,
      CAST(CASE WHEN w.total+s.amount > {LIMIT} THEN s.amount ELSE w.total+s.amount END AS DECIMAL(18,2)) FROM walk w JOIN s ON s.list_id=w.list_id AND s.n=w.n+1),
    k AS (SELECT *, CASE WHEN max(group_no) OVER (PARTITION BY list_id) > 1 THEN transfer_id END AS owner_id FROM walk),
    sg AS (SELECT list_id, group_no, owner_id, sum(amount) AS amount, CASE WHEN owner_id IS NULL THEN count(DISTINCT transfer_id) ELSE count(*) END AS item_count,
      'CPB4501' || printf('%06d', row_number() OVER (ORDER BY list_id, owner_id NULLS FIRST, group_no)) AS subgroup_code FROM k GROUP BY list_id, group_no, owner_id)
    ;; """


@query("subgroup_by_ceiling", "list_id:i group_no:i transfer_id:i subgroup_code:s amount:d item_count:i", CEILING_SQL + "SELECT *, owner_id AS transfer_id FROM sg")
def _(r):
    return ceiling(r)["subgroups"]


@query("subgroup_by_ceiling_details", "payback_id:i transfer_id:i amount:d subgroup_code:s",
       CEILING_SQL + "SELECT k.payback_id, k.transfer_id, k.amount, subgroup_code FROM k JOIN sg ON sg.list_id=k.list_id AND sg.group_no=k.group_no AND sg.owner_id IS NOT DISTINCT FROM k.owner_id")
def _(r):
    return ceiling(r)["details"]


def settling(r):
    """Every transfer is settled with the sum of its pay-backs; some at midnight, some with another amount."""
    groups = r.subgroup_detail.groupBy("transfer_id").agg(F.max("subgroup_id").alias("subgroup_id"))
    at = F.when(F.col("payback_count") == 3, F.lit("2002-01-15 00:00:00")).otherwise(F.lit("2002-01-15 09:30:00")).cast("timestamp_ntz")
    s = r.transfer.join(groups, "transfer_id").select(
        "transfer_id", F.when(F.col("payback_count") == 2, F.col("amount") + 1).otherwise(F.col("amount")).cast("decimal(16,2)").alias("paid_amount"), at.alias("paid_at"), "subgroup_id")
    return transfers.settle_transfers(s, r.transfer.withColumn("status_id", F.when(F.col("transfer_id") % 7 == 0, 3).otherwise(2)), r.payback, r.payback_claim, r.subgroup, r.subgroup_detail)


SETTLE_SQL = f"""tr AS (SELECT transfer_id, amount, payback_count, group_type, oop_status, transfer_amount, CASE WHEN transfer_id%7=0 THEN 3 ELSE 2 END AS status_id FROM r_transfer),
    st AS (SELECT tr.transfer_id, CASE WHEN payback_count=2 THEN amount+1 ELSE amount END AS paid_amount, CASE WHEN payback_count=3 THEN TIMESTAMP '2002-01-15 00:00:00' ELSE TIMESTAMP '2002-01-15 09:30:00' END AS paid_at,
      g.subgroup_id, group_type, status_id FROM tr JOIN (SELECT transfer_id, max(subgroup_id) AS subgroup_id FROM r_subgroup_detail GROUP BY transfer_id) g ON g.transfer_id=tr.transfer_id),
    sm AS (SELECT p.transfer_id, sum(p.amount) AS ps, sum(c.cp) AS cs FROM r_payback p LEFT JOIN (SELECT payback_id, sum(claim_pay) AS cp FROM r_payback_claim GROUP BY payback_id) c ON c.payback_id=p.payback_id
      WHERE p.transfer_id IS NOT NULL GROUP BY p.transfer_id),
    jd AS (SELECT st.*, CASE WHEN status_id=3 THEN '{M.ALREADY_TRANSFERRED}' WHEN paid_amount<>ps OR paid_amount<>cs THEN '{M.TRANSFER_AMOUNT_WRONG}' WHEN strftime(paid_at,'%H:%M:%S')='00:00:00' THEN '{M.TRANSFER_TIME_MISSING}' END AS message
      FROM st LEFT JOIN sm ON sm.transfer_id=st.transfer_id),
    dn AS (SELECT * FROM jd WHERE message IS NULL),
    sg AS (SELECT subgroup_id, CASE WHEN subgroup_id IN (SELECT subgroup_id FROM dn) THEN 1 ELSE is_paid END AS is_paid, (SELECT max(paid_at) FROM dn WHERE dn.subgroup_id=s.subgroup_id) AS paid_at FROM r_subgroup s),
    al AS (SELECT transfer_id, min(is_paid) AS all_paid FROM (SELECT DISTINCT subgroup_id, transfer_id FROM r_subgroup_detail) d JOIN sg ON sg.subgroup_id=d.subgroup_id GROUP BY transfer_id)
    ;; """


@query("settle_transfer", "transfer_id:i transfer_amount:d transfer_at:t status_id:i oop_status:i oop_amount:d",
       SETTLE_SQL + """SELECT tr.transfer_id, CASE WHEN dn.transfer_id IS NULL THEN tr.transfer_amount WHEN tr.group_type<>4 THEN dn.paid_amount END AS transfer_amount,
          CASE WHEN tr.group_type<>4 THEN dn.paid_at END AS transfer_at, CASE WHEN dn.transfer_id IS NULL THEN tr.status_id WHEN tr.group_type=4 THEN 2 WHEN all_paid=1 THEN 3 ELSE 4 END AS status_id,
          CASE WHEN dn.transfer_id IS NULL THEN tr.oop_status WHEN all_paid=1 THEN 3 ELSE 6 END AS oop_status, dn.paid_amount AS oop_amount
          FROM tr LEFT JOIN dn ON dn.transfer_id=tr.transfer_id LEFT JOIN al ON al.transfer_id=tr.transfer_id""")
def _(r):
    return settling(r)["transfers"]


@query("settle_transfer_check", "transfer_id:i message:s", SETTLE_SQL + "SELECT transfer_id, message FROM jd")
def _(r):
    return settling(r)["check"]


@query("settle_transfer_subgroups", "subgroup_id:i is_paid:i paid_at:t", SETTLE_SQL + "SELECT * FROM sg")
def _(r):
    return settling(r)["subgroups"]


@query("settle_transfer_paybacks", "payback_id:i status_id:i",
       SETTLE_SQL + """SELECT payback_id, CASE WHEN group_type<>4 AND payback_id IN (SELECT d.payback_id FROM r_subgroup_detail d JOIN dn ON dn.transfer_id=d.transfer_id AND dn.subgroup_id=d.subgroup_id) THEN 4 ELSE status_id END AS status_id FROM r_payback""")
def _(r):
    return settling(r)["paybacks"]


@query("settle_transfer_claims", "claim_code:s claim_transfer:d",
       SETTLE_SQL + """SELECT claim_code, CASE WHEN payback_id IN (SELECT payback_id FROM r_payback WHERE transfer_id IN (SELECT transfer_id FROM dn)) THEN claim_pay END AS claim_transfer FROM r_payback_claim""")
def _(r):
    return settling(r)["claims"]
