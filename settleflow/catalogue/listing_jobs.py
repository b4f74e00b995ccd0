"""Lists D18 to D29: pages and whole lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from settleflow.catalogue.base import query
from settleflow.functions.scalars import join_text, zero_pad
from settleflow.operators.paging import page
from settleflow.operators.joins import values_table
from settleflow.plans import listings as L

# where the deep links of the examples lead
LINKS = {"health": "/health?clm=", "accident": "/accident?clm=", "misc": "/misc?id="}
B64 = "base64(CAST(claim_code AS BLOB))"


def subgroups(r):
    return r.subgroup.withColumn("is_uploaded", F.col("is_paid"))


TRANSFER_SQL = """c AS (SELECT transfer_id, count(*) AS n, sum(is_mailed) AS m, sum(is_paid) AS u FROM (SELECT DISTINCT transfer_id, subgroup_id FROM r_subgroup_detail) d
        JOIN r_subgroup s ON s.subgroup_id=d.subgroup_id GROUP BY transfer_id),
    x AS (SELECT t.transfer_id, transfer_code, amount, status_id, CASE WHEN n IS NULL THEN NULL WHEN m>0 AND m<n THEN 2 WHEN m=n THEN 3 ELSE 1 END AS mail_status,
        CASE WHEN n IS NULL THEN NULL WHEN u>0 AND u<n THEN 2 WHEN u=n THEN 3 ELSE 1 END AS upload_status FROM r_transfer t LEFT JOIN c ON c.transfer_id=t.transfer_id
        WHERE group_type=4 AND created_at >= '1995-01-01' AND created_at < '2001-01-01')
    ;; """


def transfer_rows(r):
    return L.list_transfers(r.transfer.withColumn("transfer_at", F.col("created_at")), r.subgroup_detail, subgroups(r), "1995-01-01", "2000-12-31")


@query("list_transfers", "transfer_code:s amount:d status_id:i mail_status:i upload_status:i", TRANSFER_SQL + "SELECT * FROM x")
def _(r):
    return transfer_rows(r)


@query("list_transfers_page", "transfer_code:s amount:d mail_status:i total_count:i",
       TRANSFER_SQL + "SELECT *, count(*) OVER () AS total_count FROM x ORDER BY amount DESC, transfer_id LIMIT 10 OFFSET 5")
def _(r):
    return L.transfer_page(transfer_rows(r), "Amount", "DESC", 5)


@query("list_transfers_by_status", "transfer_code:s status:s total_count:i",
       TRANSFER_SQL + """SELECT transfer_code, s.status, count(*) OVER () AS total_count FROM x LEFT JOIN (VALUES (2, 'waiting'), (3, 'paid')) s(status_id, status) ON s.status_id=x.status_id
          ORDER BY s.status, transfer_id LIMIT 25 OFFSET 3""")
def _(r):
    statuses = values_table(r.spark, ["status_id", "status"], [(2, "waiting"), (3, "paid")])
    return L.transfer_page(transfer_rows(r), "ClaimPayBackTransferStatus", "ASC", 3, 25, statuses=statuses)


@query("list_transfer_monitor", "transfer_code:s amount:d status_id:i total_count:i",
       """SELECT transfer_code, amount, status_id, count(*) OVER () AS total_count FROM r_transfer WHERE oop_status=3 AND group_type=4 ORDER BY transfer_id LIMIT 10""")
def _(r):
    return L.transfer_page(L.list_transfer_monitor(r.transfer, group_type=4))


@query("list_out_of_pocket", "transfer_code:s amount:d oop_status:i over_limit:i is_grouped:i",
       """p AS (SELECT transfer_id, max(CASE WHEN payback_id%2=0 THEN 1 ELSE 0 END) AS k FROM r_subgroup_detail WHERE status_id=3 GROUP BY transfer_id)
       ;; SELECT transfer_code, amount, oop_status, CASE WHEN amount > 1000000 THEN 1 ELSE 0 END AS over_limit, CASE WHEN p.transfer_id IS NULL THEN 0 ELSE 1 END AS is_grouped
       FROM r_transfer t LEFT JOIN p ON p.transfer_id=t.transfer_id WHERE group_type<>4 OR k=1""")
def _(r):
    pairs = r.subgroup_detail.filter("status_id = 3").select("transfer_id", F.when(F.col("payback_id") % 2 == 0, 1).otherwise(2).alias("transaction_type"))
    return L.list_out_of_pocket(r.transfer, pairs, 1000000)


PAYBACK_COLUMNS = "payback_code:s amount:d branch:s transfer_created_at:t"


@query("list_paybacks", PAYBACK_COLUMNS + " subgroup_id:i",
       """SELECT p.payback_code, p.amount, b.branch, t.created_at AS transfer_created_at, s.subgroup_id FROM r_payback p JOIN r_transfer t ON t.transfer_id=p.transfer_id
          LEFT JOIN r_branch b ON b.branch_id=p.branch_id LEFT JOIN r_subgroup_detail s ON s.payback_id=p.payback_id WHERE t.group_type=4""")
def _(r):
    return L.list_paybacks(r.payback, r.transfer, r.branch, r.subgroup_detail, r.transfer.filter("group_type = 4"))


@query("list_paybacks_waiting", PAYBACK_COLUMNS + " total_count:i",
       """SELECT payback_code, amount, branch, CAST(NULL AS TIMESTAMP) AS transfer_created_at, count(*) OVER () AS total_count FROM r_payback p LEFT JOIN r_branch b ON b.branch_id=p.branch_id
          WHERE status_id=2 AND group_type IN (4,8) AND created_at >= '1996-01-01' AND created_at < '2000-01-01' ORDER BY payback_id LIMIT 20""")
def _(r):
    rows = L.list_paybacks(r.payback, r.transfer, r.branch, start="1996-01-01", end="1999-12-31", group_type=4, waiting_only=True)
    return page(rows, [F.col("payback_id").asc()], 0, 20)


@query("list_payback_claims", "detail_code:s claim_code:s claim_pay:d link:s",
       f"""SELECT d.detail_code, c.claim_code, c.claim_pay, CASE group_type WHEN 2 THEN '/health?clm=' || {B64.replace('claim_code', 'c.claim_code')} WHEN 3 THEN '/accident?clm=' || {B64.replace('claim_code', 'c.claim_code')}
          ELSE '/misc?id=' || c.claim_code END AS link FROM r_payback_claim c JOIN r_payback_detail d ON d.payback_id=c.payback_id AND d.hospital_id=c.hospital_id""")
def _(r):
    return L.list_payback_claims(r.payback_claim, r.payback_detail, LINKS)


@query("list_group_items", "group_code:s claim_code:s product_name:s hospital_name:s admit_type:s link:s",
       f"""SELECT group_code, claim_code, p.p_name AS product_name, h.hospital_name, CASE WHEN group_type=6 THEN 'l' || ls || ',r' || rf ELSE rf END AS admit_type,
          CASE WHEN group_type=3 THEN '/accident?clm=' || {B64} WHEN group_type=6 THEN '/misc?id=' || claim_code ELSE '/health?clm=' || {B64} END AS link
          FROM r_import_detail d LEFT JOIN part p ON p.p_partkey=d.product_id LEFT JOIN r_hospital h ON h.hospital_id=d.hospital_id""")
def _(r):
    d = (r.import_detail.join(r.t("part").select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name")), "product_id", "left")
         .join(r.hospital.select("hospital_id", "hospital_name"), "hospital_id", "left").withColumn("admit_type", F.col("rf")))
    admits = r.import_detail.filter("group_type = 6").select("claim_code", F.explode(F.array(F.concat(F.lit("r"), F.col("rf")), F.concat(F.lit("l"), F.col("ls")))).alias("admit_name"))
    return L.list_group_items(d.filter("group_type IN (2, 4, 5)"), d.filter("group_type = 3"), d.filter("group_type = 6"), admits, LINKS)


@query("list_subgroup_siblings", "subgroup_code:s transfer_code:s amount:d is_paid:i is_asked:i",
       """ask AS (SELECT transfer_id FROM r_transfer WHERE group_type=4), m AS (SELECT DISTINCT subgroup_id, transfer_id FROM r_subgroup_detail)
       ;; SELECT s.subgroup_code, t.transfer_code, s.amount, s.is_paid, CASE WHEN m.transfer_id IN (SELECT transfer_id FROM ask) THEN 1 ELSE 0 END AS is_asked FROM m
          JOIN r_transfer t ON t.transfer_id=m.transfer_id LEFT JOIN r_subgroup s ON s.subgroup_id=m.subgroup_id
          WHERE m.subgroup_id IN (SELECT subgroup_id FROM m WHERE transfer_id IN (SELECT transfer_id FROM ask))""")
def _(r):
    return L.list_subgroup_siblings(r.subgroup_detail, r.transfer, r.subgroup, r.transfer.filter("group_type = 4"))


REPAY_SQL = """sg AS (SELECT subgroup_id, subgroup_code, amount, item_count, subgroup_id%100 AS hospital_id FROM r_subgroup),
    ac AS (SELECT subgroup_id, CASE WHEN item_count%2=0 THEN 'R' || subgroup_id END AS receiving_no, subgroup_id%100 AS sending_bank, CASE WHEN item_count%3=0 THEN subgroup_id%90+5000000 ELSE (subgroup_id+7)%100 END AS receiving_bank FROM r_subgroup),
    x AS (SELECT t.event_id, t.subgroup_id, t.created_at, sg.subgroup_code, sg.amount, coalesce(ac.receiving_no, replace(h.nation_id || '-' || h.hospital_id,'-','')) AS bank_account, coalesce(o.s_name, 'bank ' || h.nation_id) AS bank, o.s_suppkey AS org_id
      FROM r_transaction t LEFT JOIN sg ON sg.subgroup_id=t.subgroup_id LEFT JOIN r_hospital h ON h.hospital_id=sg.hospital_id LEFT JOIN ac ON ac.subgroup_id=t.subgroup_id
      LEFT JOIN supplier o ON o.s_suppkey IN (ac.sending_bank, ac.receiving_bank) WHERE t.status_id IN (4,6))
    ;; """


def repay(r):
    groups = r.subgroup.withColumn("hospital_id", F.col("subgroup_id") % 100)
    hospitals = r.hospital.withColumns({"account_no": F.concat_ws("-", "nation_id", "hospital_id"), "bank_name": join_text(F.lit("bank "), F.col("nation_id"))})
    key = F.col("subgroup_id")
    accounts = r.subgroup.select(
        "subgroup_id", F.when(F.col("item_count") % 2 == 0, join_text(F.lit("R"), key)).alias("receiving_no"), (key % 100).alias("sending_bank"),
        F.when(F.col("item_count") % 3 == 0, key % 90 + 5000000).otherwise((key + 7) % 100).alias("receiving_bank"))
    return L.list_repay(r.transaction, groups, hospitals, accounts, r.t("supplier").select(F.col("s_suppkey").alias("org_id"), F.col("s_name").alias("org_name")))


@query("list_repay", "event_id:i subgroup_code:s amount:d bank_account:s bank:s", REPAY_SQL + "SELECT * FROM x")
def _(r):
    return repay(r)


@query("list_repay_page", "event_id:i subgroup_code:s bank_account:s bank:s total_count:i",
       REPAY_SQL + "SELECT *, count(*) OVER () AS total_count FROM x ORDER BY created_at DESC, event_id DESC, org_id NULLS FIRST LIMIT 10")
def _(r):
    return page(repay(r), [F.col("created_at").desc(), F.col("event_id").desc(), F.col("org_id").asc_nulls_first()])


@query("list_imported_groups", "group_code:s net_amount:d status_id:i branch:s",
       """cv AS (SELECT import_id, sum(cover_amount) AS covered FROM r_prior_result WHERE is_active GROUP BY import_id)
       ;; SELECT group_code, total_amount-coalesce(covered,0) AS net_amount, status_id, branch FROM r_imported i LEFT JOIN cv ON cv.import_id=i.import_id LEFT JOIN r_branch b ON b.branch_id=i.branch_id
          WHERE is_active AND created_at >= '1995-06-01' AND created_at < '2001-01-01' AND contains(group_code,'H-')""")
def _(r):
    # every source names the branch of its groups
    parts = [r.group.filter(F.col("group_type").isin(*types)).select("group_code", "branch_id") for types in ([2, 5], [3], [4], [6])]
    sources = parts[0]
    for part in parts[1:]:
        sources = sources.unionByName(part)
    covers = r.prior_result.filter("is_active").select("detail_id", "cover_amount")
    return L.list_imported_groups(r.imported, r.import_detail, covers, sources, r.branch, "1995-06-01", "2000-12-31", search="H-")


@query("import_detail_view", "detail_id:i claim_code:s cover_amount:d npl_amount:d claim_link:s",
       f"""SELECT d.detail_id, d.claim_code, CASE WHEN is_manual_npl=1 THEN 0 ELSE coalesce(cover_amount,0) END AS cover_amount, CASE WHEN is_manual_npl=1 THEN coalesce(cover_amount,0) ELSE 0 END AS npl_amount,
          CASE WHEN group_type IN (2,4,5) THEN '/health?clm=' || {B64.replace('claim_code', 'd.claim_code')} WHEN group_type=3 THEN '/accident?clm=' || {B64.replace('claim_code', 'd.claim_code')} ELSE '/misc?id=' || d.import_id END AS claim_link
          FROM r_import_detail d LEFT JOIN (SELECT * FROM r_prior_result WHERE is_active) p ON p.detail_id=d.detail_id""")
def _(r):
    return L.import_detail_view(r.import_detail, r.prior_result.withColumn("is_manual", F.col("is_manual_npl")), LINKS)


def bills(r, **choice):
    insurers = r.group.select("insurer_id").distinct().withColumn("insurer_code", zero_pad(F.col("insurer_id"), 12))
    config = insurers.filter("insurer_id % 2 = 0").select("insurer_code")
    products = insurers.filter("insurer_id > 5").select("insurer_code", F.lit(2).alias("group_type"), F.when(F.col("insurer_id") % 4 == 0, 1).otherwise(0).alias("is_sftp"))
    exported = r.bill_item.filter("group_type = 6").select("bill_code", (F.col("line_no") * 10).alias("product_type"))
    return L.list_bills(r.bill, insurers, config, products, exported, **choice)


BILL_SQL = """x AS (SELECT *, CASE WHEN insurer_id%2=0 THEN CASE WHEN insurer_id>5 AND group_type=2 THEN CASE WHEN insurer_id%4=0 THEN 1 ELSE 0 END ELSE 1 END ELSE 0 END AS is_sftp FROM r_bill)
    ;; """


@query("list_bills", "bill_code:s insurer_id:i item_count:i total_amount:d is_sftp:i", BILL_SQL + "SELECT * FROM x")
def _(r):
    return bills(r)


@query("list_bills_by_product", "bill_code:s is_sftp:i", BILL_SQL + "SELECT * FROM x WHERE bill_code IN (SELECT bill_code FROM r_bill_item WHERE group_type=6 AND line_no=1)")
def _(r):
    return bills(r, group_type=10)


@query("list_bills_page", "bill_code:s total_amount:d is_sftp:i total_count:i",
       BILL_SQL + "SELECT *, count(*) OVER () AS total_count FROM x WHERE claim_type_code='1000' ORDER BY total_amount, bill_code LIMIT 10")
def _(r):
    return L.bill_page(bills(r, claim_type="1000"), "TotalAmount", "ASC")


NAMES_SQL = """(SELECT DISTINCT insurer_id, 'Insurer ' || insurer_id AS insurer_name FROM r_group) n ON n.insurer_id=x.insurer_id
    LEFT JOIN (VALUES (2,'PH'),(3,'PA'),(4,'Compensate'),(5,'PA30'),(6,'Misc')) g(group_type, group_type_name) ON g.group_type=x.group_type
    LEFT JOIN (VALUES ('1000','hospital'),('2000','customer')) c(claim_type_code, claim_type) ON c.claim_type_code=x.claim_type_code"""


def named_page(r, field, direction):
    insurers = r.group.select("insurer_id").distinct().withColumn("insurer_name", F.concat(F.lit("Insurer "), F.col("insurer_id").cast("string")))
    group_types = values_table(r.spark, ["group_type", "group_type_name"], [(2, "PH"), (3, "PA"), (4, "Compensate"), (5, "PA30"), (6, "Misc")])
    claim_types = values_table(r.spark, ["claim_type_code", "claim_type"], [("1000", "hospital"), ("2000", "customer")])
    return L.bill_page(bills(r), field, direction, 5, 20, insurers, group_types, claim_types)


def named_page_sql(column, direction):
    nulls = "NULLS LAST" if direction == "DESC" else "NULLS FIRST"
    return BILL_SQL + f"SELECT bill_code, insurer_name, group_type_name, claim_type, count(*) OVER () AS total_count FROM x LEFT JOIN {NAMES_SQL} ORDER BY {column} {direction} {nulls}, bill_code LIMIT 20 OFFSET 5"


NAMED = "bill_code:s insurer_name:s group_type_name:s claim_type:s total_count:i"


@query("list_bills_by_insurer", NAMED, named_page_sql("insurer_name", "ASC"))
def _(r):
    return named_page(r, "InsuranceCompanyName", "ASC")


@query("list_bills_by_type_name", NAMED, named_page_sql("group_type_name", "DESC"))
def _(r):
    return named_page(r, "ClaimHeaderGroupTypeName", "DESC")


@query("list_bills_by_claim_type", NAMED, named_page_sql("claim_type", "DESC"))
def _(r):
    return named_page(r, "ClaimType", "DESC")


@query("list_bill_items", "item_code:s bill_code:s branch:s net_amount:d",
       """SELECT item_code, bill_code, branch, CASE WHEN i.group_type=6 THEN g.total_amount ELSE pay_total END - i.cover_amount AS net_amount
          FROM r_bill_item i JOIN r_imported g ON g.import_id=i.import_id LEFT JOIN r_branch b ON b.branch_id=i.branch_id""")
def _(r):
    return L.list_bill_items(r.bill_item, r.imported, r.branch)
