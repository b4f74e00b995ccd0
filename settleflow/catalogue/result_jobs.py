"""Insurer results and manual cover entries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from settleflow.catalogue.base import query
from settleflow.functions import messages as M
from settleflow.plans import results as R

AS_OF = dt.date(2002, 1, 15)


def stored(r):
    """Results on record: returned-and-approved open items of the bills."""
    return r.bill_item.filter("rf = 'A' AND ls = 'O'").select(
        "item_code", "bill_code", "cover_amount", F.lit(0).cast("decimal(16,2)").alias("uncover_amount"),
        F.lit("old").alias("remark"), F.when(F.col("line_no") == 7, 4).otherwise(2).alias("decision_id"), F.lit("2001-01-01").cast("date").alias("estimated_on"))


def received(r, status):
    return r.bill.filter("total_amount < 20000").select("bill_code", F.lit(status).alias("status_id"))


def counters(r):
    used = r.bill.agg(F.count(F.lit(1)).alias("running"))
    return used.select(F.lit("TCB").alias("prefix"), F.lit("45").alias("year"), F.lit("01").alias("month"), "running")


def by_import(r, status=1):
    rejects = r.reject.withColumn("is_active", F.lit(True))
    return R.apply_results(r.bill_item, stored(r), rejects, received(r, status), counters(r), AS_OF, "2002-02-01",
                           tmp_codes=r.reject.select("tmp_code").distinct())


def by_bill(r):
    rejects = r.reject.withColumn("is_active", F.lit(True))
    return R.apply_results(r.bill_item, stored(r), rejects, received(r, 1), counters(r), AS_OF, "2002-02-01",
                           bill_codes=r.bill.filter("claim_type_code = '1000'").select("bill_code"))


STORED_SQL = """old AS (SELECT item_code, bill_code, cover_amount, CAST(0 AS DECIMAL(16,2)) AS uncover_amount, 'old' AS remark, CASE WHEN line_no=7 THEN 4 ELSE 2 END AS decision_id,
        DATE '2001-01-01' AS estimated_on FROM r_bill_item WHERE rf='A' AND ls='O'),
    dec_ AS MATERIALIZED (SELECT i.*, j.rejected_amount, j.rejected_remark, CASE WHEN j.item_code IS NULL THEN 2
          WHEN amount_total-rejected_amount>0 AND amount_total-rejected_amount<amount_total THEN 3 ELSE 4 END AS d FROM r_bill_item i LEFT JOIN r_reject j ON i.item_code=j.item_code)"""
IMPORT_SQL = STORED_SQL + """, pick AS (SELECT bill_code, min(tmp_code) AS tmp_code FROM r_bill_item i JOIN r_reject j ON i.item_code=j.item_code GROUP BY bill_code),
    rows_ AS MATERIALIZED (SELECT dec_.*, pick.tmp_code, pay_total-coalesce(rejected_amount,0) AS new_cover, coalesce(rejected_amount,0) AS new_uncover FROM dec_ JOIN pick ON dec_.bill_code=pick.bill_code)
    ;; """
BILL_SQL = STORED_SQL + """, pick AS (SELECT bill_code, 'TCB4501' || printf('%06d', (SELECT count(*) FROM r_bill) + row_number() OVER (ORDER BY bill_code)) AS tmp_code FROM r_bill WHERE claim_type_code='1000'),
    rows_ AS MATERIALIZED (SELECT dec_.*, pick.tmp_code, pay_total-coalesce(rejected_amount,0) AS new_cover, coalesce(rejected_amount,0) AS new_uncover FROM dec_ JOIN pick ON dec_.bill_code=pick.bill_code)
    ;; """
RESULT_COLUMNS = "item_code:s bill_code:s cover_amount:d uncover_amount:d remark:s decision_id:i estimated_on:y"


@query("apply_results", RESULT_COLUMNS,
       IMPORT_SQL + """SELECT o.item_code, o.bill_code, coalesce(n.new_cover, o.cover_amount) AS cover_amount, coalesce(n.new_uncover, o.uncover_amount) AS uncover_amount, o.remark,
          coalesce(CASE WHEN n.d IN (2,3) THEN 2 ELSE n.d END, o.decision_id) AS decision_id, CASE WHEN n.item_code IS NULL THEN o.estimated_on ELSE DATE '2002-02-01' END AS estimated_on
          FROM old o LEFT JOIN rows_ n ON o.item_code=n.item_code
          UNION ALL SELECT item_code, bill_code, new_cover, new_uncover, rejected_remark, CASE WHEN d IN (2,3) THEN 2 ELSE d END, DATE '2002-02-01' FROM rows_ n WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.item_code=n.item_code)""")
def _(r):
    return by_import(r)["results"]


@query("apply_results_by_bill", RESULT_COLUMNS,
       BILL_SQL + """SELECT * FROM old UNION ALL SELECT item_code, bill_code, new_cover, new_uncover, rejected_remark, CASE WHEN d IN (2,3) THEN 2 ELSE d END, DATE '2002-02-01'
          FROM rows_ n WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.item_code=n.item_code)""")
def _(r):
    return by_bill(r)["results"]


RECEIPT = "tmp_code:s item_code:s bill_code:s result_cover:d result_uncover:d decision_id:i payment:d"
RECEIPT_SQL = """SELECT tmp_code, item_code, bill_code, new_cover AS result_cover, new_uncover AS result_uncover, d AS decision_id,
    CASE WHEN d=3 THEN amount_total-rejected_amount ELSE amount_total END AS payment FROM rows_ WHERE d<>4"""


@query("apply_results_receipts", RECEIPT, IMPORT_SQL + RECEIPT_SQL)
def _(r):
    return by_import(r)["receipts"]


@query("apply_results_receipts_by_bill", RECEIPT, BILL_SQL + RECEIPT_SQL)
def _(r):
    return by_bill(r)["receipts"]


@query("apply_results_received", "tmp_code:s bill_code:s billing_date:y insurer_id:i claim_type_code:s",
       IMPORT_SQL + "SELECT DISTINCT tmp_code, bill_code, billing_date, insurer_id, claim_type_code FROM rows_ WHERE d<>4")
def _(r):
    return by_import(r)["received"]


@query("apply_results_headers", "bill_code:s", IMPORT_SQL + "SELECT DISTINCT bill_code FROM rows_ n WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.item_code=n.item_code)")
def _(r):
    return by_import(r)["headers"]


@query("apply_results_imports", "item_code:s is_active:i", IMPORT_SQL + "SELECT j.item_code, CASE WHEN n.item_code IS NULL THEN 1 ELSE 0 END AS is_active FROM r_reject j LEFT JOIN (SELECT DISTINCT item_code FROM rows_) n ON n.item_code=j.item_code")
def _(r):
    return by_import(r)["rejects"]


@query("apply_results_check", "is_result:i message:s repeated_bills:i",
       IMPORT_SQL + f"""SELECT CASE WHEN n=0 THEN 1 ELSE 0 END AS is_result, CASE WHEN n>0 THEN '{M.ALREADY_IMPORTED}' END AS message, n AS repeated_bills
          FROM (SELECT count(*) AS n FROM pick WHERE bill_code IN (SELECT bill_code FROM r_bill WHERE total_amount < 20000))""")
def _(r):
    return by_import(r, status=2)["check"]


@query("result_preview", "billing_date:y bill_list:s all_items:i all_amount:d approved_amount:d rejected_amount:d partial_amount:d partial_rejected:d approved_items:i rejected_items:i partial_items:i",
       STORED_SQL + """, pick AS (SELECT DISTINCT bill_code FROM r_bill_item i JOIN r_reject j ON i.item_code=j.item_code
          WHERE bill_code NOT IN (SELECT bill_code FROM r_bill WHERE total_amount < 20000)
          AND bill_code IN (SELECT bill_code FROM r_bill_item WHERE item_code NOT IN (SELECT item_code FROM old WHERE decision_id=4)))
       ;; SELECT d.billing_date, (SELECT string_agg(bill_code, ',' ORDER BY bill_code) FROM r_bill b WHERE b.billing_date=d.billing_date AND b.bill_code IN (SELECT bill_code FROM pick)) AS bill_list,
          (SELECT sum(item_count) FROM r_bill WHERE bill_code IN (SELECT bill_code FROM pick)) AS all_items, (SELECT sum(total_amount) FROM r_bill WHERE bill_code IN (SELECT bill_code FROM pick)) AS all_amount,
          sum(CASE WHEN d=2 THEN amount_total ELSE 0 END) AS approved_amount, sum(CASE WHEN d=4 THEN rejected_amount ELSE 0 END) AS rejected_amount,
          sum(CASE WHEN d=3 THEN amount_total-rejected_amount ELSE 0 END) AS partial_amount, sum(CASE WHEN d=3 THEN rejected_amount ELSE 0 END) AS partial_rejected,
          sum(CASE WHEN d=2 THEN 1 ELSE 0 END) AS approved_items, sum(CASE WHEN d=4 THEN 1 ELSE 0 END) AS rejected_items, sum(CASE WHEN d=3 THEN 1 ELSE 0 END) AS partial_items
          FROM dec_ d WHERE bill_code IN (SELECT bill_code FROM pick) GROUP BY d.billing_date""")
def _(r):
    return R.result_preview(r.bill_item, r.bill, stored(r), r.reject, received(r, 2), tmp_codes=r.reject.select("tmp_code").distinct())


def manual(r):
    """Every raw line item enters a cover for its claim; some lack a user, some name no claim."""
    entries = r.cover_log.select(
        (F.col("tie1") * 1000000 + F.col("tie2") * 1000 + F.col("tie4").cast("long")).alias("n"), "detail_id", "cover_amount", "is_manual_npl", "tie3", "created_at")
    entries = entries.groupBy("detail_id", "cover_amount", F.col("is_manual_npl").alias("is_npl")).agg(F.max("n").alias("n")).select(
        F.concat_ws("-", "detail_id", F.lpad(F.col("n").cast("string"), 15, "0"), "cover_amount", "is_npl").alias("entry_id"), "detail_id", "cover_amount", "is_npl",
        F.when(F.col("n") % 11 != 0, 7).alias("user_id"))
    details = r.import_detail.filter("is_active AND status_id <> 4").select("detail_id", "claim_code", "pay_total", F.when(F.col("status_id") == 3, F.lit("B")).alias("bill_code"))
    current = r.prior_result.select("detail_id", "cover_amount", F.when(F.col("is_active"), 1).otherwise(0).alias("is_manual"), "is_manual_npl", F.col("is_manual_npl").alias("on_bill"))
    return R.manual_cover_batch(entries, details, current)


MANUAL_SQL = f"""e AS (SELECT detail_id || '-' || lpad(CAST(n AS VARCHAR),15,'0') || '-' || cover_amount || '-' || is_npl AS entry_id, detail_id, cover_amount, is_npl, CASE WHEN n%11<>0 THEN 7 END AS user_id
        FROM (SELECT detail_id, cover_amount, is_manual_npl AS is_npl, max(tie1*1000000+tie2*1000+CAST(tie4 AS BIGINT)) AS n FROM r_cover_log GROUP BY 1,2,3)),
    d AS (SELECT detail_id, claim_code, pay_total, CASE WHEN status_id=3 THEN 'B' END AS bill_code FROM r_import_detail WHERE is_active AND status_id<>4),
    c AS (SELECT detail_id, cover_amount AS old_cover, CASE WHEN is_active THEN 1 ELSE 0 END AS is_manual, is_manual_npl, is_manual_npl AS on_bill FROM r_prior_result),
    j AS (SELECT e.*, claim_code, pay_total, bill_code, old_cover, c.detail_id IS NOT NULL AS known, is_manual, on_bill, row_number() OVER (PARTITION BY e.detail_id ORDER BY entry_id DESC) AS rn
        FROM e LEFT JOIN d ON e.detail_id=d.detail_id LEFT JOIN c ON e.detail_id=c.detail_id),
    k AS (SELECT *, CASE WHEN user_id IS NULL THEN '{M.INCOMPLETE}' WHEN rn>1 THEN '{M.NO_UPDATE}' WHEN claim_code IS NULL THEN '{M.NO_IMPORTED_CLAIM}' WHEN bill_code IS NOT NULL THEN '{M.ALREADY_BILLED}'
        WHEN known AND is_manual=0 THEN '{M.NOT_EDITABLE}' WHEN known AND on_bill=1 THEN '{M.NO_UPDATE}' WHEN known AND old_cover=cover_amount THEN '{M.VALUE_UNCHANGED}'
        WHEN cover_amount >= pay_total THEN '{M.CHECK_AMOUNT}' END AS reason FROM j)
    ;; """


@query("manual_cover_batch", "entry_id:s detail_id:i cover_amount:d action:s reason:s",
       MANUAL_SQL + "SELECT *, CASE WHEN reason IS NULL THEN CASE WHEN known THEN 'update' ELSE 'insert' END END AS action FROM k")
def _(r):
    return manual(r)["judged"]


@query("manual_cover_batch_state", "detail_id:i cover_amount:d is_manual:i is_manual_npl:i on_bill:i",
       MANUAL_SQL + """SELECT c.detail_id, coalesce(k.cover_amount, c.old_cover) AS cover_amount, c.is_manual, coalesce(k.is_npl, c.is_manual_npl) AS is_manual_npl, c.on_bill FROM c
          LEFT JOIN (SELECT * FROM k WHERE reason IS NULL) k ON k.detail_id=c.detail_id
          UNION ALL SELECT detail_id, cover_amount, 1, is_npl, 0 FROM k WHERE reason IS NULL AND NOT known""")
def _(r):
    return manual(r)["results"]


@query("manual_cover_batch_log", "entry_id:s detail_id:i cover_amount:d is_manual_npl:i user_id:i", MANUAL_SQL + "SELECT *, is_npl AS is_manual_npl FROM k WHERE reason IS NULL")
def _(r):
    return manual(r)["log"]
