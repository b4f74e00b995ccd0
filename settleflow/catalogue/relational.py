"""Relational building blocks: filters, joins, set operations, aggregations, sorting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from settleflow.catalogue.base import query
from settleflow.functions.scalars import flag, join_text, messages, money, month_start
from settleflow.operators.aggregates import (
    all_true, count_when, distinct_text, first_row_per_group, pivot_values, sum_when, text_list,
)
from settleflow.operators.filters import contains_text, half_open, keep_where, split_codes
from settleflow.operators.joins import or_join, values_table
from settleflow.operators.paging import page, sort_columns

DEC = "decimal(16,2)"

# fixed values: product code per header-group type
PRODUCT_CODE = [(2, "1000"), (3, "2000"), (4, "2222"), (5, "P30"), (6, "Misc")]


@query("scan_table", "n_nationkey:i n_name:s n_regionkey:i", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def _(r):
    return r.t("nation")


@query("const_map_join", "product_code:s groups:i amount:d",
       """SELECT m.code AS product_code, count(*) AS groups, sum(g.order_total) AS amount FROM r_group g
          JOIN (VALUES (2,'1000'),(3,'2000'),(4,'2222'),(5,'P30'),(6,'Misc')) m(t,code) ON g.group_type=m.t GROUP BY m.code""")
def _(r):
    codes = values_table(r.spark, ["group_type", "product_code"], PRODUCT_CODE)
    return (r.group.join(F.broadcast(codes), "group_type")  # five literal rows
            .groupBy("product_code").agg(F.count(F.lit(1)).alias("groups"), F.sum("order_total").alias("amount")))


def code_requests(r):
    """One request text per group: its own code twice, a blank element and a code of the next group."""
    code = F.col("group_code")
    return r.group.select("order_key", F.concat(code, F.lit(",,"), code, F.lit(", "), F.substring(code, 1, 4)).alias("codes"))


REQUEST_SQL = """req AS (SELECT order_key, group_code || ',,' || group_code || ', ' || substr(group_code,1,4) AS codes FROM r_group)"""


@query("split_list_filter", "group_code:s order_total:d",
       REQUEST_SQL + """, c AS (SELECT DISTINCT trim(e) AS code FROM (SELECT unnest(string_split(codes, ',')) AS e FROM req) WHERE trim(e) <> '')
       ;; SELECT group_code, order_total FROM r_group JOIN c ON group_code=code""")
def _(r):
    wanted = split_codes(code_requests(r), "codes", "group_code")
    return r.group.join(wanted, "group_code", "left_semi")


@query("project_typed_null", "claim_code:s amount:d bank_account:s paid_at:t",
       "SELECT claim_code, amount, CAST(NULL AS VARCHAR) AS bank_account, CAST(NULL AS TIMESTAMP) AS paid_at FROM r_item")
def _(r):
    return r.item.select("claim_code", "amount", F.lit(None).cast("string").alias("bank_account"),
                         F.lit(None).cast("timestamp_ntz").alias("paid_at"))


@query("filter_half_open_date", "order_key:i group_code:s created_at:t",
       "SELECT order_key, group_code, created_at FROM r_group WHERE created_at >= '1996-01-01' AND created_at < DATE '1997-12-31' + INTERVAL 1 DAY")
def _(r):
    return r.group.filter(half_open("created_at", "1996-01-01", "1997-12-31"))


@query("filter_optional_params", "order_key:i group_code:s",
       "SELECT order_key, group_code FROM r_group WHERE insurer_id = 3 AND (branch_id = NULL OR NULL IS NULL) AND claim_type_code IN ('1000')")
def _(r):
    return keep_where(r.group, insurer_id=3, branch_id=None, claim_type_code=["1000"])


@query("filter_like", "order_key:i group_code:s",
       "SELECT order_key, group_code FROM r_group WHERE group_code LIKE '%_0' AND contains(group_code, 'BU3')")
def _(r):
    return r.group.filter(F.col("group_code").like("%_0") & contains_text("group_code", "BU3"))


@query("filter_in_list", "order_key:i group_type:i insurer_id:i",
       "SELECT order_key, group_type, insurer_id FROM r_group WHERE group_type IN (2,4,5) AND insurer_id NOT IN (1,2) AND status_id <> 4")
def _(r):
    return r.group.filter(F.col("group_type").isin(2, 4, 5) & ~F.col("insurer_id").isin(1, 2) & (F.col("status_id") != 4))


def mode_test(mode: int):
    """Predicate of one claim-group type; the others never enter the plan."""
    online, hospital, death = F.col("status_id") == 2, F.col("claim_type_code") == "1000", F.col("branch_id") % 5 == 0
    return {2: online & ~death, 3: ~online & ~hospital, 4: ~online & hospital, 6: online & death}[mode]


@query("filter_mode_dispatch", "mode:i groups:i amount:d",
       """SELECT 3 AS mode, count(*) AS groups, sum(order_total) AS amount FROM r_group WHERE status_id<>2 AND claim_type_code<>'1000'
          UNION ALL SELECT 4, count(*), sum(order_total) FROM r_group WHERE status_id<>2 AND claim_type_code='1000'
          UNION ALL SELECT 2, count(*), sum(order_total) FROM r_group WHERE status_id=2 AND branch_id%5<>0
          UNION ALL SELECT 6, count(*), sum(order_total) FROM r_group WHERE status_id=2 AND branch_id%5=0""")
def _(r):
    parts = [r.group.filter(mode_test(m)).agg(F.count(F.lit(1)).alias("groups"), F.sum("order_total").alias("amount"))
             .select(F.lit(m).alias("mode"), "groups", "amount") for m in (2, 3, 4, 6)]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("join_inner", "claim_code:s group_code:s amount:d",
       "SELECT claim_code, group_code, amount FROM r_item i JOIN r_group g ON i.order_key=g.order_key")
def _(r):
    return r.item.join(r.group, "order_key")


@query("join_left_chain", "claim_code:s hospital_name:s branch:s region:s customer_name:s product_name:s",
       """SELECT d.claim_code, h.hospital_name, b.branch, re.r_name AS region, c.c_name AS customer_name, p.p_name AS product_name
          FROM r_import_detail d LEFT JOIN r_hospital h ON d.hospital_id=h.hospital_id LEFT JOIN r_branch b ON d.branch_id=b.branch_id
          LEFT JOIN region re ON b.region_id=re.r_regionkey LEFT JOIN customer c ON d.customer_id=c.c_custkey
          LEFT JOIN part p ON d.product_id=p.p_partkey""")
def _(r):
    return (r.import_detail.join(r.hospital, "hospital_id", "left").join(r.branch, "branch_id", "left")
            .join(r.t("region").select(F.col("r_regionkey").alias("region_id"), F.col("r_name").alias("region")), "region_id", "left")
            .join(r.t("customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name")), "customer_id", "left")
            .join(r.t("part").select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name")), "product_id", "left"))


@query("join_composite_on_filter", "bill_code:s insurer_id:i covered:i",
       """SELECT b.bill_code, b.insurer_id, count(x.claim_code) AS covered FROM r_bill b
          LEFT JOIN r_bill_item x ON b.bill_code=x.bill_code AND b.insurer_id=x.insurer_id AND x.cover_amount > 0 GROUP BY b.bill_code, b.insurer_id""")
def _(r):
    # the condition belongs to the join, so it filters the right side and keeps every bill
    covered = r.bill_item.filter("cover_amount > 0").groupBy("bill_code", "insurer_id").agg(F.count("claim_code").alias("n"))
    return (r.bill.join(covered, ["bill_code", "insurer_id"], "left")
            .select("bill_code", "insurer_id", F.coalesce("n", F.lit(0)).alias("covered")))


@query("join_prefiltered", "group_code:s payback_code:s amount:d",
       "SELECT g.group_code, p.payback_code, p.amount FROM r_group g LEFT JOIN (SELECT * FROM r_payback WHERE status_id=3) p ON g.order_key=p.payback_id")
def _(r):
    settled = r.payback.filter("status_id = 3").select(F.col("payback_id").alias("order_key"), "payback_code", "amount")
    return r.group.select("order_key", "group_code").join(settled, "order_key", "left")


@query("join_or_keys", "claim_code:s found_hospital:i hospital_name:s",
       """SELECT claim_code, h.hospital_id AS found_hospital, hospital_name FROM
          (SELECT claim_code, hospital_id AS a, product_id AS b FROM r_item) i LEFT JOIN r_hospital h ON h.hospital_id=a OR h.hospital_id=b""")
def _(r):
    claims = r.item.select("claim_code", F.col("hospital_id").alias("a"), F.col("product_id").alias("b"))
    names = r.hospital.select(F.col("hospital_id").alias("found_hospital"), "hospital_name")
    return or_join(claims, names, ["a", "b"], "found_hospital")


@query("join_in_two_cols", "event_id:i org:s",
       """SELECT e.event_id, s.s_name AS org FROM (SELECT event_id, user_id AS send, user_id+50 AS recv FROM events) e
          LEFT JOIN supplier s ON s.s_suppkey IN (e.send, e.recv)""")
def _(r):
    moves = r.t("events").select("event_id", F.col("user_id").alias("send"), (F.col("user_id") + 50).alias("recv"))
    return or_join(moves, r.t("supplier").select("s_suppkey", F.col("s_name").alias("org")), ["send", "recv"], "s_suppkey")


@query("cross_join_scalar", "bill_code:s total_amount:d all_amount:d share:d",
       """SELECT bill_code, total_amount, (SELECT sum(total_amount) FROM r_bill) AS all_amount,
          round(CAST(total_amount AS DOUBLE) / CAST((SELECT sum(total_amount) FROM r_bill) AS DOUBLE), 8) AS share FROM r_bill""")
def _(r):
    # one value for every row: a scalar subquery instead of a cross join
    whole = r.bill.agg(F.sum("total_amount").alias("s")).scalar()
    return r.bill.withColumn("all_amount", whole).withColumn(
        "share", F.round(F.col("total_amount").cast("double") / F.col("all_amount").cast("double"), 8))


@query("semi_exists", "group_code:s",
       "SELECT group_code FROM r_group g WHERE EXISTS (SELECT 1 FROM r_item i WHERE i.order_key=g.order_key AND i.rf='R')")
def _(r):
    return r.group.join(r.item.filter("rf = 'R'"), "order_key", "left_semi")


@query("semi_exists_or", "subgroup_id:i",
       """SELECT DISTINCT subgroup_id FROM r_transaction t WHERE
          EXISTS (SELECT 1 FROM r_transaction a WHERE a.subgroup_id=t.subgroup_id AND a.status_id=5 AND a.created_at >= '2024-01-10')
          AND (EXISTS (SELECT 1 FROM r_transaction b WHERE b.subgroup_id=t.subgroup_id AND b.status_id=4 AND b.created_at >= '2024-01-10')
            OR EXISTS (SELECT 1 FROM r_transaction c WHERE c.subgroup_id=t.subgroup_id AND c.status_id=6 AND c.created_at >= '2024-01-10'))""")
def _(r):
    recent = r.transaction.filter(half_open("created_at", "2024-01-10", None))
    return (recent.groupBy("subgroup_id")
            .agg(F.max(flag(F.col("status_id") == 5)).alias("done"), F.max(flag(F.col("status_id").isin(4, 6))).alias("odd"))
            .filter("done = 1 AND odd = 1"))


@query("anti_not_exists", "group_code:s order_total:d",
       "SELECT group_code, order_total FROM r_group g WHERE NOT EXISTS (SELECT 1 FROM r_item i WHERE i.order_key=g.order_key)")
def _(r):
    return r.group.join(r.t("lineitem").select(F.col("l_orderkey").alias("order_key")), "order_key", "left_anti")


@query("anti_left_null", "item_code:s",
       "SELECT item_code FROM r_bill_item i WHERE NOT EXISTS (SELECT 1 FROM r_reject j WHERE j.item_code=i.item_code)")
def _(r):
    return r.bill_item.join(r.reject, "item_code", "left_anti")


@query("join_then_range_or_null", "claim_code:s filed_at:t approved_at:t",
       """SELECT d.claim_code, d.created_at AS filed_at, p.approved_at FROM r_import_detail d
          LEFT JOIN (SELECT app_id, policy_type_id, min(created_at) AS approved_at FROM r_policy GROUP BY 1,2) p
          ON p.app_id=d.customer_id AND p.policy_type_id=9600+d.line_no WHERE p.approved_at > d.created_at OR p.approved_at IS NULL""")
def _(r):
    approved = r.policy.groupBy(F.col("app_id").alias("customer_id"), "policy_type_id").agg(F.min("created_at").alias("approved_at"))
    claims = r.import_detail.select("claim_code", "customer_id", F.col("created_at").alias("filed_at"), (F.col("line_no") + 9600).alias("policy_type_id"))
    return (claims.join(approved, ["customer_id", "policy_type_id"], "left")
            .filter((F.col("approved_at") > F.col("filed_at")) | F.col("approved_at").isNull()))


@query("join_month_bucket", "claim_code:s policy_no:s",
       """SELECT d.claim_code, p.policy_no FROM r_import_detail d LEFT JOIN
          (SELECT app_id, date_trunc('month', created_at) AS period, max(detail) AS policy_no FROM r_policy GROUP BY 1,2) p
          ON p.app_id=d.customer_id AND p.period=date_trunc('month', d.created_at)""")
def _(r):
    monthly = r.policy.groupBy(F.col("app_id").alias("customer_id"), month_start(F.col("created_at")).alias("period")).agg(F.max("detail").alias("policy_no"))
    claims = r.import_detail.select("claim_code", "customer_id", month_start(F.col("created_at")).alias("period"))
    return claims.join(monthly, ["customer_id", "period"], "left")


@query("union_distinct", "group_code:s source:s",
       """SELECT group_code, 'claims' AS source FROM r_import_detail UNION SELECT group_code, 'claims' FROM r_group WHERE status_id=2""")
def _(r):
    a = r.import_detail.select("group_code", F.lit("claims").alias("source"))
    b = r.group.filter("status_id = 2").select(F.lit("claims").alias("source"), "group_code")  # matched by name
    return a.unionByName(b).distinct()


@query("union_all_sources", "source:s code:s amount:d",
       """SELECT 'group' AS source, group_code AS code, order_total AS amount FROM r_group UNION ALL SELECT 'claim', claim_code, amount FROM r_item""")
def _(r):
    return (r.group.select(F.lit("group").alias("source"), F.col("group_code").alias("code"), F.col("order_total").alias("amount"))
            .unionByName(r.item.select(F.lit("claim").alias("source"), F.col("claim_code").alias("code"), "amount")))


@query("distinct_rows", "insurer_id:i branch_id:i group_type:i", "SELECT DISTINCT insurer_id, branch_id, group_type FROM r_group")
def _(r):
    return r.group.select("insurer_id", "branch_id", "group_type").distinct()


@query("group_dedupe", "insurer_id:i claim_type_code:s billing_date:y",
       "SELECT insurer_id, claim_type_code, billing_date FROM r_imported GROUP BY insurer_id, claim_type_code, billing_date")
def _(r):
    return r.imported.select("insurer_id", "claim_type_code", "billing_date").dropDuplicates()


@query("agg_basic", "group_code:s claims:i amount:d high:d low:d",
       "SELECT group_code, count(*) AS claims, sum(pay_total) AS amount, max(pay_total) AS high, min(pay_total) AS low FROM r_import_detail GROUP BY group_code")
def _(r):
    return r.import_detail.groupBy("group_code").agg(
        F.count(F.lit(1)).alias("claims"), F.sum("pay_total").alias("amount"), F.max("pay_total").alias("high"), F.min("pay_total").alias("low"))


@query("agg_conditional", "insurer_id:i hospital_claims:i returned:d any_open:i",
       """SELECT insurer_id, sum(CASE WHEN claim_type_code='1000' THEN 1 ELSE 0 END) AS hospital_claims,
          sum(CASE WHEN rf='R' THEN pay_total END) AS returned, max(CASE WHEN ls='O' THEN 1 ELSE 0 END) AS any_open
          FROM r_import_detail GROUP BY insurer_id""")
def _(r):
    return r.import_detail.groupBy("insurer_id").agg(
        F.sum(flag(F.col("claim_type_code") == "1000")).alias("hospital_claims"),
        sum_when(F.col("rf") == "R", F.col("pay_total")).alias("returned"), F.max(flag(F.col("ls") == "O")).alias("any_open"))


@query("agg_signed_sum", "branch_id:i net:d",
       """SELECT branch_id, sum(CASE WHEN group_type IN (2,3) THEN order_total WHEN group_type=4 THEN -order_total ELSE 0 END) AS net
          FROM r_group GROUP BY branch_id""")
def _(r):
    sign = F.when(F.col("group_type").isin(2, 3), F.col("order_total")).when(F.col("group_type") == 4, -F.col("order_total")).otherwise(0)
    return r.group.groupBy("branch_id").agg(F.sum(sign).alias("net"))


@query("agg_having_dups", "detail_id:i entries:i", "SELECT detail_id, count(*) AS entries FROM r_cover_log GROUP BY detail_id HAVING count(*) > 1")
def _(r):
    return r.cover_log.groupBy("detail_id").agg(F.count(F.lit(1)).alias("entries")).filter("entries > 1")


@query("agg_count_distinct", "insurer_id:i hospitals:i claims:i",
       "SELECT insurer_id, count(DISTINCT hospital_id) AS hospitals, count(*) AS claims FROM r_import_detail GROUP BY insurer_id")
def _(r):
    # claims per (insurer, hospital) first: the second step then sees small, even groups
    return (r.import_detail.groupBy("insurer_id", "hospital_id").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("insurer_id").agg(F.count(F.lit(1)).alias("hospitals"), F.sum("n").alias("claims")))


@query("agg_sum_of_max", "insurer_id:i total:d",
       "SELECT insurer_id, sum(m) AS total FROM (SELECT insurer_id, group_code, max(pay_total) AS m FROM r_import_detail GROUP BY 1,2) GROUP BY insurer_id")
def _(r):
    return (r.import_detail.groupBy("insurer_id", "group_code").agg(F.max("pay_total").alias("m"))
            .groupBy("insurer_id").agg(F.sum("m").alias("total")))


@query("agg_all_true", "transfer_id:i all_settled:i",
       """SELECT transfer_id, CASE WHEN sum(CASE WHEN status_id=3 THEN 1 ELSE 0 END)=count(*) THEN 1 ELSE 0 END AS all_settled
          FROM r_payback WHERE transfer_id IS NOT NULL GROUP BY transfer_id""")
def _(r):
    return r.payback.filter("transfer_id IS NOT NULL").groupBy("transfer_id").agg(all_true(F.col("status_id") == 3).alias("all_settled"))


@query("agg_string_ordered", "app_id:i history:s",
       """SELECT app_id, string_agg(detail || ' (' || policy_type_id || ')', ' > ' ORDER BY created_at, policy_key) AS history
          FROM r_policy GROUP BY app_id""")
def _(r):
    lines = r.policy.select("app_id", join_text(F.col("detail"), F.lit(" ("), F.col("policy_type_id"), F.lit(")")).alias("line"), "created_at", "policy_key")
    return text_list(lines, ["app_id"], "line", ["created_at", "policy_key"], " > ", "history")


@query("agg_string_distinct", "insurer_id:i kinds:s",
       "SELECT insurer_id, string_agg(DISTINCT k, ',' ORDER BY k) AS kinds FROM (SELECT insurer_id, rf || ls AS k FROM r_import_detail) GROUP BY insurer_id")
def _(r):
    return distinct_text(r.import_detail.select("insurer_id", F.concat("rf", "ls").alias("k")), ["insurer_id"], "k", ",", "kinds")


POLICY_COLUMNS = {9601: "p9601", 9602: "p9602", 9603: "p9603", 9604: "p9604", 9605: "p9605"}


@query("pivot_max", "app_id:i p9601:s p9602:s p9603:s p9604:s p9605:s",
       "SELECT app_id, " + ", ".join(f"max(CASE WHEN policy_type_id={c} THEN detail END) AS {n}" for c, n in POLICY_COLUMNS.items()) + " FROM r_policy GROUP BY app_id")
def _(r):
    return pivot_values(r.policy, ["app_id"], "policy_type_id", POLICY_COLUMNS, F.col("detail"))


@query("pivot_sum_net", "branch_id:i net:d",
       """SELECT branch_id, coalesce(sum(CASE WHEN group_type=2 THEN order_total END),0)+coalesce(sum(CASE WHEN group_type=3 THEN order_total END),0)
          -coalesce(sum(CASE WHEN group_type=4 THEN order_total END),0) AS net FROM r_group GROUP BY branch_id""")
def _(r):
    wide = pivot_values(r.group, ["branch_id"], "group_type", {2: "a", 3: "b", 4: "c"}, F.col("order_total"), F.sum)
    zero = F.lit(0)
    return wide.withColumn("net", F.coalesce("a", zero) + F.coalesce("b", zero) - F.coalesce("c", zero))


@query("first_row_per_group", "group_code:s claim_code:s hospital_id:i pay_total:d",
       """SELECT group_code, claim_code, hospital_id, pay_total FROM (SELECT *, row_number() OVER (PARTITION BY group_code ORDER BY claim_code) AS rn
          FROM r_import_detail) WHERE rn=1""")
def _(r):
    return first_row_per_group(r.import_detail.select("group_code", "claim_code", "hospital_id", "pay_total"), ["group_code"], ["claim_code"])


@query("sort_multi", "transfer_id:i oop_status:i amount:d", "SELECT transfer_id, oop_status, amount FROM r_transfer")
def _(r):
    return r.transfer.orderBy(F.col("oop_status").asc_nulls_first(), F.col("amount").desc_nulls_last(), F.col("transfer_id"))


SORTABLE = {"Amount": "amount", "Created": "created_at", "Code": "transfer_code"}


@query("sort_dynamic", "transfer_code:s amount:d",
       "SELECT transfer_code, amount FROM r_transfer ORDER BY amount DESC NULLS LAST, transfer_id LIMIT 25")
def _(r):
    order = sort_columns("Amount", "DESC", SORTABLE, [F.col("created_at").desc()], ["transfer_id"])
    return r.transfer.orderBy(*order).limit(25)


@query("page_offset_fetch", "transfer_code:s created_at:t",
       "SELECT transfer_code, created_at FROM r_transfer ORDER BY created_at DESC, transfer_id LIMIT 10 OFFSET 20")
def _(r):
    return page(r.transfer, [F.col("created_at").desc(), F.col("transfer_id")], 20, 10, total=None)


@query("top_n", "claim_code:s amount:d", "SELECT claim_code, amount FROM r_item ORDER BY amount DESC, claim_code LIMIT 100")
def _(r):
    return r.item.orderBy(F.col("amount").desc(), "claim_code").limit(100)


@query("latest_by_max_struct", "subgroup_id:i last_at:t status_id:i",
       """SELECT subgroup_id, created_at AS last_at, status_id FROM (SELECT *, row_number() OVER (PARTITION BY subgroup_id
          ORDER BY created_at DESC, status_id DESC) AS rn FROM r_transaction) WHERE rn=1""")
def _(r):
    last = r.transaction.groupBy("subgroup_id").agg(F.max(F.struct("created_at", "status_id")).alias("m"))
    return last.select("subgroup_id", F.col("m.created_at").alias("last_at"), F.col("m.status_id").alias("status_id"))
