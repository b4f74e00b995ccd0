"""Probes and maintenance jobs P1 to P14."""

from __future__ import annotations

from pyspark.sql import functions as F

from settleflow.catalogue.base import query
from settleflow.catalogue.payback_jobs import wanted_codes
from settleflow.catalogue.relational import REQUEST_SQL
from settleflow.functions.scalars import join_text
from settleflow.plans import quality as Q


def links(r):
    """Raw line items link claims to pay-backs, so a claim can be linked twice."""
    return r.t("lineitem").select((F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("claim_code"))


@query("dq_duplicate_claims", "claim_code:i times:i",
       "SELECT l_orderkey*100+l_linenumber AS claim_code, count(*) AS times FROM lineitem GROUP BY 1 HAVING count(*)>1")
def _(r):
    return Q.duplicate_claims(links(r))


@query("dq_no_document", "claim_code:s payback_code:s transfer_id:i created_at:t",
       """SELECT claim_code, payback_code, transfer_id, created_at FROM r_payback_claim c JOIN r_payback p ON p.payback_id=c.payback_id
          WHERE group_type<>7 AND created_at >= '1996-01-01' AND NOT EXISTS (SELECT 1 FROM r_document d WHERE d.claim_code=c.claim_code)""")
def _(r):
    return Q.claims_without_document(r.payback_claim, r.payback, r.document, "1996-01-01")


@query("dq_unanswered_items", "bill_code:s billing_date:y item_code:s amount_total:d",
       """SELECT DISTINCT bill_code, billing_date, item_code, amount_total FROM r_bill_item WHERE NOT (rf='A' AND ls='O') AND bill_code NOT IN (SELECT bill_code FROM r_bill WHERE total_amount < 20000)""")
def _(r):
    return Q.unanswered_items(r.bill_item, r.bill_item.filter("rf = 'A' AND ls = 'O'"), r.bill.filter("total_amount < 20000"))


@query("dq_pending_import", "group_code:s claim_code:s insurer_id:i amount:d created_at:t",
       """x AS (SELECT p.group_code, c.claim_code, p.insurer_id, p.amount, p.created_at, count(c.claim_code) OVER (PARTITION BY p.group_code) AS n FROM r_payback p LEFT JOIN r_import_detail c ON c.group_code=p.group_code
          WHERE p.insurer_id=4 AND p.group_type=3 AND p.group_code NOT IN (SELECT group_code FROM r_imported WHERE status_id=3 AND is_active))
       ;; SELECT group_code, claim_code, insurer_id, amount, created_at FROM x WHERE n=1""")
def _(r):
    return Q.pending_import(r.payback, r.import_detail, r.imported.filter("status_id = 3 AND is_active"), 4, 3)


@query("dq_codes_not_imported", "group_code:s",
       REQUEST_SQL + """, c AS (SELECT DISTINCT trim(e) AS code FROM (SELECT unnest(string_split(codes, ',')) AS e FROM req) WHERE trim(e) <> '')
       ;; SELECT code AS group_code FROM c WHERE code NOT IN (SELECT group_code FROM r_imported WHERE is_active AND status_id<>2)""")
def _(r):
    return Q.codes_not_imported(wanted_codes(r), r.imported)


@query("dq_transfer_conflicts", "event_id:i subgroup_id:i subgroup_code:s status_id:i created_at:t",
       """t AS (SELECT * FROM r_transaction WHERE status_id IN (4,5,6) AND created_at >= '2024-01-20')
       ;; SELECT t.event_id, t.subgroup_id, g.subgroup_code, t.status_id, t.created_at FROM t LEFT JOIN r_subgroup g ON g.subgroup_id=t.subgroup_id
          WHERE EXISTS (SELECT 1 FROM t a WHERE a.subgroup_id=t.subgroup_id AND a.status_id=5) AND EXISTS (SELECT 1 FROM t a WHERE a.subgroup_id=t.subgroup_id AND a.status_id IN (4,6))""")
def _(r):
    return Q.transfer_conflicts(r.transaction, r.subgroup, "2024-01-20")


@query("trace_claim_group", "group_code:s detail_code:s claim_code:s payback_code:s transfer_code:s",
       """SELECT d.group_code, d.detail_code, c.claim_code, p.payback_code, t.transfer_code FROM r_payback_detail d LEFT JOIN r_payback_claim c ON c.payback_id=d.payback_id AND c.hospital_id=d.hospital_id
          LEFT JOIN r_payback p ON p.payback_id=d.payback_id LEFT JOIN r_transfer t ON t.transfer_id=p.transfer_id""")
def _(r):
    return Q.trace_claim_group(wanted_codes(r), r.payback_detail, r.payback_claim, r.payback, r.transfer)


@query("slice_tables", "table_name:s rows:i amount:d",
       """k AS (SELECT order_key FROM r_group WHERE insurer_id=4)
       ;; SELECT 'claims' AS table_name, count(*) AS rows, sum(amount) AS amount FROM r_item WHERE order_key IN (SELECT order_key FROM k)
          UNION ALL SELECT 'groups', count(*), sum(order_total) FROM r_group WHERE order_key IN (SELECT order_key FROM k)
          UNION ALL SELECT 'paybacks', count(*), sum(amount) FROM r_payback WHERE payback_id IN (SELECT order_key FROM k)""")
def _(r):
    keys = r.group.filter("insurer_id = 4").select("order_key")
    tables = {"claims": (r.item, "order_key"), "groups": (r.group.withColumnRenamed("order_total", "amount"), "order_key"), "paybacks": (r.payback, "payback_id")}
    parts = [f.agg(F.count(F.lit(1)).alias("rows"), F.sum("amount").alias("amount")).select(F.lit(n).alias("table_name"), "rows", "amount") for n, f in Q.slice_tables(tables, keys, "order_key").items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("extract_claim_group_customer", "group_code:s claim_code:s customer_name:s",
       """SELECT d.group_code, c.claim_code, u.c_name AS customer_name FROM r_payback_detail d LEFT JOIN r_payback_claim c ON c.payback_id=d.payback_id AND c.hospital_id=d.hospital_id
          LEFT JOIN r_import_detail i ON i.claim_code=c.claim_code LEFT JOIN customer u ON u.c_custkey=i.customer_id""")
def _(r):
    named = r.import_detail.join(r.t("customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name")), "customer_id", "left").select("claim_code", "customer_name", "group_type")
    sources = [named.filter("group_type <> 3").drop("group_type"), named.filter("group_type = 3").drop("group_type")]
    return Q.claim_group_customers(r.payback_detail, r.payback_claim, sources)


@query("dq_document_upload", "claim_code:s documents:i uploaded:i",
       """SELECT i.claim_code, count(d.kind) AS documents, coalesce(sum(CASE WHEN d.kind=24 THEN 1 ELSE 0 END),0) AS uploaded FROM r_bill_item i LEFT JOIN r_document d ON d.claim_code=i.claim_code GROUP BY i.claim_code""")
def _(r):
    return Q.document_uploads(r.bill_item, r.document.withColumn("is_uploaded", F.col("kind") == 24))


def backfill(r):
    documents = r.document.select(F.concat_ws("-", "claim_code", "kind").alias("document_id"), "claim_code", F.col("happened_at").alias("filed_at"), F.lit(False).alias("is_uploaded"))
    claims = [r.import_detail.filter("group_type <> 3").select("claim_code"), r.import_detail.filter("group_type IN (3, 4)").select("claim_code")]
    return Q.document_backfill(claims, documents, r.item.filter("rf = 'R'"), "1999-01-01 00:00:00")


DUE_SQL = """due AS MATERIALIZED (SELECT DISTINCT claim_code FROM r_document d WHERE happened_at > TIMESTAMP '1998-12-02 00:00:00' AND happened_at <= TIMESTAMP '1999-01-01 00:00:00'
    AND NOT EXISTS (SELECT 1 FROM r_item i WHERE i.claim_code=d.claim_code AND rf='R')) ;; """


@query("document_backfill", "document_id:s claim_code:s status_id:i updated_at:t",
       DUE_SQL + "SELECT claim_code || '-' || kind AS document_id, claim_code, 2 AS status_id, TIMESTAMP '1999-01-01 00:00:00' AS updated_at FROM r_document JOIN due USING (claim_code)")
def _(r):
    return backfill(r)["register"]


@query("document_backfill_flags", "document_id:s is_uploaded:i", DUE_SQL + "SELECT d.claim_code || '-' || kind AS document_id, CASE WHEN due.claim_code IS NULL THEN 0 ELSE 1 END AS is_uploaded FROM r_document d LEFT JOIN due ON due.claim_code=d.claim_code")
def _(r):
    return backfill(r)["documents"]


@query("repair_by_join", "payback_id:i group_type:i",
       "SELECT p.payback_id, coalesce(s.g, p.group_type) AS group_type FROM r_payback p LEFT JOIN (SELECT order_key, CASE WHEN insurer_id=4 THEN 11 END AS g FROM r_group WHERE group_type=6) s ON s.order_key=p.payback_id")
def _(r):
    source = r.group.filter("group_type = 6").select(F.col("order_key").alias("payback_id"), F.when(F.col("insurer_id") == 4, 11).alias("group_type"))
    return Q.repair_by_join(r.payback, source, "payback_id", "group_type")


@query("log_search", "log_id:i message:s stamp:s",
       """SELECT event_id AS log_id, event_type || ' ' || props AS message, strftime(ts,'%d %m %Y %H:%M') AS stamp FROM events WHERE ts >= '2024-01-05' AND ts < '2024-01-21' AND contains(event_type || ' ' || props, 'error {"k": 6')""")
def _(r):
    log = r.t("events").select(F.col("event_id").alias("log_id"), F.col("ts").alias("logged_at"), F.concat_ws(" ", "event_type", "props").alias("message"))
    return Q.log_search(log, "2024-01-05", "2024-01-20", 'error {"k": 6')


# columns of the given tables that can hold a number, by how they are compared; the query finds them in the schemas
NUMBERS = {
    "region": "r_regionkey", "nation": "n_nationkey n_regionkey", "customer": "c_custkey c_nationkey c_acctbal", "supplier": "s_suppkey s_nationkey s_acctbal",
    "part": "p_partkey p_size p_retailprice", "orders": "o_orderkey o_custkey o_totalprice", "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax",
    "events": "event_id user_id value", "documents": "doc_id n_chars", "embeddings": "vec_id label", "pages": "page_id", "benchmark": "item_id", "labels": "doc_id quality toxic", "conversations": "conv_id turn"}
TEXTS = {
    "region": "r_name", "nation": "n_name", "customer": "c_name c_mktsegment", "supplier": "s_name", "part": "p_name p_brand p_type", "orders": "o_orderstatus o_orderpriority",
    "lineitem": "l_returnflag l_linestatus", "events": "event_type props", "documents": "text lang source", "pages": "url html", "benchmark": "text", "conversations": "role text"}


def find_sql(value, *kinds):
    test = {id(NUMBERS): f"= {value}", id(TEXTS): f"= '{value}'"}
    return " UNION ALL ".join(f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS hits FROM {t} WHERE {c} {test[id(kind)]} HAVING count(*)>0" for kind in kinds for t, cs in kind.items() for c in cs.split())


@query("find_value_in_tables", "table_name:s column_name:s hits:i", find_sql("17", NUMBERS, TEXTS))
def _(r):
    return Q.find_value({t: r.t(t) for t in NUMBERS}, "17")


@query("find_text_in_tables", "table_name:s column_name:s hits:i", find_sql("en", TEXTS) + " UNION ALL " + find_sql("user", TEXTS))
def _(r):
    return Q.find_value({t: r.t(t) for t in NUMBERS}, "en").unionByName(Q.find_value({t: r.t(t) for t in NUMBERS}, "user"))
