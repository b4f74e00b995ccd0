"""Registry of the runnable queries, each with its output columns and a check in plain SQL.

``columns`` spells the output once for both sides, as ``name:type`` words with the types
``s`` text, ``i`` whole number, ``d`` double, ``t`` timestamp as text and ``y`` date as text.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from settleflow.sources.roles import Roles

REGISTRY: dict[str, "Query"] = {}


@dataclass(frozen=True)
class Query:
    name: str
    columns: list[tuple[str, str]]
    build: Callable[[Roles], DataFrame]
    sql: str | None

    def spark(self, session: SparkSession, folder: str) -> DataFrame:
        frame = self.build(Roles(session, folder))
        return frame.select(*[_spark_cast(c, k).alias(c) for c, k in self.columns])

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        out = ", ".join(f"{_sql_cast(c, k)} AS {c}" for c, k in self.columns)
        return f"{_with(self.sql)} SELECT {out} FROM answer"


def query(name: str, columns: str, sql: str | None = None):
    spec = [tuple(word.split(":")) for word in columns.split()]

    def register(build: Callable[[Roles], DataFrame]):
        assert name not in REGISTRY, name
        REGISTRY[name] = Query(name, spec, build, sql)
        return build

    return register


def _spark_cast(name: str, kind: str):
    c = F.col(name)
    if kind == "t":
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    if kind == "y":
        return F.date_format(c, "yyyy-MM-dd")
    return c.cast({"s": "string", "i": "long", "d": "double"}[kind])


def _sql_cast(name: str, kind: str) -> str:
    if kind == "t":
        return f"strftime({name}, '%Y-%m-%d %H:%M:%S')"
    if kind == "y":
        return f"strftime({name}, '%Y-%m-%d')"
    return f"CAST({name} AS {({'s': 'VARCHAR', 'i': 'BIGINT', 'd': 'DOUBLE'})[kind]})"


# role tables of sources.roles, written again in SQL for the checks
ROLE_SQL = {
    "r_item": """SELECT l_orderkey AS order_key, l_linenumber AS line_no,
        CAST(sum(CAST(l_extendedprice AS DECIMAL(16,2))) AS DECIMAL(16,2)) AS amount,
        min(l_suppkey) AS hospital_id, min(l_partkey) AS product_id, min(l_returnflag) AS rf, min(l_linestatus) AS ls,
        min(l_shipdate) AS happened_at, l_orderkey*100+l_linenumber AS detail_id,
        printf('CL%08d%02d', l_orderkey, l_linenumber) AS claim_code
        FROM lineitem GROUP BY l_orderkey, l_linenumber""",
    "r_group": """SELECT o_orderkey AS order_key, o_custkey AS customer_id,
        'BU' || substr(o_orderpriority,1,1) || CASE WHEN o_custkey%2=0 THEN 'H' ELSE 'B' END || '-' || CAST(100+o_custkey%900 AS VARCHAR)
          || '-' || printf('%08d', o_orderkey) || '-' || CAST(o_orderkey%2 AS VARCHAR) AS group_code,
        CAST(substr(o_orderpriority,1,1) AS INT)+1 AS group_type,
        CASE WHEN o_custkey%2=0 THEN '1000' ELSE '2000' END AS claim_type_code,
        CASE o_orderstatus WHEN 'O' THEN 2 WHEN 'F' THEN 3 ELSE 4 END AS status_id,
        CAST(o_custkey%10+1 AS INT) AS insurer_id, CAST(o_custkey%25 AS INT) AS branch_id,
        CAST(o_totalprice AS DECIMAL(16,2)) AS order_total, o_orderdate AS created_at FROM orders""",
    "r_group_total": """SELECT order_key, count(*) AS item_count, CAST(sum(amount) AS DECIMAL(16,2)) AS item_amount
        FROM r_item GROUP BY order_key""",
    "r_imported": """SELECT g.order_key AS import_id, customer_id, group_code, group_type, claim_type_code, status_id, insurer_id,
        branch_id, created_at, CAST(created_at AS DATE) AS billing_date, coalesce(item_count,0) AS item_count,
        CAST(CASE WHEN status_id=4 THEN order_total ELSE coalesce(item_amount,0) END AS DECIMAL(16,2)) AS total_amount,
        order_total >= 1000 AS is_active FROM r_group g LEFT JOIN r_group_total t ON g.order_key=t.order_key""",
    "r_import_detail": """SELECT i.order_key AS import_id, line_no, amount AS pay_total, hospital_id, product_id, rf, ls, happened_at,
        detail_id, claim_code, group_code, group_type, claim_type_code, status_id, insurer_id, branch_id, customer_id, created_at,
        order_total >= 1000 AS is_active FROM r_item i JOIN r_group g ON i.order_key=g.order_key""",
    "r_prior_result": """SELECT detail_id, claim_code, order_key AS import_id, CAST(amount*0.10 AS DECIMAL(16,2)) AS cover_amount,
        CASE WHEN rf='R' THEN 1 ELSE 0 END AS is_manual_npl, ls='O' AS is_active FROM r_item WHERE rf IN ('A','R')""",
    "r_cover_log": """SELECT l_orderkey*100+l_linenumber AS detail_id,
        CAST(CAST(l_extendedprice AS DECIMAL(16,2))*0.05 AS DECIMAL(16,2)) AS cover_amount,
        CASE WHEN l_returnflag='R' THEN 1 ELSE 0 END AS is_manual_npl, l_shipdate AS created_at,
        l_partkey AS tie1, l_suppkey AS tie2, l_extendedprice AS tie3, l_quantity AS tie4 FROM lineitem""",
    "r_online_pay": """SELECT l_orderkey AS online_id, CAST(l_extendedprice AS DECIMAL(16,2)) AS amount,
        CASE WHEN l_linestatus='F' THEN 4 ELSE 2 END AS payment_status_id FROM lineitem""",
    "r_npl": """SELECT l_orderkey AS online_id, CAST(CAST(l_extendedprice AS DECIMAL(16,2))*0.10 AS DECIMAL(16,2)) AS amount
        FROM lineitem WHERE l_returnflag='R'""",
    "r_bill_item": """SELECT 'BQI' || substr(d.claim_code,3) AS item_code,
        printf('BQG%02d', insurer_id) || CASE WHEN claim_type_code='1000' THEN 'H' ELSE 'B' END || '-' || strftime(created_at,'%Y%m%d') AS bill_code,
        d.detail_id, d.import_id, d.claim_code, group_code, group_type, claim_type_code, insurer_id, branch_id, customer_id, hospital_id,
        product_id, rf, ls, line_no, happened_at, created_at, CAST(created_at AS DATE) AS billing_date, pay_total,
        coalesce(p.cover_amount, 0) AS cover_amount,
        CAST(pay_total - coalesce(p.cover_amount,0) AS DECIMAL(16,2)) AS amount_total
        FROM r_import_detail d LEFT JOIN (SELECT * FROM r_prior_result WHERE is_active) p ON d.detail_id=p.detail_id
        WHERE status_id=3 AND d.is_active""",
    "r_bill": """SELECT bill_code, insurer_id, claim_type_code, billing_date, count(*) AS item_count,
        CAST(sum(pay_total) AS DECIMAL(16,2)) AS pay_total, CAST(sum(cover_amount) AS DECIMAL(16,2)) AS cover_amount,
        CAST(sum(amount_total) AS DECIMAL(16,2)) AS total_amount, min(group_type) AS group_type
        FROM r_bill_item GROUP BY bill_code, insurer_id, claim_type_code, billing_date""",
    "r_reject": """SELECT item_code, printf('TCB%04d', insurer_id) AS tmp_code,
        CASE WHEN line_no%2=1 THEN amount_total ELSE CAST(amount_total*0.50 AS DECIMAL(16,2)) END AS rejected_amount,
        'reject line ' || CAST(line_no AS VARCHAR) AS rejected_remark FROM r_bill_item WHERE rf='N' AND ls='F'""",
    "r_payback": """SELECT import_id AS payback_id, printf('CPBG%08d', import_id) AS payback_code, total_amount AS amount, item_count,
        group_code, group_type, branch_id, insurer_id, CASE WHEN status_id<>2 THEN customer_id END AS transfer_id, customer_id, status_id, created_at
        FROM r_imported WHERE is_active""",
    "r_payback_claim": """SELECT order_key AS payback_id, claim_code, hospital_id, product_id, amount AS claim_pay, rf, ls, happened_at FROM r_item""",
    "r_payback_detail": """SELECT printf('CPBD%08d-%d', p.order_key, p.hospital_id) AS detail_code, p.order_key AS payback_id, group_code,
        group_type, insurer_id, branch_id, p.hospital_id, p.item_count, p.amount, CASE WHEN status_id<>2 THEN customer_id END AS transfer_id,
        status_id, created_at
        FROM (SELECT order_key, hospital_id, count(*) AS item_count, CAST(sum(amount) AS DECIMAL(16,2)) AS amount FROM r_item
              GROUP BY order_key, hospital_id) p JOIN r_group g ON p.order_key=g.order_key WHERE order_total >= 1000""",
    "r_transfer": """SELECT transfer_id, printf('CPBT%08d', transfer_id) AS transfer_code, amount, payback_count, created_at,
        CAST(transfer_id%5+2 AS INT) AS group_type, CASE WHEN last_status=3 THEN 3 ELSE 2 END AS status_id,
        CASE transfer_id%5 WHEN 0 THEN 7 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 6 END AS oop_status,
        CASE WHEN last_status=3 THEN amount END AS transfer_amount
        FROM (SELECT transfer_id, CAST(sum(amount) AS DECIMAL(16,2)) AS amount, count(*) AS payback_count, min(created_at) AS created_at,
              max(status_id) AS last_status FROM r_payback WHERE transfer_id IS NOT NULL GROUP BY transfer_id)""",
    "r_subgroup_detail": """SELECT CAST(floor(transfer_id/2) AS BIGINT)*10 + payback_id%3 AS subgroup_id, payback_id, transfer_id, amount,
        status_id, created_at FROM r_payback WHERE transfer_id IS NOT NULL""",
    "r_subgroup": """SELECT subgroup_id, printf('HCG%08d', subgroup_id) AS subgroup_code, amount, item_count, last_at,
        CASE WHEN low_status=3 THEN 0 ELSE 1 END AS is_paid, CAST(item_count%2 AS INT) AS is_mailed
        FROM (SELECT subgroup_id, CAST(sum(amount) AS DECIMAL(16,2)) AS amount, count(*) AS item_count, min(status_id) AS low_status,
              max(created_at) AS last_at FROM r_subgroup_detail GROUP BY subgroup_id)""",
    "r_policy": """SELECT o_custkey AS app_id, CAST(o_orderkey%5+9601 AS INT) AS policy_type_id, 'POL' || CAST(o_orderkey AS VARCHAR) AS detail,
        o_orderdate AS created_at, o_orderkey AS policy_key FROM orders""",
    "r_document": """SELECT claim_code, order_key, happened_at, 24 AS kind FROM r_item WHERE ls='F'
        UNION ALL SELECT claim_code, order_key, happened_at, 134 AS kind FROM r_item WHERE line_no%2=0 OR rf='N'""",
    "r_hospital": """SELECT s_suppkey AS hospital_id, printf('%012d', s_suppkey) AS hospital_code, s_name AS hospital_name,
        s_nationkey AS nation_id, CAST(s_acctbal AS DECIMAL(16,2)) AS balance FROM supplier""",
    "r_branch": "SELECT n_nationkey AS branch_id, n_name AS branch, n_regionkey AS region_id FROM nation",
    "r_transaction": """SELECT user_id AS subgroup_id, ts AS created_at, event_id,
        CASE event_type WHEN 'error' THEN 4 WHEN 'purchase' THEN 5 WHEN 'signup' THEN 6 WHEN 'click' THEN 2 ELSE 1 END AS status_id
        FROM events""",
}


# the wide columns of a claim that the given tables stand for, by name: the expression over r_import_detail, and the group types that lack it
WIDE_SQL = {
    "province": ("'P' || (branch_id % 7)", "6"), "identity_card": ("'ID' || customer_id", ""), "customer_name": ("c_name", ""), "happened_at": ("happened_at", ""),
    "pay": ("pay_total", ""), "hospital_id": ("d.hospital_id", ""), "hospital_name": ("hospital_name", ""), "date_in": ("happened_at", ""),
    "date_out": ("happened_at + to_days(CAST(line_no AS INT))", ""), "application_code": ("'AP' || customer_id", ""), "product_id": ("product_id", "3"),
    "product_name": ("p_name", ""), "noticed_at": ("created_at", "3"), "cover_from": ("CAST(created_at AS DATE)", "3"), "admit_code": (
        "CASE WHEN d.group_type=3 THEN CASE line_no WHEN 1 THEN '4001' WHEN 2 THEN '4009' WHEN 3 THEN '4010' WHEN 4 THEN '4006' ELSE '4002' END END", "6"),
    "claim_type": ("CASE WHEN d.group_type IN (3,6) THEN CASE WHEN claim_type_code='1000' THEN '%(hospital)s' ELSE '%(customer)s' END ELSE 'T' || claim_type_code END", ""),
    "icd10_code": ("'I' || (product_id % 100)", "6"), "icd10": ("'diagnosis ' || (product_id % 100)", "6"), "ipd_count": ("line_no", "3 6"), "icu_count": ("line_no % 2", "3"),
    "net": ("pay_total", "3"), "compensate_include": ("CASE WHEN d.group_type IN (4,6) THEN 0 ELSE CAST(line_no AS DECIMAL(16,2)) END", "3"), "gross_total": ("pay_total", ""),
    "discount": ("CASE WHEN d.group_type=4 THEN 0 ELSE CAST(line_no % 3 AS DECIMAL(16,2)) END", "6"), "pay_total": ("pay_total", ""),
    "school_name": ("'S' || branch_id", "2 4 5 6"), "customer_detail_code": ("'CD' || customer_id", "2 4 5 6"), "school_level": ("'L' || line_no", "2 4 5 6"),
    "accident": ("'cause ' || (d.hospital_id % 10)", "2 4 5 6"), "chief_complaint": ("'complaint ' || (product_id % 7)", ""), "organ": ("0", "2 4 5 6"),
    "compensate_in": ("CAST(line_no AS DECIMAL(16,2))", "2 4 5 6"), "compensate_out": ("CAST(line_no + 1 AS DECIMAL(16,2))", "2 4 5 6"),
    "amount_pay": ("pay_total", "2 4 5"), "amount_dead": ("CASE WHEN line_no=4 THEN pay_total ELSE 0 END", "2 4 5 6"), "remark": ("'remark ' || rf", "2 4 5"), "branch_id": ("branch_id", ""),
}


def wide_sql(texts: dict[str, str], **own: str) -> str:
    """Select list of the wide columns; ``own`` replaces expressions."""
    out = []
    for name, (expression, lacking) in WIDE_SQL.items():
        value = own.get(name, expression % texts if name == "claim_type" else expression)
        out.append(f"CASE WHEN d.group_type NOT IN ({', '.join(lacking.split())}) THEN {value} END AS {name}" if lacking else f"{value} AS {name}")
    return ", ".join(out)


def _with(body: str) -> str:
    """``WITH`` clause holding the role tables the body needs, in order, and the body as ``answer``.

    A body may bring further named parts of its own, as ``part AS (…), … ; final select``.
    """
    parts, _, final = body.rpartition(";;")
    needed: set[str] = set()

    def need(text: str) -> None:
        for name in re.findall(r"\br_[a-z_]+\b", text):
            if name in ROLE_SQL and name not in needed:
                needed.add(name)
                need(ROLE_SQL[name])

    need(body)
    # each role is worked out once, however often the body and other roles name it
    roles = [f"{n} AS MATERIALIZED ({s})" for n, s in ROLE_SQL.items() if n in needed]
    own = [parts.strip().rstrip(",")] if parts.strip() else []
    # recursive is needed by one check and harmless for the others
    return "WITH RECURSIVE " + ", ".join([*roles, *own, f"answer AS ({final})"])
