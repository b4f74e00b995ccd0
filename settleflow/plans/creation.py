"""Creating pay-backs and assigning withdrawal rounds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settleflow.functions.codes import running_codes
from settleflow.functions.scalars import flag, money
from settleflow.operators.numbering import global_row_number, join_null_safe, round_number
from settleflow.operators.state import insert_rows, set_where_key
from settleflow.sources.work import stored

# fixed value: user-visible text
DUPLICATE = "ClaimHeaderGroupCode Data Duplicate"
# fixed values: code prefixes and widths
GROUP_PREFIX, HEAD_PREFIX, WIDTH = "CPBG", "CPBH", 6
# fixed values: branch that pays compensations, payment type where none is known, kinds with withdrawals and with a hospital report
COMPENSATE_BRANCH, DEFAULT_PAYMENT = 70, 3
ONLINE_KINDS, HOSPITAL_KINDS = (2, 6, 7), (4, 8)


def accident_kind(kind: int) -> Column:
    """Claim-group type of an accident claim; online claims count as online unless death was asked for."""
    online = F.coalesce(F.col("is_online"), F.lit(0)) == 1
    offline = kind if kind in (3, 4) else None
    return F.when(online, 6 if kind == 6 else 2).otherwise(F.lit(offline).cast("int"))


def compensate_claims(claims: DataFrame) -> DataFrame:
    """Compensations: what remains of each claim is paid by one fixed branch."""
    # a value per row: joins on columns that are all constants would have no key left
    branch = F.when(F.length("group_code") > 0, COMPENSATE_BRANCH)
    return claims.withColumns({"product": F.lit(2), "branch_id": branch, "payment_type": F.lit(DEFAULT_PAYMENT)})


def misc_claims(claims: DataFrame, payments: DataFrame) -> DataFrame:
    """Miscellaneous claims, one row for each way they are paid (``payments``: misc_id, payment_type)."""
    kinds = payments.select("misc_id", "payment_type").distinct()
    return claims.drop("payment_type").join(kinds, "misc_id", "left").withColumn("payment_type", F.coalesce("payment_type", F.lit(DEFAULT_PAYMENT)))


def create_payback(codes: DataFrame, claims: DataFrame, existing: DataFrame, kind: int, own_company: int, own_since: str,
                   as_of: dt.date, counters: DataFrame, online_items: DataFrame | None = None, product: int | None = None) -> dict[str, DataFrame]:
    """Pay-backs, their details per claim group and the linked claims for a set of group codes.

    ``product`` 2 with kind 5 are compensations (see ``compensate_claims``), products 4 and 11 with kinds 7 and 8
    miscellaneous claims (``misc_claims``); otherwise ``claims`` are health and accident claims together.

    Groups of the own company from ``own_since`` on go to group 2 with status 5, everything else, and all
    compensations and miscellaneous claims, to group 1 with status 2. Details split by hospital except for online claims
    (kind 2); miscellaneous ones also by payment type. A detail's totals are those of its rows; of a compensation those of its claim
    group, of a miscellaneous one those of its group and hospital. Claims of kinds 2, 6 and 7 must be known online when
    ``online_items`` is given. If any code has an active pay-back already, nothing is created and ``check`` says why.

    Every result hangs on one mapping from a detail's key to its code and its pay-back's code.
    """
    repeated = existing.join(codes.select("group_code"), "group_code", "left_semi").agg(F.count(F.lit(1)).alias("n"))
    check = repeated.select(flag(F.col("n") == 0).alias("is_result"), F.when(F.col("n") > 0, DUPLICATE).alias("message"), F.col("n").alias("repeated"))
    work = claims.join(codes.select("group_code"), "group_code", "left_semi").withColumn("_n", repeated.scalar()).filter("_n = 0").drop("_n")
    compensate, misc = product == 2 and kind == 5, product in (4, 11) and kind in (7, 8)
    if compensate or misc:
        work = work.withColumns({"group_type": F.lit(kind), "pay_group": F.lit(1)})
    else:
        own = (F.col("insurer_id") == own_company) & (F.col("created_at") >= F.lit(own_since).cast("timestamp_ntz"))
        work = work.withColumns({"group_type": F.when(F.col("product") == 3, accident_kind(kind)).otherwise(F.lit(kind)),
                                 "pay_group": F.when(own, 2).otherwise(1), "payment_type": F.lit(None).cast("int")})
    work = work.withColumn("amount", F.coalesce("amount", F.lit(0)))
    # the claims are worked out once; sums, details and links read them
    work = stored(work.select("group_code", "claim_code", "group_type", "branch_id", "pay_group", "product", "insurer_id", "payment_type", "hospital_id", "amount", "online_code"), "claims")
    bundle = ["group_type", "branch_id", "pay_group"]
    sums = work.groupBy(*bundle).agg(money(F.sum("amount")).alias("amount")).withColumn("prefix", F.lit(GROUP_PREFIX))
    coded, group_counters = running_codes(sums, "prefix", bundle, WIDTH, as_of, counters, "payback_code")
    paybacks = coded.withColumn("status_id", F.when(F.col("pay_group") == 2, 5).otherwise(2)).drop("prefix")
    place = [] if kind == 2 else ["hospital_id"]
    head = ["group_code", *bundle, "product", "insurer_id", "payment_type", *place]
    totals = [F.count("claim_code").alias("item_count"), money(F.sum("amount")).alias("amount"), F.max("online_code").alias("online_code")]
    if compensate or misc:
        per = ["group_code"] if compensate else ["group_code", "hospital_id"]
        details = join_null_safe(work.select(*head).distinct(), work.groupBy(*per).agg(*totals), per)
    else:
        details = work.groupBy(*head).agg(*totals)
    headed, head_counters = running_codes(details.withColumn("prefix", F.lit(HEAD_PREFIX)), "prefix", head, WIDTH, as_of, counters, "detail_code")
    headed = join_null_safe(headed.drop("prefix"), paybacks.select(*bundle, "payback_code"), bundle)
    mapping = headed.select(*head, "detail_code", "payback_code")
    linked = work if online_items is None or kind not in ONLINE_KINDS else work.join(online_items.select("claim_code"), "claim_code", "left_semi")
    links = join_null_safe(linked, mapping, head).select(
        "detail_code", "claim_code", F.col("amount").alias("claim_pay"), "hospital_id")
    return {"check": check, "paybacks": paybacks, "details": headed, "claims": links, "mapping": mapping,
            "counters": group_counters.unionByName(head_counters)}


def hospital_report(mapping: DataFrame, claims: DataFrame, hospitals: DataFrame, customers: DataFrame, kind: int, sent_at: str) -> DataFrame:
    """Rows of the hospital report that go with new pay-backs of kinds 4 and 8, one per claim; none for other kinds.

    ``mapping`` comes from ``create_payback``. Claims of unknown hospitals or customers have no row.
    """
    groups = mapping.select("group_code").distinct().filter(F.lit(kind in HOSPITAL_KINDS))
    rows = claims.select("group_code", "claim_code", "hospital_id", "customer_id", "amount").join(groups, "group_code", "left_semi")
    return (rows.join(hospitals.select("hospital_id", "hospital_name"), "hospital_id").join(customers.select("customer_id", "customer_name"), "customer_id")
            .select("group_code", "hospital_name", "claim_code", "customer_name", "amount", F.lit(sent_at).cast("timestamp_ntz").alias("sent_at"),
                    F.lit(None).cast("timestamp_ntz").alias("paid_at"), F.lit(kind).alias("group_type"), F.lit(True).alias("is_active")))


def withdrawal_rounds(history: DataFrame, claims: DataFrame, online_items: DataFrame, created_at: str, rounds: int = 5) -> DataFrame:
    """Withdrawal rows after a pay-back: earlier rows of the claims end, new ones go round 1..rounds.

    ``history``: claim_code, amount, round_no, created_at, is_active. Counting goes on after the round
    of the newest row (the highest one when several share its time), in claim-code order.
    """
    last = history.agg(F.max(F.struct("created_at", "round_no")).alias("m")).select(F.col("m.round_no").alias("round_no"))
    known = claims.join(online_items.select("claim_code"), "claim_code", "left_semi").select("claim_code", "amount")
    fresh = global_row_number(known, ["claim_code"], "_n").withColumn("_last", last.scalar()).select(
        "claim_code", "amount", round_number(F.col("_n"), F.col("_last"), rounds).alias("round_no"),
        F.lit(created_at).cast("timestamp_ntz").alias("created_at"), F.lit(True).alias("is_active"))
    return insert_rows(set_where_key(history, claims, ["claim_code"], is_active=F.lit(False)), fresh)
