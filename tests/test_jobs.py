"""Rules of the jobs on literal frames, invariants on the given tables, empty inputs."""

import datetime as dt
import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from settleflow.catalogue import REGISTRY, billing_jobs, importing_jobs, payback_jobs
from settleflow.functions import messages as M
from settleflow.plans import billing, columns, creation, importing, intake, listings, quality, results, transfers
from settleflow.sources.roles import Roles

NO_COUNTERS = "prefix string, year string, month string, running long"


def pairs(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=str)


@pytest.fixture(scope="module")
def roles(spark, small):
    return Roles(spark, small)


# ---- decisions about unclear semantics

def test_unions_go_by_name(spark):
    columns = "group_code string, claim_code string, product_code string, admit_code string"
    a = spark.createDataFrame([("g1", "c1", "1000", "x")], columns)
    misc = spark.createDataFrame([("y", "Misc", "c2", "g2")], "admit_code string, product_code string, claim_code string, group_code string")
    out = importing.claims_of_sources(a, a.limit(0), a.limit(0), misc)
    assert pairs(out, "group_code", "product_code", "admit_code", "source") == [("g1", "1000", "x", "health"), ("g2", "Misc", "y", "misc")]


def test_dates_are_half_open(spark):
    groups = spark.createDataFrame([(1, "g", 2, 2, True, D(5), dt.datetime(2024, 1, 31, 23, 0)), (2, "h", 2, 2, True, D(5), dt.datetime(2024, 2, 1))],
                                   "import_id int, group_code string, group_type int, status_id int, is_active boolean, total_amount decimal(16,2), created_at timestamp_ntz")
    none = spark.createDataFrame([], "import_id int, detail_id int, claim_code string, pay_total decimal(16,2)")
    prior = spark.createDataFrame([], "detail_id int, cover_amount decimal(16,2), is_active boolean")
    log = spark.createDataFrame([], "detail_id int, cover_amount decimal(16,2), is_manual_npl int, created_at timestamp_ntz, tie1 int, tie2 int, tie3 int, tie4 int")
    pay = spark.createDataFrame([], "online_id int, amount decimal(16,2), payment_status_id int")
    out = billing.billing_reconcile(groups, none, prior, log, pay, pay.drop("payment_status_id"), "2024-01-01", "2024-01-31")
    assert pairs(out, "group_code", "finding") == [("g", M.AMOUNT_NOT_BILLED)]


def test_misc_groups_have_their_own_bill_group():
    assert billing.BILL_GROUP[6] == 3 and billing.BILL_GROUP[3] == 2 and billing.BILL_GROUP[5] == 1


def test_group_belongs_to_the_bill_of_its_first_claim(roles):
    out = billing_jobs.bills_of(roles)
    first = out["items"].groupBy("import_id").agg(F.min_by("bill_code", "row_no").alias("b"))
    wrong = out["imported"].filter("bill_code IS NOT NULL").join(first, "import_id").filter("bill_code <> b")
    assert wrong.count() == 0


def test_one_classification_of_results(spark):
    items = spark.createDataFrame([("a", D(100), D(90)), ("b", D(100), D(90)), ("c", D(100), D(90))], "item_code string, pay_total decimal(16,2), amount_total decimal(16,2)")
    rejects = spark.createDataFrame([("b", "t", D(40), "r"), ("c", "t", D(90), "r")], "item_code string, tmp_code string, rejected_amount decimal(16,2), rejected_remark string")
    out = results.classify(items, rejects)
    assert pairs(out, "item_code", "decision_id", "result_cover", "result_uncover", "payment") == [
        ("a", 2, D("100.00"), D("0.00"), D("90.00")), ("b", 3, D("60.00"), D("40.00"), D("50.00")), ("c", 4, D("10.00"), D("90.00"), D("90.00"))]


def test_progress_without_subgroups_is_unknown(spark):
    t = spark.createDataFrame([(1, 4, dt.datetime(2024, 1, 1), 2), (2, 4, dt.datetime(2024, 1, 1), 2), (3, 4, dt.datetime(2024, 1, 1), 2), (4, 4, dt.datetime(2024, 1, 1), 2)],
                              "transfer_id int, group_type int, created_at timestamp_ntz, status_id int")
    p = spark.createDataFrame([(2, 21), (2, 22), (3, 31), (4, 41)], "transfer_id int, subgroup_id int")
    s = spark.createDataFrame([(21, 1, 0), (22, 0, 0), (31, 1, 1), (41, 0, 0)], "subgroup_id int, is_mailed int, is_uploaded int")
    assert pairs(listings.list_transfers(t, p, s), "transfer_id", "mail_status", "upload_status") == [(1, None, None), (2, 2, 1), (3, 3, 3), (4, 1, 1)]


def test_document_rule(spark):
    claims = spark.createDataFrame([
        ("h2", "1000", "1000", "health"), ("h1", "1000", "1000", "health"), ("hn", "1000", "1000", "health"), ("b1", "2000", "1000", "health"), ("bn", "2000", "1000", "health"),
        ("p2", "1000", "2000", "accident"), ("p1", "1000", "2000", "accident"), ("c1", "1000", "2222", "compensate"), ("m0", "1000", "Misc", "misc")],
        "claim_code string, claim_type_code string, product_code string, source string")
    docs = spark.createDataFrame([("h2", 24), ("h2", 134), ("h1", 24), ("b1", 7), ("p2", 26), ("p2", 135), ("p1", 24), ("p1", 134), ("c1", 9)], "claim_code string, kind int")
    out = importing.document_state(claims, docs, importing.DOCUMENT_KINDS)
    assert dict(pairs(out, "claim_code", "doc_ok")) == {"h2": 1, "h1": 0, "hn": 0, "b1": 1, "bn": 0, "p2": 1, "p1": 0, "c1": 1, "m0": 1}


def test_repeated_policies_do_not_repeat_findings(spark):
    claims = spark.createDataFrame([("g", "c", 1, D(10), 2, 5)], "group_code string, claim_code string, online_id int, amount decimal(16,2), insurer_id int, app_id int")
    codes = spark.createDataFrame([("g",)], "group_code string")
    pay = spark.createDataFrame([(1, D(10), 4)], "online_id int, amount decimal(16,2), payment_status_id int")
    policies = spark.createDataFrame([(5, 9601), (5, 9602), (5, 9603)], "app_id int, policy_type_id int")
    people = spark.createDataFrame([(5, "3040")], "app_id int, state string")
    out = intake.validate_amount_pay(3, 2, claims, codes, pay, pay.drop("payment_status_id").limit(0), 1, policies, people)
    assert pairs(out, "group_code", "warning", "is_valid") == [("g", "", 1)]


def test_settlement_rules(spark):
    base = [(1, 2, 2, D(10)), (2, 3, 2, D(10)), (3, 2, 2, D(10)), (4, 2, 2, D(10)), (5, 2, 4, D(10))]
    t = spark.createDataFrame([(i, s, g, a, None, None) for i, s, g, a in base], "transfer_id int, status_id int, group_type int, amount decimal(16,2), transfer_amount decimal(16,2), oop_status int")
    noon, midnight = dt.datetime(2024, 1, 1, 12), dt.datetime(2024, 1, 1)
    s = spark.createDataFrame([(1, D(10), noon, 11), (2, D(10), noon, 11), (3, D(11), noon, 11), (4, D(10), midnight, 11), (5, D(10), noon, 51)],
                              "transfer_id int, paid_amount decimal(16,2), paid_at timestamp_ntz, subgroup_id int")
    pb = spark.createDataFrame([(i * 10, i, D(10), g, 3) for i, _, g, _ in base], "payback_id int, transfer_id int, amount decimal(16,2), group_type int, status_id int")
    cl = spark.createDataFrame([(i * 10, f"c{i}", D(10)) for i in range(1, 6)], "payback_id int, claim_code string, claim_pay decimal(16,2)")
    sg = spark.createDataFrame([(11, 0), (12, 0), (51, 0)], "subgroup_id int, is_paid int")
    sd = spark.createDataFrame([(11, 10, 1), (12, 10, 1), (51, 50, 5)], "subgroup_id int, payback_id int, transfer_id int")
    out = transfers.settle_transfers(s, t, pb, cl, sg, sd)
    assert dict(pairs(out["check"], "transfer_id", "message")) == {1: None, 2: M.ALREADY_TRANSFERRED, 3: M.TRANSFER_AMOUNT_WRONG, 4: M.TRANSFER_TIME_MISSING, 5: None}
    state = {r["transfer_id"]: (r["status_id"], r["oop_status"], r["transfer_amount"]) for r in out["transfers"].collect()}
    assert state[1] == (4, 6, D("10.00")) and state[5] == (2, 3, None) and state[3] == (2, None, None)
    assert dict(pairs(out["paybacks"], "payback_id", "status_id")) == {10: 4, 20: 3, 30: 3, 40: 3, 50: 3}


def test_lists_above_the_limit_are_refused_and_single_groups_merge(spark):
    lists = spark.createDataFrame([("L1", 1), ("L1", 2), ("L2", 3), ("L3", 4), ("L3", 5)], "list_id string, transfer_id int")
    details = spark.createDataFrame([(10, 1, D(30)), (20, 2, D(40)), (30, 3, D(500)), (40, 4, D(60)), (41, 4, D(60)), (50, 5, D(20))], "payback_id int, transfer_id int, amount decimal(16,2)")
    counters = spark.createDataFrame([], NO_COUNTERS)
    out = transfers.subgroups_by_ceiling(lists, details, 100, dt.date(2025, 1, 1), counters)
    assert pairs(out["refused"], "list_id", "message") == [("L2", M.ABOVE_LIMIT + "100.00")]
    assert pairs(out["subgroups"], "list_id", "group_no", "transfer_id", "amount", "item_count") == [
        ("L1", 1, None, D("70.00"), 2), ("L3", 1, 4, D("60.00"), 1), ("L3", 2, 4, D("60.00"), 1), ("L3", 2, 5, D("20.00"), 1)]
    assert out["details"].count() == 5


def test_payback_of_own_company_and_duplicates(spark):
    codes = spark.createDataFrame([("g1",), ("g2",)], "group_code string")
    claims = spark.createDataFrame([("g1", "c1", 2, 7, 1, dt.datetime(2024, 1, 1), D(10), 3, 1, "o"), ("g2", "c2", 2, 7, 1, dt.datetime(2023, 1, 1), D(20), 3, 1, "o")],
        "group_code string, claim_code string, product int, branch_id int, insurer_id int, created_at timestamp_ntz, amount decimal(16,2), hospital_id int, is_online int, online_code string")
    counters = spark.createDataFrame([], NO_COUNTERS)
    out = creation.create_payback(codes, claims, codes.limit(0), 3, 1, "2024-01-01", dt.date(2025, 1, 1), counters)
    assert pairs(out["paybacks"], "pay_group", "amount", "status_id") == [(1, D("20.00"), 2), (2, D("10.00"), 5)]
    again = creation.create_payback(codes, claims, codes.limit(1), 3, 1, "2024-01-01", dt.date(2025, 1, 1), counters)
    assert again["paybacks"].count() == 0 and again["check"].first()["is_result"] == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_requests_that_share_paybacks_are_served_in_order(spark, seed):
    """Against serving one request after another; chains of requests hang on each other."""
    rng = random.Random(seed)
    bundled = {p for p in range(60) if p % 13 == 0}
    listed = [(q, str(p)) for q in range(40) for p in rng.choices(range(60), k=rng.randint(1, 4))]
    listed += [(q, f" {q} ") for q in range(60, 70)] + [(q, str(q + 1)) for q in range(60, 70)]  # one long chain
    listed += [(80, "7"), (80, " "), (81, "unknown"), (82, None)]
    taken, want = set(), {}
    for q in sorted({q for q, _ in listed}):
        mine = [p for r, p in listed if r == q]
        known = {int(p) for p in mine if p and p.strip().isdigit() and int(p) < 75}
        if any(not p or not p.strip() for p in mine):
            want[q] = M.UNKNOWN_ENTRY
        elif known & (bundled | taken):
            want[q] = M.PARTLY_TRANSFERRED
        else:
            want[q] = None
            taken |= known
    requests = spark.createDataFrame([(q, 2, p) for q, p in listed], "request_id long, group_type int, payback_ref string")
    paybacks = spark.createDataFrame([(p, D(p), 5 if p in bundled else None, 2) for p in range(75)], "payback_id long, amount decimal(16,2), transfer_id long, status_id int")
    out = transfers.create_transfers(requests, paybacks, dt.date(2025, 1, 1), spark.createDataFrame([], NO_COUNTERS))
    assert dict(pairs(out["check"], "request_id", "message")) == want
    code = dict(pairs(out["transfers"], "request_id", "transfer_code"))
    assert set(code) == {q for q, m in want.items() if m is None} and len(set(code.values())) == len(code)
    marked = {p: c for p, c in pairs(out["paybacks"], "payback_id", "transfer_code") if c}
    assert set(marked) == taken


def test_unknown_transfers_are_refused_not_lost(spark):
    t = spark.createDataFrame([(1, 2, 2, D(10), None, None)], "transfer_id int, status_id int, group_type int, amount decimal(16,2), transfer_amount decimal(16,2), oop_status int")
    s = spark.createDataFrame([(99, D(10), dt.datetime(2024, 1, 1, 12), 11)], "transfer_id int, paid_amount decimal(16,2), paid_at timestamp_ntz, subgroup_id int")
    pb = spark.createDataFrame([(10, 1, D(10), 2, 3)], "payback_id int, transfer_id int, amount decimal(16,2), group_type int, status_id int")
    cl = spark.createDataFrame([(10, "c", D(10))], "payback_id int, claim_code string, claim_pay decimal(16,2)")
    sg, sd = spark.createDataFrame([(11, 0)], "subgroup_id int, is_paid int"), spark.createDataFrame([(11, 10, 1)], "subgroup_id int, payback_id int, transfer_id int")
    out = transfers.settle_transfers(s, t, pb, cl, sg, sd)
    assert pairs(out["check"], "transfer_id", "message") == [(99, M.UNKNOWN_ENTRY)] and out["transfers"].first()["status_id"] == 2


def test_misc_details_split_by_payment_type(spark):
    """A claim paid in two ways has a row, and a detail, for each; one without a known way has the default."""
    rows = spark.createDataFrame([("g", "c1", 1, 11, 5, 3, D(10), 7, "o"), ("g", "c2", 2, 11, 5, 3, D(20), 7, "p")],
                                 "group_code string, claim_code string, misc_id int, product int, branch_id int, insurer_id int, amount decimal(16,2), hospital_id int, online_code string")
    work = creation.misc_claims(rows, spark.createDataFrame([(1, 1), (1, 2), (1, 2)], "misc_id int, payment_type int"))
    out = creation.create_payback(rows.select("group_code"), work, rows.limit(0), 7, 1, "2024-01-01", dt.date(2025, 1, 1), spark.createDataFrame([], NO_COUNTERS), product=11)
    assert pairs(out["details"], "payment_type", "item_count", "amount") == [(1, 3, D("40.00")), (2, 3, D("40.00")), (3, 3, D("40.00"))]
    assert pairs(out["claims"].join(out["details"].select("detail_code", "payment_type"), "detail_code"), "claim_code", "payment_type") == [("c1", 1), ("c1", 2), ("c2", 3)]
    assert out["mapping"].select("detail_code").distinct().count() == 3


def test_wide_rows_have_every_column_for_every_source(spark):
    claims = spark.createDataFrame([(s, "1000", "4006", D(9), D(5)) for s in ("health", "accident", "compensate", "misc")],
                                   "source string, claim_type_code string, admit_code string, pay decimal(16,2), pay_total decimal(16,2)")
    out = claims.select("source", *columns.claim_columns(claims))
    assert out.columns == ["source", *columns.CLAIM] and len(columns.CLAIM) == 39
    assert dict(out.dtypes) == {"source": "string", **columns.CLAIM}
    rows = {r["source"]: r for r in out.collect()}
    assert rows["misc"]["net"] == rows["misc"]["amount_pay"] == D("9.00") and rows["misc"]["admit_code"] is None and rows["misc"]["claim_type"] == M.HOSPITAL_CLAIM
    assert rows["compensate"]["net"] == D("5.00") and rows["compensate"]["discount"] == D("0.00")
    assert rows["accident"]["organ"] == D("0.00") and rows["accident"]["net"] is None and rows["accident"]["claim_type"] == M.CUSTOMER_CLAIM
    assert [len(columns.EXPORT), len(columns.ACCIDENT_VIEW), len(columns.MISC_VIEW), len(columns.HEALTH_VIEW)] == [46, 24, 30, 47]


@pytest.mark.parametrize("name,most", [("intake_candidates", 3), ("result_preview", 12)])
def test_jobs_read_their_tables_in_few_scans(spark, small, name, most):
    plan = REGISTRY[name].spark(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert 0 < plan.count("FileScan parquet [l_") <= most


# ---- invariants on the given tables

def test_bills_add_up_and_codes_are_unique(roles):
    out = billing_jobs.bills_of(roles)
    items, bills = out["items"], out["bills"]
    assert items.select("item_code").distinct().count() == items.count()
    assert bills.select("bill_code").distinct().count() == bills.count()
    sums = items.groupBy("bill_code").agg(F.sum("amount_total").alias("s"), F.count(F.lit(1)).alias("n"))
    assert sums.join(bills, "bill_code").filter("s <> total_amount OR n <> item_count").count() == 0
    assert bills.filter("is_sftp = 0 AND item_count > 20").count() == 0
    numbers = sorted(int(r[0][-6:]) for r in items.filter("item_prefix = 'BQIPA'").select("item_code").collect())
    assert numbers == list(range(numbers[0], numbers[0] + len(numbers)))


def test_ceiling_holds(roles):
    out = payback_jobs.ceiling(roles)
    per_group = out["subgroups"].groupBy("list_id", "group_no").agg(F.sum("amount").alias("s"))
    assert per_group.filter(F.col("s") > payback_jobs.LIMIT).count() == 0


def test_valid_groups_only_are_imported(roles):
    groups = importing_jobs.batch(roles)["groups"]
    assert groups.filter("is_valid = 1").count() == importing_jobs.imports(roles)["groups"].count()


# ---- empty inputs

def test_jobs_take_empty_inputs(roles):
    nothing = roles.import_detail.limit(0)
    assert results.classify(roles.bill_item.limit(0), roles.reject.limit(0)).count() == 0
    out = transfers.create_transfers(roles.spark.createDataFrame([], "request_id long, group_type int, payback_ref string"), roles.payback, dt.date(2025, 1, 1), roles.spark.createDataFrame([], NO_COUNTERS))
    assert out["transfers"].count() == 0 and out["paybacks"].count() == roles.payback.count()
    assert quality.duplicate_claims(nothing).count() == 0
    assert importing.document_state(importing_jobs.all_sources(roles).limit(0), roles.document.limit(0), importing.DOCUMENT_KINDS).count() == 0


# ---- work that must not be done twice or gathered under one key

@pytest.mark.parametrize("name", ["generate_bill_items", "generate_bill_state", "generate_bill_counters", "import_claim_groups_audit", "import_claim_groups_head",
                                  "create_payback_misc_claims", "create_payback_misc_details", "create_payback_hospital_report", "export_bill_rows", "export_view_health"])
def test_line_items_are_summed_up_once(spark, small, name):
    assert not any("lineitem" in path for path in REGISTRY[name].spark(spark, small).inputFiles())


def test_claims_are_worked_out_once_for_all_results_of_billing(roles):
    out = billing_jobs.bills_of(roles)
    assert all("/settleflow-places-" in path or "/settleflow-spans-" in path or "/settleflow-counters-" in path or "orders" in path for path in out["items"].inputFiles())


@pytest.fixture
def no_broadcast(spark):
    """Joins as they are planned for large tables."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_paybacks_without_transfer_are_not_gathered(spark, no_broadcast):
    codes = spark.createDataFrame([("g1",), ("g2",)], "group_code string")
    details = spark.createDataFrame([("g1", "d1", 1, 7), ("g2", "d2", 2, 7), ("g2", "d3", None, 7)], "group_code string, detail_code string, payback_id int, hospital_id int")
    claims = spark.createDataFrame([(1, 7, "c1"), (2, 7, "c2")], "payback_id int, hospital_id int, claim_code string")
    paybacks = spark.createDataFrame([(1, "p1", 5), (2, "p2", None), (None, "p3", None)], "payback_id int, payback_code string, transfer_id int")
    transfers = spark.createDataFrame([(5, "t5"), (None, "none")], "transfer_id int, transfer_code string")
    out = quality.trace_claim_group(codes, details, claims, paybacks, transfers)
    assert pairs(out, "detail_code", "claim_code", "payback_code", "transfer_code") == [("d1", "c1", "p1", "t5"), ("d2", "c2", "p2", None), ("d3", None, None, None)]
    assert "hashpartitioning(transfer_id" not in out._jdf.queryExecution().executedPlan().toString()


def test_cover_entries_meet_their_claim_in_one_shuffle(spark, no_broadcast):
    entries = spark.createDataFrame([("e1", 1, D(5), 7, 0), ("e2", 1, D(6), 7, 0), ("e3", 2, D(3), 7, 1), (None, 3, D(3), 7, 0), ("e5", None, D(3), 7, 0), ("e6", 4, D(3), None, 0)],
                                    "entry_id string, detail_id int, cover_amount decimal(16,2), user_id int, is_npl int")
    details = spark.createDataFrame([(i, f"c{i}", D(100), None) for i in (1, 2, 3, 4)], "detail_id int, claim_code string, pay_total decimal(16,2), bill_code string")
    current = spark.createDataFrame([(2, D(1), 1, 0, 0), (9, D(2), 1, 0, 0), (None, D(4), 1, 0, 0)], "detail_id int, cover_amount decimal(16,2), is_manual int, is_manual_npl int, on_bill int")
    out = results.manual_cover_batch(entries, details, current)
    assert pairs(out["judged"], "entry_id", "action", "reason") == [
        ("e1", None, M.NO_UPDATE), ("e2", "insert", None), ("e3", "update", None), ("e5", None, M.INCOMPLETE), ("e6", None, M.INCOMPLETE), (None, None, M.NO_UPDATE)]
    assert pairs(out["results"], "detail_id", "cover_amount", "is_manual", "is_manual_npl", "on_bill") == sorted([
        (1, D("6.00"), 1, 0, 0), (2, D("3.00"), 1, 1, 0), (9, D("2.00"), 1, 0, 0), (None, D("4.00"), 1, 0, 0)], key=str)
    plan = out["results"]._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(entry_id" not in plan and "Union" not in plan


def test_export_rows_are_not_dealt_by_claim_type(spark, no_broadcast):
    bank = spark.createDataFrame([("1000", 1, "a"), ("2000", 2, "b")], "claim_type_code string, bank_id int, bank_account string")
    day = dt.date(2024, 1, 1)
    coded = spark.createDataFrame([(1, "B", "I1", D(1), day, day, 3, 2, "1000"), (2, "B", "I2", D(0), day, day, 3, 2, "3000")],
                                  "detail_id int, bill_code string, item_code string, cover_amount decimal(16,2), new_billing_date date, due_date date, insurer_id int, group_type int, claim_type_code string")
    details = spark.createDataFrame([(1, 4, "c1", D(9)), (2, 4, "c2", D(8))], "detail_id int, branch_id int, claim_code string, pay_total decimal(16,2)")
    branches = spark.createDataFrame([(4, "north")], "branch_id int, branch string")
    out = billing.export_rows(coded, details, branches, bank, lambda rows: rows.withColumn("remark", F.col("claim_code")))
    assert pairs(out, "claim_code", "pay", "bank_account", "branch", "remark") == [("c1", D("8.00"), "a", "north", "c1"), ("c2", D("8.00"), None, "north", "c2")]
    assert "hashpartitioning(claim_type_code" not in out._jdf.queryExecution().executedPlan().toString()


# ---- views of exported claims

VIEWS = ["export_bill_rows", "export_view_accident", "export_view_health", "export_view_misc"]


@pytest.mark.parametrize("name", VIEWS)
def test_exported_claims_meet_their_order_once(spark, small, no_broadcast, name):
    plan = REGISTRY[name].spark(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not any(f"hashpartitioning({c}" in plan for c in ("claim_code", "detail_id", "bill_code", "order_key", "raw", "_hospital", "_customer"))


def claim_tables(spark, folder, lines):
    """Orders, names and branches that are on record twice or not at all, and the given (order, line number)."""
    at = dt.datetime(1996, 3, 1)
    item = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    tables = {
        "lineitem": ([(o, i % 3 or None, i % 2, n, 1.0, 100.0 + i, "NAR"[i % 3], "FO"[i % 2], at) for i, (o, n) in enumerate(lines)], item),
        "orders": ([(k, c, s, p, at, t) for k, c, s, p, t in (
            (1, 3, "F", 2000.0, "2-HIGH"), (1, 13, "F", 3000.0, "1-URGENT"), (2, 3, "F", 1500.0, "2-HIGH"), (3, 3, "O", 1500.0, "2-HIGH"), (4, 7, "F", 5000.0, "5-LOW"), (5, None, "F", 5000.0, "1-URGENT"),
            (6, 3, "F", 10.0, "4-NOT"), (None, 3, "F", 2000.0, "2-HIGH"))], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "customer": ([(3, "c3"), (3, "c3 again"), (7, None), (None, "nobody")], "c_custkey long, c_name string"),
        "supplier": ([(0, "s0", 1, 1.0), (0, "s0 again", 1, 1.0), (None, "none", 1, 1.0)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "part": ([(1, "p1"), (2, "p2"), (2, "p2")], "p_partkey long, p_name string"),
        "nation": ([(3, "n3", 1), (3, "n3", 1), (7, "n7", 1)], "n_nationkey int, n_name string, n_regionkey int"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


PLAIN = [(o, n) for o in (1, 2, 3, 4, 5, 6, 9, None) for n in (1, 2, 2, 4, 7, None)]


@pytest.mark.parametrize("name", VIEWS)
def test_views_pair_records_as_joins_on_the_code_do(spark, tmp_path, monkeypatch, name):
    folder = claim_tables(spark, tmp_path / "t", PLAIN)
    found = REGISTRY[name].spark(spark, folder).collect()
    monkeypatch.setattr(billing_jobs, "codes_tell_lines_apart", lambda r: False)
    assert sorted(map(str, found)) == sorted(map(str, REGISTRY[name].spark(spark, folder).collect())) and found


@pytest.mark.parametrize("more, apart", [([], True), ([(1, 102)], False), ([(2, -99)], False), ([(10 ** 8, None)], False), ([(10 ** 8, 1)], True)])
def test_codes_that_two_lines_share_are_seen(spark, tmp_path, more, apart):
    assert billing_jobs.codes_tell_lines_apart(Roles(spark, claim_tables(spark, tmp_path / "t", [*PLAIN, *more]))) == apart


def test_only_claims_of_new_groups_are_shuffled_by_the_import(spark, monkeypatch):
    claims = spark.createDataFrame([("g1", "a"), ("g2", "b"), (None, "c"), ("g1", "a"), ("g3", "d")], "group_code string, claim_code string")
    groups = spark.createDataFrame([("g1",), ("g1",), ("g4",)], "group_code string")
    assert sorted(importing.of_groups(claims, groups).collect()) == [("g1", "a"), ("g1", "a")]
    monkeypatch.setattr(importing, "SENT_GROUPS", 2)
    assert importing.of_groups(claims, groups).count() == 5
