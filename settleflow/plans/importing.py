"""Checking a batch of claim groups and importing the valid ones."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settleflow.functions import messages as M
from settleflow.functions.scalars import flag, join_text, messages, money, month_start
from settleflow.operators.aggregates import pivot_values, text_list
from settleflow.operators.filters import half_open
from settleflow.operators.joins import map_value
from settleflow.operators.numbering import global_row_number
from settleflow.plans.columns import claim_columns

# fixed values: source of each header-group type, product code per type, policy each admit type needs
SOURCE_OF_TYPE = {2: "health", 5: "health", 3: "accident", 4: "compensate", 6: "misc"}
TYPE_OF_PRODUCT = {"1000": 2, "2000": 3, "2222": 4, "P30": 5, "Misc": 6}
POLICY_OF_ADMIT = {"4001": 9601, "4009": 9602, "4010": 9604}
# fixed values: the two document kinds a hospital claim needs, per product (they differ by site)
DOCUMENT_KINDS = {"1000": (24, 134), "P30": (24, 134), "2000": (26, 135)}
POLICY_TYPES = {9601: "p9601", 9602: "p9602", 9603: "p9603", 9604: "p9604", 9605: "p9605"}


def claims_of_sources(health: DataFrame, accident: DataFrame, compensate: DataFrame, misc: DataFrame) -> DataFrame:
    """Claims of all sources under one set of column names, each marked with its source."""
    parts = {"health": health, "accident": accident, "compensate": compensate, "misc": misc}
    marked = [frame.withColumn("source", F.lit(name)) for name, frame in parts.items()]
    out = marked[0]
    for frame in marked[1:]:
        out = out.unionByName(frame)  # by name: a differing column order in one source does no harm
    return out


def document_state(claims: DataFrame, documents: DataFrame, kinds: dict[str, tuple[int, int]]) -> DataFrame:
    """Claims with ``doc_ok``: 1 when the documents their type needs are there.

    Hospital claims need both kinds of their product; other claims and compensations need any
    document; miscellaneous claims need none.
    """
    # documents per claim are counted first, so the join is one row per claim
    wanted = sorted({k for pair in kinds.values() for k in pair})
    filed = documents.groupBy("claim_code").agg(*[F.max(flag(F.col("kind") == k)).alias(f"has_{k}") for k in wanted])
    hospital = F.col("claim_type_code") == "1000"
    both = F.lit(False)
    for product, (a, b) in kinds.items():
        both = both | ((F.col("product_code") == product) & (F.col(f"has_{a}") == 1) & (F.col(f"has_{b}") == 1))
    any_filed = F.col(f"has_{wanted[0]}").isNotNull()
    ok = (
        F.when(F.col("source") == "misc", 1)
        .when(~any_filed, 0)
        .when(~hospital | (F.col("product_code") == "2222") | both, 1)
        .otherwise(0)
    )
    return claims.join(filed, "claim_code", "left").withColumn("doc_ok", ok).drop(*[f"has_{k}" for k in wanted])


def policy_state(claims: DataFrame, policies: DataFrame) -> DataFrame:
    """Group level: required policies that are missing, and the history of recorded policies.

    Only admit types of accident claims that name a required policy are tested.
    """
    held = pivot_values(policies, ["app_id"], "policy_type_id", {c: f"h{c}" for c in POLICY_OF_ADMIT.values()}, F.col("detail"))
    accident = claims.filter("source = 'accident'").select("group_code", "app_id", "admit_code").filter(F.col("admit_code").isin(*POLICY_OF_ADMIT))
    need = accident.groupBy("group_code", "app_id").agg(
        *[F.max(flag(F.col("admit_code") == a)).alias(f"need_{a}") for a in POLICY_OF_ADMIT])
    lines = policies.select("app_id", join_text(F.col("detail"), F.lit(" ("), F.col("policy_type_id"), F.lit(")")).alias("line"), "created_at", "policy_key")
    missing = messages(*[
        ((F.col(f"need_{a}") == 1) & F.col(f"h{p}").isNull(), a + M.MUST_HAVE + str(p)) for a, p in POLICY_OF_ADMIT.items()
    ], sep="; ")
    lacking = need.join(held, "app_id", "left").withColumn("missing", missing)
    # histories of those that miss a policy; only they are shown
    wanted = lines.join(lacking.filter("missing <> ''").select("app_id").distinct(), "app_id", "left_semi")
    history = text_list(wanted, ["app_id"], "line", ["created_at", "policy_key"], " > ", "history")
    return lacking.join(history, "app_id", "left").groupBy("group_code").agg(
        F.max("missing").alias("missing_policy"), F.max("history").alias("history"))


def validate_import_batch(staging: DataFrame, claims: DataFrame, documents: DataFrame, policies: DataFrame,
                          imported: DataFrame, imported_claims: DataFrame, paid_groups: DataFrame,
                          kinds: dict[str, tuple[int, int]] | None = None) -> dict[str, DataFrame]:
    """Check every staged group; returns ``groups`` (is_valid, result) and ``details`` (documents).

    ``staging``: tmp_id, tmp_code, group_code, item_count, total_amount, group_type.
    ``claims``: group_code, claim_code, product_code, admit_code, amount, app_id, insurer_id,
    claim_type_code, source. ``imported`` holds active imported groups, ``imported_claims`` their
    claims and ``paid_groups`` the groups with a pay-back.
    """
    staged = staging.withColumns({
        "item_count": F.coalesce("item_count", F.lit(0)), "total_amount": F.coalesce("total_amount", F.lit(0)),
        "source": map_value(F.col("group_type"), SOURCE_OF_TYPE),
    })
    checked = document_state(claims, documents, kinds or DOCUMENT_KINDS)
    in_db = checked.groupBy("group_code", "source").agg(
        F.count(F.lit(1)).alias("db_count"), money(F.sum("amount")).alias("db_amount"), F.max("product_code").alias("product_code"),
        F.max("insurer_id").alias("insurer_id"), F.max("claim_type_code").alias("claim_type_code"),
        F.sum(flag(F.col("doc_ok") == 0)).alias("missing_docs"))
    repeats = staging.groupBy("group_code").agg(F.count(F.lit(1)).alias("in_file")).filter("in_file > 1")
    known = imported.select("group_code").distinct().withColumn("is_known", F.lit(True))
    # claims of this group that an earlier import of the same group already holds
    same = (claims.select("group_code", "claim_code").join(imported_claims.select("group_code", "claim_code"), ["group_code", "claim_code"], "left_semi")
            .select("group_code").distinct().join(paid_groups.select("group_code"), "group_code", "left_semi").withColumn("has_claim", F.lit(True)))
    rows = (
        staged.join(in_db, ["group_code", "source"], "left").join(repeats, "group_code", "left")
        .join(known, "group_code", "left").join(same, "group_code", "left")
        .join(policy_state(claims, policies), "group_code", "left")
        .withColumn("found_type", map_value(F.col("product_code"), TYPE_OF_PRODUCT))
    )
    single = F.col("in_file").isNull() & (F.col("group_type") == F.col("found_type"))
    group_name = F.when(F.col("group_type") == 2, "PH").when(F.col("group_type") == 3, "PA30").when(F.col("group_type") == 6, M.MISC_GROUP).otherwise("-")
    result = messages(
        (F.col("in_file").isNotNull(), M.TWICE_IN_FILE),
        (F.col("is_known").isNotNull(), M.ALREADY_IMPORTED),
        (F.col("db_count").isNull(), M.NOT_FOUND),
        (single & (F.col("item_count") != F.coalesce("db_count", F.lit(0))), M.COUNT_DIFFERS),
        (F.col("total_amount") == 0, M.NO_AMOUNT),
        (single & (F.col("total_amount") != F.coalesce("db_amount", F.lit(0))),
         join_text(F.lit(M.AMOUNT_DIFFERS + "( "), F.format_number("db_amount", 2), F.lit(")"))),
        (F.col("has_claim").isNotNull() & F.col("group_code").like("%_0"), M.CLAIM_ALREADY_IN),
        (F.col("group_type") != F.col("found_type"), join_text(F.lit(M.WRONG_GROUP + " "), group_name, F.lit(" " + M.OF_GIVEN_GROUP))),
        (F.col("missing_docs") > 0, M.NO_DOCUMENTS),
        (F.col("claim_type_code") == "", M.NO_CLAIM_TYPE),
        (F.col("missing_policy") != "", join_text(F.col("missing_policy"), F.lit(" , " + M.POLICY_HISTORY), F.col("history"))),
        (F.col("product_code") == "ZebraMisc", M.CHECK_FUND_CLAIM),
    )
    groups = rows.withColumn("result", result).select(
        "tmp_id", "tmp_code", "group_code", "group_type", "item_count", "total_amount", "insurer_id", "claim_type_code",
        "result", flag(F.col("result") == "").alias("is_valid"))
    details = staged.select("tmp_id", "group_code", "source").join(checked, ["group_code", "source"]).select(
        "tmp_id", "group_code", "claim_code", "amount", "doc_ok",
        F.when(F.col("doc_ok") == 0, M.CLAIM_WITHOUT_DOCUMENT).otherwise("").alias("detail_result"))
    return {"groups": groups, "details": details}


# so many new groups at most are sent to all tasks, by a hash of eight bytes
SENT_GROUPS = 2_000_000


def of_groups(frame: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows of the ``groups`` and few others, so that joins on the group code shuffle no more; all rows where the groups are too many to send."""
    codes = groups.select(F.xxhash64("group_code").alias("_group"))
    if codes.limit(SENT_GROUPS + 1).count() > SENT_GROUPS:
        return frame
    return frame.withColumn("_group", F.xxhash64("group_code")).join(F.broadcast(codes), "_group", "left_semi").drop("_group")


def import_claim_groups(valid: DataFrame, claims: DataFrame, companies: DataFrame, policies: DataFrame, monthly_policies: DataFrame,
                        hospitals: DataFrame, products: DataFrame, customers: DataFrame, admit_names: DataFrame,
                        last_id, file_name: str, user_id: int, as_of: str, channel: int = 1,
                        widen: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> dict[str, DataFrame]:
    """File, group, detail and audit rows for the groups that passed validation.

    Details have all ``columns.CLAIM`` columns, whatever the source of a claim has of them. Policy number: of the month the
    claim happened for types 2, 4 and 5; for type 3 the policy its admit type calls for, or 9601, falling back to 9605; the claim's
    own for type 6. ``last_id`` is a one-value frame with the highest id in use. ``companies`` may name a group from several
    sources. ``audit`` says for every new group through which channel (1 or another) it came. ``claims`` may be narrow: group_code, claim_code,
    app_id, happened_at, hospital_id, product_id and what ``widen`` makes the other columns of, after all joins.
    """
    numbered = global_row_number(valid.filter("is_valid = 1").select(
        "tmp_id", "group_code", "group_type", "item_count", "total_amount", "insurer_id", "claim_type_code"), ["tmp_id"], "_n", whole=True)
    names = of_groups(companies, numbered).select("group_code", "company_name").distinct()
    made = {"created_at": F.lit(as_of).cast("timestamp_ntz"), "created_by": F.lit(user_id)}
    groups = (numbered.withColumn("_last", last_id.scalar()).withColumn("import_id", F.coalesce("_last", F.lit(0)) + F.col("_n"))
              .join(names, "group_code", "left")
              .withColumns({"status_id": F.lit(2), "is_active": F.lit(True), "file_name": F.lit(file_name), **made}).drop("_n", "_last"))
    files = groups.groupBy("file_name", "group_type").agg(F.count(F.lit(1)).alias("item_count")).withColumns({"is_active": F.lit(True), **made})
    held = pivot_values(policies, ["app_id"], "policy_type_id", POLICY_TYPES, F.col("detail"))
    by_month = monthly_policies.select("app_id", "period", F.col("policy_no").alias("month_policy"))
    chosen = F.when(F.col("admit_code") == "4009", F.col("p9602")).when(F.col("admit_code") == "4010", F.col("p9604")).otherwise(F.col("p9601"))
    rows = widen(
        groups.select("import_id", "group_code", "group_type")
        .join(of_groups(claims, numbered).withColumn("period", month_start(F.col("happened_at"))), "group_code")
        .join(held, "app_id", "left").join(by_month, ["app_id", "period"], "left")
        .join(hospitals.select("hospital_id", "hospital_name"), "hospital_id", "left")
        .join(products, "product_id", "left").join(customers, "app_id", "left")
        .join(admit_names, "claim_code", "left")
    )
    given = {
        "policy_no": F.when(F.col("group_type").isin(2, 4, 5), F.col("month_policy"))
        .when(F.col("group_type") == 3, F.coalesce(chosen, F.col("p9605"))).otherwise(F.col("own_policy")),
        "admit_type": F.when(F.col("group_type") == 6, F.col("admit_names")).otherwise(F.col("admit_code")),
    }
    details = rows.select("import_id", "group_code", "claim_code", *claim_columns(rows, given), F.lit(True).alias("is_active"), *[v.alias(n) for n, v in made.items()])
    audit = groups.select("import_id", F.lit(M.IMPORTED_FROM_FILE if channel == 1 else M.IMPORTED_FROM_LIST).alias("note"), "is_active", "created_by", "created_at")
    return {"files": files, "groups": groups, "details": details, "audit": audit}


def importable_claims(paybacks: DataFrame, claims: DataFrame, documents: DataFrame, imported: DataFrame,
                      own_company: int, start=None, end=None, kinds=None) -> DataFrame:
    """Claims of paid groups that were not imported yet, with their document check."""
    open_groups = (
        paybacks.filter(half_open("created_at", start, end)).filter(F.col("insurer_id") != own_company)
        .select("group_code", "group_type").distinct()
        .join(imported.filter("is_active").select("group_code"), "group_code", "left_anti")
        .withColumn("source", map_value(F.col("group_type"), SOURCE_OF_TYPE)).filter("source <> 'misc'")
    )
    wanted = claims.join(open_groups.select("group_code", "source"), ["group_code", "source"], "left_semi")
    checked = document_state(wanted, documents, kinds or DOCUMENT_KINDS)
    return checked.select(
        "group_code", "claim_code", "amount", F.col("doc_ok").alias("is_valid"),
        F.when(F.col("doc_ok") == 0, M.CLAIM_WITHOUT_DOCUMENT).otherwise("").alias("detail_result"),
        map_value(F.col("product_code"), TYPE_OF_PRODUCT).alias("group_type"))
