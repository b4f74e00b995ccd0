"""Column specifications of the wide rows: imported claims, bill export rows and the insurers' views of them.

A specification names the columns and their types once. ``select_wide`` builds them from whatever columns a frame
has; the others are typed NULLs, so all sources give rows of one shape.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settleflow.functions import messages as M

_SHORT = {"s": "string", "i": "int", "m": "decimal(16,2)", "t": "timestamp_ntz", "y": "date", "b": "boolean"}


def spec(text: str) -> dict[str, str]:
    """Names and types from words like ``pay:m`` (s text, i whole number, m money, t time, y date, b flag)."""
    return {name: _SHORT[kind] for name, kind in (word.split(":") for word in text.split())}


# a claim as it is kept with its imported group
CLAIM = spec("""province:s identity_card:s customer_name:s happened_at:t pay:m hospital_id:i hospital_name:s date_in:t date_out:t application_code:s
    product_id:i product_name:s noticed_at:t cover_from:y admit_code:s admit_type:s claim_type:s icd10_code:s icd10:s ipd_count:i icu_count:i net:m
    compensate_include:m gross_total:m discount:m pay_total:m policy_no:s school_name:s customer_detail_code:s school_level:s accident:s chief_complaint:s
    organ:m compensate_in:m compensate_out:m amount_pay:m amount_dead:m remark:s branch_id:i""")
# columns that a source does not have
LACKS = {
    "health": "school_name customer_detail_code school_level accident organ compensate_in compensate_out amount_pay amount_dead remark".split(),
    "accident": "product_id noticed_at cover_from ipd_count icu_count net compensate_include".split(),
    "compensate": "school_name customer_detail_code school_level accident organ compensate_in compensate_out amount_pay amount_dead remark".split(),
    "misc": """province admit_code icd10_code icd10 ipd_count discount school_name customer_detail_code school_level accident organ compensate_in
        compensate_out amount_dead""".split(),
}
# amounts that follow from another one; a number stands for itself
DERIVED = {
    "accident": {"organ": 0},
    "compensate": {"net": "pay_total", "gross_total": "pay_total", "compensate_include": 0, "discount": 0},
    "misc": {"net": "pay", "gross_total": "pay", "pay_total": "pay", "amount_pay": "pay", "compensate_include": 0},
}
# fixed values: accident claim kinds that pay for a death, styles of hospital claims
DEATH_KINDS, HOSPITAL_STYLES = ("4006", "4006_2", "4007"), ("4110", "4120")

EXPORT = spec("""new_billing_date:y due_date:y branch_id:i branch:s group_code:s policy_no:s application_code:s claim_code:s province:s school_name:s
    customer_detail_code:s identity_card:s customer_name:s school_level:s happened_at:t accident:s chief_complaint:s organ:m pay:m compensate_in:m
    compensate_out:m amount_pay:m amount_dead:m pay_total:m admit_type:s hospital_id:i hospital_name:s icd10_code:s icd10:s remark:s date_in:t date_out:t
    claim_type:s bill_code:s item_code:s document_link:s insurer_id:i insurer_name:s cover_from:y ipd_count:i icu_count:i group_type:i product_id:i
    product_name:s bank_id:i bank_account:s""")
ACCIDENT_VIEW = spec("""group_code:s policy_no:s claim_code:s school_name:s customer_name:s happened_at:t accident:s chief_complaint:s net:m compensate_in:m
    compensate_out:m amount_pay:m amount_dead:m gross_total:m hospital_name:s remark:s date_in:t date_out:t bill_code:s item_code:s document_link:s province:s organ:m level_room:s""")
MISC_VIEW = spec("""group_code:s policy_no:s product_name:s claim_code:s branch_name:s school_name:s customer_name:s happened_at:t hospital_name:s date_in:t date_out:t
    chief_complaint:s accident:s injury:s organs:s remark:s compensation_ipd:m compensation_opd:m expense_ipd:m expense_opd:m dead:m expense:m payback_amount:m
    uncover_amount:m total_pay:m pay_remark:s continue_claim:s document_link:s document_id:s document_code:s""")
HEALTH_VIEW = spec("""application_code:s product_category:s province:s claim_code:s noticed_at:t customer_name:s cover_from:y claim_type:s admit_type:s claim_type_code:s
    admit_code:s hospital_name:s hospital_id:i icd10_code:s icd10:s is_continue:b continue_from:s date_in:t date_out:t ipd_except:i net:m cover:m uncover:m pay:m unpay:m
    discount:m compensate_net:m compensate_include:m compensate_remain:m gross_total:m unpay_total:m includes_compensate:b compensate_discount:m remark:s group_code:s
    ipd_count:i icu_count:i happened_at:t is_pay_center:b dcr_at:t branch_id:i identity_card:s discount_own:m pay_total:m pay_own:m bill_code:s item_code:s""")


def wide(frame: DataFrame, columns: dict[str, str], values: dict[str, Column] | None = None) -> dict[str, Column]:
    """Every column of a specification by name: a given value, else the frame's column, else NULL."""
    values = values or {}
    return {n: values.get(n, F.col(n) if n in frame.columns else F.lit(None)).cast(kind) for n, kind in columns.items()}


def select_wide(frame: DataFrame, columns: dict[str, str], values: dict[str, Column] | None = None) -> list[Column]:
    return [value.alias(n) for n, value in wide(frame, columns, values).items()]


def claim_columns(claims: DataFrame, given: dict[str, Column] | None = None) -> list[Column]:
    """The ``CLAIM`` columns of claims of any ``source``; ``given`` overrides single ones."""
    own = wide(claims, {**CLAIM, "style": "string", "compensate_amount": "decimal(16,2)"})
    hospital = F.when(F.col("source") == "misc", F.col("claim_type_code") == "1000").otherwise(own["style"].isin(*HOSPITAL_STYLES))
    values = {
        "claim_type": F.when(F.col("source").isin("accident", "misc"), F.when(hospital, M.HOSPITAL_CLAIM).otherwise(M.CUSTOMER_CLAIM)).otherwise(own["claim_type"]),
        "amount_dead": F.when(own["admit_code"].isin(*DEATH_KINDS), own["compensate_amount"]).otherwise(0),
        **(given or {}),
    }
    out = []
    for name, value in wide(claims, CLAIM, values).items():
        for source, derived in DERIVED.items():
            if name in derived:
                base = derived[name]
                value = F.when(F.col("source") == source, own[base] if isinstance(base, str) else F.lit(base)).otherwise(value)
        lacking = [s for s, names in LACKS.items() if name in names]
        if lacking:
            value = F.when(~F.col("source").isin(*lacking), value)
        out.append(value.cast(CLAIM[name]).alias(name))
    return out
