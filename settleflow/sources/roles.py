"""Role tables: the claim-settlement data model laid over the given tables.

Orders play the claim groups, their line items the claims, suppliers the hospitals and insurers,
customers the insured, nations the branches and events the transfer transactions. Every role keeps
all rows of its source unless the role itself is a status ("rejected", "billed", …).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from settleflow.functions.scalars import join_text, money, zero_pad
from settleflow.sources.tables import TableFolder
from settleflow.sources.work import stored


# columns of an order that claim groups are made of
RAW = ["o_custkey", "o_orderpriority", "o_orderstatus", "o_totalprice", "o_orderdate"]


def item_columns() -> list[Column]:
    """What a claim shows, from the raw columns of its line."""
    return [
        *map(F.col, ("order_key", "line_no", "hospital_id", "product_id")),
        F.char("rf").alias("rf"), F.char("ls").alias("ls"), F.col("happened_at"),
        (F.col("cents").cast("decimal(18,0)") / F.lit(100).cast("decimal(3,0)")).cast("decimal(16,2)").alias("amount"),
        (F.col("order_key") * 100 + F.col("line_no")).alias("detail_id"),
        join_text(F.lit("CL"), zero_pad(F.col("order_key"), 8), zero_pad(F.col("line_no"), 2)).alias("claim_code"),
    ]


def group_columns(of: str = "") -> dict[str, Column]:
    """What a claim group shows, from ``order_key`` and the other raw columns of its order, which may lie in a struct ``of`` (``name.``)."""
    key, customer, status = F.col("order_key"), F.col(f"{of}o_custkey"), F.col(f"{of}o_orderstatus")
    priority = F.substring(F.col(f"{of}o_orderpriority"), 1, 1)
    hospital = customer % 2 == 0
    return {
        "customer_id": customer,
        "group_code": join_text(
            F.lit("BU"), priority, F.when(hospital, "H").otherwise("B"), F.lit("-"),
            customer % 900 + 100, F.lit("-"), zero_pad(key, 8), F.lit("-"), key % 2,
        ),
        "group_type": priority.cast("int") + 1,
        "claim_type_code": F.when(hospital, "1000").otherwise("2000"),
        "status_id": F.when(status == "O", 2).when(status == "F", 3).otherwise(4),
        "insurer_id": (customer % 10 + 1).cast("int"),
        "branch_id": (customer % 25).cast("int"),
        "order_total": money(F.col(f"{of}o_totalprice")),
        "created_at": F.col(f"{of}o_orderdate"),
    }


def bill_columns(of: str = "") -> dict[str, Column]:
    """What a claim shows on its bill, from its own columns and those of ``group_columns``, which may lie in a struct ``of`` (``name.``)."""
    # the active earlier cover of a claim follows from the claim itself, so no join is needed
    covered = F.col("rf").isin("A", "R") & (F.col("ls") == "O")
    cover = F.coalesce(F.when(covered, money(F.col("pay_total") * F.lit("0.10").cast("decimal(4,2)"))), F.lit(0)).cast("decimal(16,2)")
    kind = F.when(F.col(f"{of}claim_type_code") == "1000", "H").otherwise("B")
    return {
        "item_code": join_text(F.lit("BQI"), F.substring("claim_code", 3, 30)),
        "bill_code": join_text(F.lit("BQG"), zero_pad(F.col(f"{of}insurer_id"), 2), kind, F.lit("-"), F.date_format(f"{of}created_at", "yyyyMMdd")),
        "billing_date": F.to_date(f"{of}created_at"), "cover_amount": cover, "amount_total": (F.col("pay_total") - cover).cast("decimal(16,2)"),
    }


def names(table: DataFrame, key: str, name: str) -> DataFrame:
    """One row per key with the ``names`` it has on record; a key may be there several times."""
    return table.where(F.col(key).isNotNull()).groupBy(key).agg(F.collect_list(F.struct(F.col(name).alias("name"))).alias("names"))


def document_kinds() -> Column:
    """Kinds of the documents filed for a claim."""
    return F.array_compact(F.array(F.when(F.col("ls") == "F", 24), F.when((F.col("line_no") % 2 == 0) | (F.col("rf") == "N"), 134)))


class Roles:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.t = TableFolder(spark, folder)
        self._kept: set[str] = set()

    def keep(self, *names: str) -> None:
        """Work the named roles out once and store them, for jobs that read them several times; roles made from them read the stored rows."""
        for name in names:
            if name not in self._kept:
                self._kept.add(name)
                self.__dict__[name] = stored(getattr(self, name), name)

    @cached_property
    def line(self) -> DataFrame:
        """One row per claim in raw columns: line items summed up to (order, line number).

        Cents and one-letter codes are aggregated as numbers, which keeps Spark on its hash
        aggregate; texts or wide decimals would make it sort every line item first.
        """
        cents = F.round(F.col("l_extendedprice") * 100).cast("long")
        return (
            self.t("lineitem")
            .groupBy(F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line_no"))
            .agg(
                F.sum(cents).alias("cents"),
                F.min("l_suppkey").alias("hospital_id"),
                F.min("l_partkey").alias("product_id"),
                F.min(F.ascii("l_returnflag")).alias("rf"),
                F.min(F.ascii("l_linestatus")).alias("ls"),
                F.min("l_shipdate").alias("happened_at"),
            )
        )

    @cached_property
    def item(self) -> DataFrame:
        """One row per claim."""
        return self.line.select(*item_columns())

    @cached_property
    def order(self) -> DataFrame:
        """Orders in raw columns: what claim groups are made of."""
        return self.t("orders").select(F.col("o_orderkey").alias("order_key"), *RAW)

    @cached_property
    def claim_line(self) -> DataFrame:
        """Lines with their order in raw columns. Texts are made where they are used, so joins and stored copies carry none."""
        return self.line.join(self.order, "order_key")

    @cached_property
    def records(self) -> DataFrame:
        """One row per order number with its ``records``: the raw columns of each, and the names on record for its customer."""
        called = names(self.t("customer"), "c_custkey", "c_name").select(F.col("c_custkey").alias("o_custkey"), "names")
        return self.order.where("order_key IS NOT NULL").join(called, "o_custkey", "left").groupBy("order_key").agg(F.collect_list(F.struct(*RAW, "names")).alias("records"))

    @cached_property
    def group(self) -> DataFrame:
        """One row per claim group."""
        return self.order.select("order_key", *[c.alias(n) for n, c in group_columns().items()])

    @cached_property
    def group_total(self) -> DataFrame:
        """Claims and amount per group, straight from the line items."""
        cents = (F.col("amount") * 100).cast("long")
        return self.item.groupBy("order_key").agg(F.count(F.lit(1)).alias("item_count"), F.sum(cents).alias("cents")).select(
            "order_key", "item_count", (F.col("cents").cast("decimal(18,0)") / F.lit(100).cast("decimal(3,0)")).cast("decimal(16,2)").alias("item_amount"))

    @cached_property
    def imported(self) -> DataFrame:
        """Imported groups; status-4 groups carry the amount of the order, the others that of their claims."""
        g = self.group.join(self.group_total, "order_key", "left")
        return g.select(
            F.col("order_key").alias("import_id"), "customer_id", "group_code", "group_type", "claim_type_code",
            "status_id", "insurer_id", "branch_id", "created_at",
            F.to_date("created_at").alias("billing_date"),
            F.coalesce("item_count", F.lit(0)).alias("item_count"),
            F.when(F.col("status_id") == 4, F.col("order_total"))
            .otherwise(F.coalesce("item_amount", F.lit(0))).cast("decimal(16,2)").alias("total_amount"),
            (F.col("order_total") >= 1000).alias("is_active"),
        )

    @cached_property
    def import_detail(self) -> DataFrame:
        """Imported claims with the attributes of their group."""
        g = group_columns()
        g["is_active"] = g.pop("order_total") >= 1000
        return self.claim_line.select(*item_columns(), *[c.alias(n) for n, c in g.items()]).withColumnsRenamed({"order_key": "import_id", "amount": "pay_total"})

    @cached_property
    def prior_result(self) -> DataFrame:
        """Covers booked before billing; ``is_manual_npl`` tells the two kinds apart."""
        return self.item.filter(F.col("rf").isin("A", "R")).select(
            "detail_id", "claim_code", F.col("order_key").alias("import_id"),
            money(F.col("amount") * F.lit("0.10").cast("decimal(4,2)")).alias("cover_amount"),
            F.when(F.col("rf") == "R", 1).otherwise(0).alias("is_manual_npl"),
            (F.col("ls") == "O").alias("is_active"),
        )

    @cached_property
    def cover_log(self) -> DataFrame:
        """History of cover entries, one per raw line item."""
        return self.t("lineitem").select(
            (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("detail_id"),
            money(money(F.col("l_extendedprice")) * F.lit("0.05").cast("decimal(4,2)")).alias("cover_amount"),
            F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("is_manual_npl"),
            F.col("l_shipdate").alias("created_at"),
            F.col("l_partkey").alias("tie1"), F.col("l_suppkey").alias("tie2"),
            F.col("l_extendedprice").alias("tie3"), F.col("l_quantity").alias("tie4"),
        )

    @cached_property
    def online_pay(self) -> DataFrame:
        """Online transfers per claim group."""
        return self.t("lineitem").select(
            F.col("l_orderkey").alias("online_id"), money(F.col("l_extendedprice")).alias("amount"),
            F.when(F.col("l_linestatus") == "F", 4).otherwise(2).alias("payment_status_id"),
        )

    @cached_property
    def npl(self) -> DataFrame:
        """Shares of a transfer to be collected back."""
        return self.t("lineitem").filter(F.col("l_returnflag") == "R").select(
            F.col("l_orderkey").alias("online_id"),
            money(money(F.col("l_extendedprice")) * F.lit("0.10").cast("decimal(4,2)")).alias("amount"),
        )

    @cached_property
    def bill_item(self) -> DataFrame:
        """Claims of billed groups (status 3) on the bill of their insurer, claim type and day."""
        d = self.import_detail.filter("status_id = 3 AND is_active")
        on_bill = bill_columns()
        return d.select(
            *[on_bill[n].alias(n) for n in ("item_code", "bill_code")],
            "detail_id", "import_id", "claim_code", "group_code", "group_type", "claim_type_code", "insurer_id", "branch_id",
            "customer_id", "hospital_id", "product_id", "rf", "ls", "line_no", "happened_at", "created_at",
            on_bill["billing_date"].alias("billing_date"), "pay_total", *[on_bill[n].alias(n) for n in ("cover_amount", "amount_total")],
        )

    @cached_property
    def bill(self) -> DataFrame:
        return self.bill_item.groupBy("bill_code", "insurer_id", "claim_type_code", "billing_date").agg(
            F.count(F.lit(1)).alias("item_count"),
            F.sum("pay_total").cast("decimal(16,2)").alias("pay_total"),
            F.sum("cover_amount").cast("decimal(16,2)").alias("cover_amount"),
            F.sum("amount_total").cast("decimal(16,2)").alias("total_amount"),
            F.min("group_type").alias("group_type"),
        )

    @cached_property
    def reject(self) -> DataFrame:
        """Insurer rejections: whole amount on odd claim numbers, half of it on even ones."""
        i = self.bill_item.filter("rf = 'N' AND ls = 'F'")
        half = money(F.col("amount_total") * F.lit("0.50").cast("decimal(4,2)"))
        return i.select(
            "item_code", join_text(F.lit("TCB"), zero_pad(F.col("insurer_id"), 4)).alias("tmp_code"),
            F.when(F.col("line_no") % 2 == 1, F.col("amount_total")).otherwise(half).cast("decimal(16,2)").alias("rejected_amount"),
            join_text(F.lit("reject line "), F.col("line_no")).alias("rejected_remark"),
        )

    @cached_property
    def payback(self) -> DataFrame:
        """Pay-backs, one per claim group; groups still waiting (status 2) have no transfer."""
        return self.imported.filter("is_active").select(
            F.col("import_id").alias("payback_id"),
            join_text(F.lit("CPBG"), zero_pad(F.col("import_id"), 8)).alias("payback_code"),
            F.col("total_amount").alias("amount"), "item_count", "group_code", "group_type", "branch_id", "insurer_id",
            F.when(F.col("status_id") != 2, F.col("customer_id")).alias("transfer_id"),
            "customer_id", "status_id", "created_at",
        )

    @cached_property
    def payback_claim(self) -> DataFrame:
        return self.item.select(
            F.col("order_key").alias("payback_id"), "claim_code", "hospital_id", "product_id",
            F.col("amount").alias("claim_pay"), "rf", "ls", "happened_at",
        )

    @cached_property
    def payback_detail(self) -> DataFrame:
        """Pay-back amount per hospital."""
        per = self.item.groupBy("order_key", "hospital_id").agg(
            F.count(F.lit(1)).alias("item_count"), F.sum("amount").cast("decimal(16,2)").alias("amount")
        )
        g = self.group.filter("order_total >= 1000").select(
            "order_key", "group_code", "group_type", "insurer_id", "branch_id", "created_at", "status_id",
            F.when(F.col("status_id") != 2, F.col("customer_id")).alias("transfer_id"),
        )
        return per.join(g, "order_key").select(
            join_text(F.lit("CPBD"), zero_pad(F.col("order_key"), 8), F.lit("-"), F.col("hospital_id")).alias("detail_code"),
            F.col("order_key").alias("payback_id"), "group_code", "group_type", "insurer_id", "branch_id",
            "hospital_id", "item_count", "amount", "transfer_id", "status_id", "created_at",
        )

    @cached_property
    def transfer(self) -> DataFrame:
        t = self.payback.filter("transfer_id IS NOT NULL").groupBy("transfer_id").agg(
            F.sum("amount").cast("decimal(16,2)").alias("amount"), F.count(F.lit(1)).alias("payback_count"),
            F.min("created_at").alias("created_at"), F.max("status_id").alias("last_status"),
        )
        kind = F.col("transfer_id") % 5
        return t.select(
            "transfer_id", join_text(F.lit("CPBT"), zero_pad(F.col("transfer_id"), 8)).alias("transfer_code"),
            "amount", "payback_count", "created_at",
            (kind + 2).cast("int").alias("group_type"),
            F.when(F.col("last_status") == 3, 3).otherwise(2).alias("status_id"),
            F.when(kind == 0, 7).when(kind == 1, 2).when(kind == 2, 3).when(kind == 3, 6).alias("oop_status"),
            F.when(F.col("last_status") == 3, F.col("amount")).alias("transfer_amount"),
        )

    @cached_property
    def subgroup_detail(self) -> DataFrame:
        """Pay-backs per sub-group; a sub-group spans two neighbouring transfers."""
        return self.payback.filter("transfer_id IS NOT NULL").select(
            (F.floor(F.col("transfer_id") / 2) * 10 + F.col("payback_id") % 3).cast("long").alias("subgroup_id"),
            "payback_id", "transfer_id", "amount", "status_id", "created_at",
        )

    @cached_property
    def subgroup(self) -> DataFrame:
        s = self.subgroup_detail.groupBy("subgroup_id").agg(
            F.sum("amount").cast("decimal(16,2)").alias("amount"), F.count(F.lit(1)).alias("item_count"),
            F.min("status_id").alias("low_status"), F.max("created_at").alias("last_at"),
        )
        return s.select(
            "subgroup_id", join_text(F.lit("HCG"), zero_pad(F.col("subgroup_id"), 8)).alias("subgroup_code"),
            "amount", "item_count", "last_at",
            F.when(F.col("low_status") == 3, 0).otherwise(1).alias("is_paid"),
            (F.col("item_count") % 2).cast("int").alias("is_mailed"),
        )

    @cached_property
    def policy(self) -> DataFrame:
        return self.t("orders").select(
            F.col("o_custkey").alias("app_id"), (F.col("o_orderkey") % 5 + 9601).cast("int").alias("policy_type_id"),
            join_text(F.lit("POL"), F.col("o_orderkey")).alias("detail"),
            F.col("o_orderdate").alias("created_at"), F.col("o_orderkey").alias("policy_key"),
        )

    @cached_property
    def document(self) -> DataFrame:
        """Documents filed per claim: kind 24 when settled, kind 134 on even claims or unreturned ones."""
        return self.item.select("claim_code", "order_key", "happened_at", F.explode(document_kinds()).alias("kind"))

    @cached_property
    def hospital(self) -> DataFrame:
        return self.t("supplier").select(
            F.col("s_suppkey").alias("hospital_id"), zero_pad(F.col("s_suppkey"), 12).alias("hospital_code"),
            F.col("s_name").alias("hospital_name"), F.col("s_nationkey").alias("nation_id"),
            money(F.col("s_acctbal")).alias("balance"),
        )

    @cached_property
    def branch(self) -> DataFrame:
        return self.t("nation").select(
            F.col("n_nationkey").alias("branch_id"), F.col("n_name").alias("branch"), F.col("n_regionkey").alias("region_id")
        )

    @cached_property
    def transaction(self) -> DataFrame:
        """Status history of sub-group payments."""
        status = F.col("event_type")
        return self.t("events").select(
            F.col("user_id").alias("subgroup_id"), F.col("ts").alias("created_at"), F.col("event_id"),
            F.when(status == "error", 4).when(status == "purchase", 5).when(status == "signup", 6)
            .when(status == "click", 2).otherwise(1).alias("status_id"),
        )
